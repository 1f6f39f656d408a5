"""Queries over contract checks, personal data and contamination."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.operators import contracts as K
from chatloom.operators import prepare as P
from chatloom.operators import privacy as R
from chatloom.plans import views as V
from chatloom.plans.q_texts import sql_clean, sql_words
from chatloom.plans.registry import query, table, texts


def flat(df):
    return df.withColumn("reasons", F.array_join("reasons", ","))


@query("validate_messages", """
WITH c AS (SELECT conv_id, count(*) AS n, string_agg(role, ',' ORDER BY turn) AS roles, bool_or(trim(coalesce(text, '')) = '') AS blank FROM conversations GROUP BY 1)
SELECT conv_id, concat_ws(',', CASE WHEN n <> 2 THEN 'turn_count' END, CASE WHEN roles <> 'user,assistant' THEN 'roles' END, CASE WHEN blank THEN 'blank_content' END) AS reasons FROM c""")
def validate_messages(spark, sf_dir):
    made = P.assemble_conversations(table(spark, sf_dir, "conversations"), "conv_id", "turn")
    return flat(K.validate_messages(made, roles=("user", "assistant"))).select("conv_id", "reasons")


@query("validate_turns", """
WITH n AS (SELECT conv_id, role, CASE WHEN conv_id % 5 = 1 THEN turn // 2 WHEN conv_id % 3 = 0 THEN 2 * turn + 1 ELSE turn END AS turn FROM conversations),
t AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role) AS prev FROM n),
c AS (SELECT conv_id, count(*) AS n_turns, count(*) > count(DISTINCT turn) AS twice, bool_or(role = 'system' AND prev IS NOT NULL) AS late,
   bool_or(CASE role WHEN 'user' THEN NOT (prev IS NULL OR prev IN ('system', 'assistant')) WHEN 'assistant' THEN prev IS NULL OR prev <> 'user' ELSE false END) AS broken,
   bool_and(role = 'system') AS silent FROM t GROUP BY 1)
SELECT conv_id, n_turns, concat_ws(',', CASE WHEN twice THEN 'numbering' END, CASE WHEN late THEN 'late_system' END, CASE WHEN broken THEN 'alternation' END, CASE WHEN silent THEN 'no_user_turn' END) AS reasons FROM c""")
def validate_turns(spark, sf_dir):
    """Turn numbers with gaps in every third conversation, repeated ones in every fifth."""
    number = F.when(F.col("conv_id") % 5 == 1, F.floor(F.col("turn") / 2)).when(F.col("conv_id") % 3 == 0, 2 * F.col("turn") + 1).otherwise(F.col("turn"))
    return flat(K.validate_turns(table(spark, sf_dir, "conversations").withColumn("turn", number), "conv_id"))


@query("validate_labels", """
SELECT event_id, event_type, CASE WHEN event_type IN ('view', 'click', 'purchase') THEN '' ELSE 'label' END AS reasons FROM events""")
def validate_labels(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type")
    return flat(K.validate_labels(rows, "event_type", ["view", "click", "purchase"]))


@query("validate_triage", f"""WITH {V.TRIAGE_ROWS}, j AS (SELECT id, content, json_valid(content) AS ok, CASE WHEN json_valid(content) THEN content END AS js FROM triage_rows)
SELECT id, concat_ws(',', CASE WHEN NOT ok THEN 'not_json' END, CASE WHEN js IS NULL OR list_sort(json_keys(js)) <> ['category', 'priority'] THEN 'keys' END,
  CASE WHEN coalesce(json_extract_string(js, '$.category'), '') NOT IN {tuple(K.TRIAGE_CATEGORIES)} THEN 'category' END,
  CASE WHEN coalesce(json_extract_string(js, '$.priority'), '') NOT IN {tuple(K.TRIAGE_PRIORITIES)} THEN 'priority' END) AS reasons FROM j""")
def validate_triage(spark, sf_dir):
    return flat(K.validate_triage(V.triage_rows(spark, sf_dir), "content")).select("id", "reasons")


@query("validate_api_payload", f"""WITH {V.API_ROWS}
SELECT id, concat_ws(',', CASE WHEN NOT json_valid(content) THEN 'not_json' END,
  CASE WHEN coalesce(trim(json_extract_string(content, '$.action')), '') = '' THEN 'action' END,
  CASE WHEN coalesce(json_type(content, '$.params'), '') <> 'OBJECT' THEN 'params' END) AS reasons FROM api_rows""")
def validate_api_payload(spark, sf_dir):
    return flat(K.validate_api_payload(V.api_rows(spark, sf_dir), "content")).select("id", "reasons")


_FILLED = """filled AS (SELECT orderkey, line, part, coalesce(max_new_tokens, 512) AS max_new_tokens, coalesce(temperature, 0.7::DOUBLE) AS temperature, coalesce(top_p, 0.9::DOUBLE) AS top_p,
  coalesce(top_k, 50) AS top_k, coalesce(repetition_penalty, 1.1::DOUBLE) AS repetition_penalty FROM decode_requests)"""


@query("validate_requests", f"""WITH {V.DECODE_REQUESTS}, {_FILLED}
SELECT orderkey, line, part, max_new_tokens, temperature, top_p, top_k, repetition_penalty,
  concat_ws(',', CASE WHEN NOT max_new_tokens BETWEEN 1 AND 4096 THEN 'max_new_tokens' END, CASE WHEN NOT temperature BETWEEN 0 AND 2 THEN 'temperature' END,
    CASE WHEN NOT top_p BETWEEN 0 AND 1 THEN 'top_p' END, CASE WHEN top_k < 1 THEN 'top_k' END, CASE WHEN repetition_penalty < 1 THEN 'repetition_penalty' END) AS reasons FROM filled""")
def validate_requests(spark, sf_dir):
    return flat(K.validate_requests(V.decode_requests(spark, sf_dir)))


@query("normalise_decode", f"""WITH {V.DECODE_REQUESTS}, {_FILLED}
SELECT orderkey, line, part, max_new_tokens, repetition_penalty, temperature > 0 AS do_sample, CASE WHEN temperature > 0 THEN temperature END AS temperature,
  CASE WHEN temperature > 0 THEN top_p END AS top_p, CASE WHEN temperature > 0 THEN top_k END AS top_k FROM filled""")
def normalise_decode(spark, sf_dir):
    return K.normalise_decode(V.decode_requests(spark, sf_dir))


def sql_redact(c: str, names: list[str] | None = None) -> str:
    out = c
    for tag, pattern in R.PII_PATTERNS:
        out = f"regexp_replace({out}, '{pattern}', '[REDACTED_{tag}]', 'g')"
    if names:
        # applied twice: neighbouring names share the separator the first pass consumes
        word = f"'(^|[^\\pL\\pN_])(?:{'|'.join(sorted(names, key=lambda n: (-len(n), n)))})($|[^\\pL\\pN_])', '\\1[REDACTED_NAME]\\2', 'g'"
        out = f"regexp_replace(regexp_replace({out}, {word}), {word})"
    return out


# words that stand in for person names in the invented prose
_NAMES = ["Than", "Ther", "Lich", "Die"]


@query("redact_pii", f"SELECT doc_id, {sql_redact('text', _NAMES)} AS redacted FROM documents")
def redact_pii(spark, sf_dir):
    return R.redact_pii(texts(spark, sf_dir, "documents", "doc_id", "text"), "text", _NAMES).select("doc_id", "redacted")


_LEFT = [f"CAST(len(regexp_extract_all(answer, '{p}')) AS INTEGER) AS {t.lower()}_left" for t, p in R.PII_PATTERNS]


@query("pii_leaks", f"""WITH a AS (SELECT doc_id, text, CASE WHEN doc_id % 3 = 0 THEN text WHEN doc_id % 7 = 0 THEN {sql_redact('text')} || '!' ELSE {sql_redact('text')} END AS answer FROM documents),
l AS (SELECT doc_id, {", ".join(_LEFT)}, {sql_redact('text')} <> answer AS altered FROM a)
SELECT doc_id, email_left, ssn_left, card_left, phone_left, email_left + ssn_left + card_left + phone_left > 0 AS leaks, altered FROM l""")
def pii_leaks(spark, sf_dir):
    """Answers with faults: every third one is not redacted, some of the others gain a character."""
    docs = texts(spark, sf_dir, "documents", "doc_id", "text")
    clean = R.redact(F.col("text"))
    answer = F.when(F.col("doc_id") % 3 == 0, F.col("text")).when(F.col("doc_id") % 7 == 0, F.concat(clean, F.lit("!"))).otherwise(clean)
    return R.pii_leaks(docs.withColumn("answer", answer), "text", "answer").drop("text", "answer")


@query("redact_names", r"""
WITH gaz AS (SELECT string_agg(regexp_escape(name), '|' ORDER BY length(name) DESC, name) AS pat
  FROM (SELECT DISTINCT array_to_string(string_split(text, ' ')[1:2], ' ') AS name FROM benchmark WHERE text <> '') WHERE regexp_matches(name, '[\pL\pN_]')),
w AS (SELECT '(^|[^\pL\pN_])(?:' || pat || ')($|[^\pL\pN_])' AS pat FROM gaz)
SELECT doc_id, regexp_replace(regexp_replace(text, pat, '\1[REDACTED_NAME]\2', 'g'), pat, '\1[REDACTED_NAME]\2', 'g') AS redacted FROM documents, w""")
def redact_names(spark, sf_dir):
    """The first two words of every benchmark item stand in for a table of names."""
    names = table(spark, sf_dir, "benchmark").filter("text <> ''").select(F.array_join(F.slice(F.split("text", " "), 1, 2), " ").alias("name"))
    docs = texts(spark, sf_dir, "documents", "doc_id", "text")
    return R.redact_names(docs, "doc_id", "text", names, "name").select("doc_id", "redacted")


@query("build_redaction_pairs", f"""
WITH t AS (SELECT conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS transcript FROM conversations GROUP BY 1)
SELECT conv_id, 'Redact PII from this transcript: ''' || transcript || '''' AS user_content, {sql_redact('transcript')} AS model_content FROM t""")
def build_redaction_pairs(spark, sf_dir):
    made = P.assemble_conversations(table(spark, sf_dir, "conversations"), "conv_id", "turn")
    pairs = R.build_redaction_pairs(made)
    return pairs.select("conv_id", F.col("sample")[0]["content"].alias("user_content"), F.col("sample")[1]["content"].alias("model_content"))


_DOC_WORDS = sql_words("t")


@query("contamination", f"""
WITH d AS (SELECT doc_id, {sql_clean('text')} AS t FROM documents), b AS (SELECT item_id, {sql_clean('text')} AS t FROM benchmark),
dw AS (SELECT doc_id, unnest({_DOC_WORDS}) AS w, generate_subscripts({_DOC_WORDS}, 1) AS i FROM d),
bw AS (SELECT item_id, unnest({_DOC_WORDS}) AS w, generate_subscripts({_DOC_WORDS}, 1) AS i FROM b),
dg AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, string_agg(w, ' ') OVER x AS g, count(*) OVER x AS c FROM dw WINDOW x AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)) WHERE c = 8),
bg AS (SELECT DISTINCT item_id, g FROM (SELECT item_id, string_agg(w, ' ') OVER x AS g, count(*) OVER x AS c FROM bw WINDOW x AS (PARTITION BY item_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)) WHERE c = 8),
s AS (SELECT doc_id, item_id, count(*) AS shared FROM dg JOIN bg USING (g) GROUP BY ALL)
SELECT s.doc_id, s.item_id, shared, contains(' ' || d.t || ' ', ' ' || b.t || ' ') AS verbatim FROM s JOIN d USING (doc_id) JOIN b USING (item_id)""")
def contamination(spark, sf_dir):
    docs, bench = texts(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark")
    return R.contamination(docs, bench, "doc_id", "item_id")
