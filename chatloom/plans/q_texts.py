"""Queries over text-level metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.functions.text import clean_prediction, clean_text
from chatloom.operators import texts as X
from chatloom.plans import views as V
from chatloom.plans.registry import query, table, texts

PUNCT = r"""'!"#$%&''()*+,-./:;<=>?@[\]^_`{|}~'"""

def sql_clean(c: str) -> str:
    kept = f"translate(lower(coalesce({c}, '')), {PUNCT}, '')"
    return f"trim(regexp_replace({kept}, '\\s+', ' ', 'g'))"


def sql_words(clean: str) -> str:
    return f"list_filter(string_split({clean}, ' '), lambda x: x <> '')"


def sql_ascii(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower({c}), '[^a-zA-Z0-9\\s]', '', 'g'), '\\s+', ' ', 'g'))"


_PAIRS = f"{V.EDIT_PAIRS}, {V.TURN_PAIRS}, both_pairs AS (SELECT 'd' || id::VARCHAR AS id, prediction, reference FROM edit_pairs UNION ALL SELECT 't' || id::VARCHAR, prediction, reference FROM turn_pairs)"


def both_pairs(spark, sf_dir):
    a = V.edit_pairs(spark, sf_dir).withColumn("id", F.concat(F.lit("d"), "id"))
    return a.unionByName(V.turn_pairs(spark, sf_dir).withColumn("id", F.concat(F.lit("t"), "id")))


def sql_overlap(tokens_p: str, tokens_r: str, name: str = "ov") -> str:
    """CTEs that count a multiset overlap by exploding both sides."""
    return f"""
tk AS (SELECT id, {tokens_p} AS p, {tokens_r} AS r FROM both_pairs),
pc AS (SELECT id, tok, count(*) AS n FROM (SELECT id, unnest(p) AS tok FROM tk) GROUP BY ALL),
rc AS (SELECT id, tok, count(*) AS n FROM (SELECT id, unnest(r) AS tok FROM tk) GROUP BY ALL),
{name} AS (SELECT id, sum(least(pc.n, rc.n)) AS o FROM pc JOIN rc USING (id, tok) GROUP BY id),
sc AS (SELECT tk.id, len(p) AS np, len(r) AS nr, coalesce(o, 0)::DOUBLE AS o FROM tk LEFT JOIN {name} USING (id)),
pr AS (SELECT id, CASE WHEN np = 0 AND nr = 0 THEN 1.0::DOUBLE WHEN np = 0 OR nr = 0 THEN 0.0::DOUBLE ELSE o / np END AS precision,
                  CASE WHEN np = 0 AND nr = 0 THEN 1.0::DOUBLE WHEN np = 0 OR nr = 0 THEN 0.0::DOUBLE ELSE o / nr END AS recall FROM sc),
fs AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0::DOUBLE ELSE 2 * precision * recall / (precision + recall) END AS f1_score FROM pr)"""


_ROUNDED = "SELECT id, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1_score, 4) AS f1_score FROM fs"
_MULTISET = sql_overlap(sql_words(sql_clean("prediction")), sql_words(sql_clean("reference")))


def rounded(df):
    return df.select("id", *[F.round(c, 4).alias(c) for c in ("precision", "recall", "f1_score")])


@query("clean_text", f"SELECT doc_id, {sql_clean('text')} AS cleaned FROM documents")
def q_clean_text(spark, sf_dir):
    return texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", clean_text(F.col("text")).alias("cleaned"))


@query("clean_prediction", """
SELECT 'c' || conv_id::VARCHAR || '/' || turn::VARCHAR AS id, trim(string_split(text || '<end_of_turn>' || chr(10) || '<', '<')[1], ' ' || chr(9) || chr(10) || chr(13)) AS cleaned FROM conversations
UNION ALL SELECT 'p' || page_id::VARCHAR, trim(string_split('answer ' || replace(html, '<!', '!'), '<')[1], ' ' || chr(9) || chr(10) || chr(13)) FROM pages""")
def q_clean_prediction(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("c"), "conv_id", F.lit("/"), "turn").alias("id"), F.concat("text", F.lit("<end_of_turn>\n<")).alias("raw")
    )
    pages = table(spark, sf_dir, "pages").select(F.concat(F.lit("p"), "page_id").alias("id"), F.concat(F.lit("answer "), F.replace("html", F.lit("<!"), F.lit("!"))).alias("raw"))
    return turns.unionByName(pages).select("id", clean_prediction(F.col("raw")).alias("cleaned"))


@query("exact_match", f"WITH {_PAIRS} SELECT id, CAST({sql_clean('prediction')} = {sql_clean('reference')} AS INTEGER) AS exact_match FROM both_pairs")
def q_exact_match(spark, sf_dir):
    return both_pairs(spark, sf_dir).select("id", X.exact_match(F.col("prediction"), F.col("reference")).alias("exact_match"))


@query("token_prf_multiset", f"WITH {_PAIRS}, {_MULTISET} {_ROUNDED}")
def q_token_prf(spark, sf_dir):
    return rounded(X.token_prf(both_pairs(spark, sf_dir)))


_SET_TAIL = """
pr AS (SELECT id, CASE WHEN len(p) = 0 AND len(r) = 0 THEN 1.0::DOUBLE WHEN len(p) = 0 OR len(r) = 0 THEN 0.0::DOUBLE ELSE len(list_intersect(p, r))::DOUBLE / len(p) END AS precision,
                  CASE WHEN len(p) = 0 AND len(r) = 0 THEN 1.0::DOUBLE WHEN len(p) = 0 OR len(r) = 0 THEN 0.0::DOUBLE ELSE len(list_intersect(p, r))::DOUBLE / len(r) END AS recall FROM tk),
fs AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0::DOUBLE ELSE 2 * precision * recall / (precision + recall) END AS f1_score FROM pr)"""


@query("token_f1_set", f"WITH {_PAIRS}, tk AS (SELECT id, {sql_words(sql_ascii('prediction'))} AS p, {sql_words(sql_ascii('reference'))} AS r FROM both_pairs), {_SET_TAIL} {_ROUNDED}")
def q_token_f1_set(spark, sf_dir):
    return rounded(X.token_f1_set(both_pairs(spark, sf_dir)))


@query("token_prf_formal", f"WITH {_PAIRS}, tk AS (SELECT id, list_distinct({sql_words(sql_clean('prediction'))}) AS p, list_distinct({sql_words(sql_clean('reference'))}) AS r FROM both_pairs), {_SET_TAIL} {_ROUNDED}")
def q_token_prf_formal(spark, sf_dir):
    return rounded(X.token_prf_formal(both_pairs(spark, sf_dir)))


@query("extraction_report", f"""WITH {_PAIRS}, {_MULTISET},
em AS (SELECT id, CAST({sql_clean('prediction')} = {sql_clean('reference')} AS INTEGER) AS em FROM both_pairs)
SELECT left(id, 1) AS family, count(*) AS n_cases, round(avg(em), 4) AS macro_exact_match, round(avg(precision), 4) AS macro_precision,
       round(avg(recall), 4) AS macro_recall, round(avg(f1_score), 4) AS macro_f1_score
FROM fs JOIN em USING (id) GROUP BY 1""")
def q_extraction_report(spark, sf_dir):
    return X.extraction_report(both_pairs(spark, sf_dir).withColumn("family", F.substring("id", 1, 1)), ["family"])


@query("final_answer_match", f"""WITH {V.MATH_ROWS},
a AS (SELECT item, gold, CASE WHEN contains(output, '####') THEN trim(regexp_extract(output, '####[ \\t]*([^\\n]*)', 1)) END AS answer FROM math_rows)
SELECT item, answer, coalesce(answer = gold, false) AS strict_ok,
       coalesce(try_cast(replace(answer, ',', '') AS DOUBLE) = try_cast(replace(gold, ',', '') AS DOUBLE), false) AS lenient_ok FROM a""")
def q_final_answer(spark, sf_dir):
    return X.final_answer_match(V.math_rows(spark, sf_dir)).select("item", "answer", "strict_ok", "lenient_ok")


_LETTER = "upper(coalesce(nullif(regexp_extract(trim(output), '^\\(?([A-Da-d])\\)?\\.?$', 1), ''), nullif(regexp_extract(output, '(?i)answer\\s+is:?\\s*\\(?([A-D])\\b', 1), '')))"


@query("option_match", f"""WITH {V.OPTION_ROWS},
s AS (SELECT subject, count(*) AS n_items, avg(coalesce({_LETTER} = gold, false)::INT) AS accuracy FROM option_rows GROUP BY 1)
SELECT subject, n_items, round(accuracy, 4) AS accuracy FROM s UNION ALL SELECT NULL, CAST(sum(n_items) AS BIGINT), round(avg(accuracy), 4) FROM s""")
def q_option_match(spark, sf_dir):
    return X.option_match(V.option_rows(spark, sf_dir))


@query("option_bias", f"""WITH {V.OPTION_ROWS},
v AS (SELECT {_LETTER} AS letter, 1 AS said, 0 AS gold FROM option_rows UNION ALL SELECT gold, 0, 1 FROM option_rows),
c AS (SELECT letter, CAST(sum(said) AS BIGINT) AS predicted, CAST(sum(gold) AS BIGINT) AS gold FROM v WHERE letter IS NOT NULL GROUP BY 1),
t AS (SELECT *, sum(predicted) OVER () AS p, sum(gold) OVER () AS g FROM c)
SELECT letter, predicted, gold, round(predicted / p, 4) AS predicted_share, round(gold / g, 4) AS gold_share, round(predicted / p - gold / g, 4) AS bias FROM t""")
def q_option_bias(spark, sf_dir):
    return X.option_bias(V.option_rows(spark, sf_dir))


@query("option_consistency", f"""
WITH {V.OPTION_ROWS}, c AS (SELECT item // 4 AS item, CASE WHEN item % 8 < 4 THEN chr((65 + (9 - item % 4) % 4)::INT) ELSE {_LETTER} END AS letter, item % 4 AS turned FROM option_rows),
t AS (SELECT item, (strpos('ABCD', letter) - 1 + turned) % 4 AS content FROM c)
SELECT item, count(*) AS n_orders, count(content) = count(*) AND count(DISTINCT content) = 1 AS consistent FROM t GROUP BY item""")
def q_option_consistency(spark, sf_dir):
    """Four neighbouring parts count as four orderings of one item, the options turned by 0 to 3 places.

    Every other item is answered with the letter that stands for the same content each time.
    """
    rows, turned = V.option_rows(spark, sf_dir), F.col("item") % 4
    steady = F.char(65 + (9 - turned) % 4)
    letter = F.when(F.col("item") % 8 < 4, steady).otherwise(X.extract_option(F.col("output")))
    asked = rows.select(F.floor(F.col("item") / 4).cast("bigint").alias("item"), letter.alias("letter"), turned.cast("int").alias("turned"))
    return X.permutation_consistency(asked.withColumn("content", X.chosen_content("letter", "turned", 4)), "item", "content")


_TOKENS = f"""tk AS (SELECT id, {sql_words(sql_clean('prediction'))} AS p, {sql_words(sql_clean('reference'))} AS r FROM both_pairs),
wt AS (SELECT id, 'p' AS side, unnest(p) AS tok, generate_subscripts(p, 1) AS i FROM tk UNION ALL SELECT id, 'r', unnest(r), generate_subscripts(r, 1) FROM tk)"""


def sql_gram_counts(n: int) -> str:
    """CTE ``c{n}``: how often each n-gram occurs on either side of a pair."""
    gram = " || ' ' || ".join(["tok"] + [f"lead(tok, {j}) OVER x" for j in range(1, n)])
    return f"""c{n} AS (SELECT id, g, count(*) FILTER (side = 'p') AS np, count(*) FILTER (side = 'r') AS nr
  FROM (SELECT id, side, {gram} AS g FROM wt WINDOW x AS (PARTITION BY id, side ORDER BY i)) WHERE g IS NOT NULL GROUP BY id, g)"""


@query("rouge_n", f"""WITH {_PAIRS}, {_TOKENS}, {sql_gram_counts(2)},
sc AS (SELECT id, sum(least(np, nr))::DOUBLE AS o, sum(np) AS np, sum(nr) AS nr FROM c2 GROUP BY id),
pr AS (SELECT tk.id, CASE WHEN coalesce(np, 0) = 0 OR coalesce(nr, 0) = 0 THEN 0.0::DOUBLE ELSE o / np END AS precision, CASE WHEN coalesce(np, 0) = 0 OR coalesce(nr, 0) = 0 THEN 0.0::DOUBLE ELSE o / nr END AS recall FROM tk LEFT JOIN sc USING (id)),
fs AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0::DOUBLE ELSE 2 * precision * recall / (precision + recall) END AS f1_score FROM pr) {_ROUNDED}""")
def q_rouge(spark, sf_dir):
    return rounded(X.rouge_n(both_pairs(spark, sf_dir), 2))


@query("corpus_bleu", f"""WITH {_PAIRS}, {_TOKENS}, {", ".join(sql_gram_counts(n) for n in range(1, 5))},
{", ".join(f"m{n} AS (SELECT sum(least(np, nr))::DOUBLE AS match_{n}, sum(np)::DOUBLE AS total_{n} FROM c{n})" for n in range(1, 5))},
l AS (SELECT CAST(sum(len(p)) AS BIGINT) AS p_len, CAST(sum(len(r)) AS BIGINT) AS r_len FROM tk),
b AS (SELECT *, CASE WHEN p_len > r_len THEN 1.0::DOUBLE ELSE exp(1 - r_len::DOUBLE / p_len) END AS bp FROM l, m1, m2, m3, m4)
SELECT p_len, r_len, round(match_1 / total_1, 4) AS p1, round(match_2 / total_2, 4) AS p2, round(match_3 / total_3, 4) AS p3, round(match_4 / total_4, 4) AS p4,
  round(bp, 4) AS brevity,
  round(bp * exp((ln(match_1 / total_1) + ln(match_2 / total_2) + ln(match_3 / total_3) + ln(match_4 / total_4)) / 4), 4) AS bleu
FROM b""")
def q_bleu(spark, sf_dir):
    return X.corpus_bleu(both_pairs(spark, sf_dir))
