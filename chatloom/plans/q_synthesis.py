"""Queries over synthesis. Rows of the given tables provide the ids the samples are drawn for."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.functions.seeded import flip, pick
from chatloom.operators import catalogue as C
from chatloom.operators import synthesis as S
from chatloom.plans.registry import query, sql_choice, sql_list, sql_seeded, sql_text, table

SEED = 7
EXACTLY = 500  # samples asked for
_RANGE = 1 << 32


def sql_flip(p: float, salt: str, id_sql: str) -> str:
    return f"{sql_seeded(SEED, salt, id_sql)} < {int(p * _RANGE)}"


def sql_pick(options: list[str], salt: str, id_sql: str) -> str:
    return sql_choice(options, sql_seeded(SEED, salt, id_sql))


def sql_nested(values) -> str:
    return "[" + ", ".join(sql_list(list(v)) for v in values) + "]"


def sql_intensify(c: str, id_sql: str) -> str:
    word = sql_pick(C.INTENSIFIERS, "intensifier", id_sql)
    cases = " ".join(f"WHEN contains({c}, '{a}') THEN replace({c}, '{a}', {word} || ' {a}')" for a in C.ADJECTIVES)
    return f"CASE WHEN NOT ({sql_flip(0.2, 'intensify', id_sql)}) THEN {c} {cases} ELSE {c} END"


def sql_punctuate(c: str, id_sql: str) -> str:
    return f"CASE WHEN right({c}, 1) IN ('.', '!') THEN left({c}, length({c}) - 1) || {sql_pick(C.ENDINGS, 'ending', id_sql)} ELSE {c} END"


def sql_case(c: str, id_sql: str) -> str:
    return f"CASE WHEN {sql_flip(0.05, 'lower', id_sql)} THEN lower({c}) WHEN {sql_flip(0.02, 'upper', id_sql)} THEN upper(replace({c}, 'ß', 'SS')) ELSE {c} END"


_LABEL = "CASE WHEN contains(category, 'positive') THEN 'Positive' WHEN contains(category, 'negative') THEN 'Negative' ELSE 'Neutral' END"


@query("seeded_choice", f"""
SELECT o_orderkey AS id, {sql_pick(C.ENDINGS, 'demo', 'o_orderkey::VARCHAR')} AS choice, {sql_flip(0.2, 'demo2', 'o_orderkey::VARCHAR')} AS flipped FROM orders""")
def seeded_choice(spark, sf_dir):
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("id"), pick(C.ENDINGS, SEED, "demo", key).alias("choice"), flip(0.2, SEED, "demo2", key).alias("flipped")
    )


@query("label_from_category", f"""
WITH c AS (SELECT o_orderkey AS id, {sql_pick(list(C.TEMPLATES), 'cat', 'o_orderkey::VARCHAR')} AS category FROM orders)
SELECT id, category, {_LABEL} AS label FROM c""")
def label_from_category(spark, sf_dir):
    key = F.col("o_orderkey")
    named = table(spark, sf_dir, "orders").select(key.alias("id"), pick(list(C.TEMPLATES), SEED, "cat", key).alias("category"))
    return named.withColumn("label", S.label_from_category(F.col("category")))


@query("expand_templates", f"""
WITH t AS (SELECT p_partkey AS id, p_name, {sql_pick(list(C.LEXICON), 'dom', 'p_partkey::VARCHAR')} AS domain,
   unnest({sql_nested(C.TEMPLATES.values())}[{sql_seeded(SEED, 'cat', 'p_partkey::VARCHAR')} % {len(C.TEMPLATES)} + 1]) AS template FROM part)
SELECT id, template, unnest([p_name, domain]) AS noun, replace(template, '{{domain}}', unnest([p_name, domain])) AS text FROM t""")
def expand_templates(spark, sf_dir):
    """Each part fills all templates of one category with its own name and with a domain word."""
    key = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(
        key.alias("id"),
        F.explode(F.get(S._nested(list(C.TEMPLATES.values())), S.pick_index(len(C.TEMPLATES), SEED, "cat", key))).alias("template"),
        F.array("p_name", pick(list(C.LEXICON), SEED, "dom", key)).alias("nouns"),
    )
    return S.expand_templates(rows, "template", "nouns").select("id", "template", "noun", "text")


_ID = "id::VARCHAR"
_TWO_STAGE = f"""
g AS (SELECT id, {sql_pick(list(C.TEMPLATES), 'category', _ID)} AS category, {sql_nested(C.TEMPLATES.values())}[{sql_seeded(SEED, 'category', _ID)} % {len(C.TEMPLATES)} + 1] AS grp,
   {sql_pick(list(C.LEXICON), 'domain', _ID)} AS domain, {sql_nested(C.LEXICON.values())}[{sql_seeded(SEED, 'domain', _ID)} % {len(C.LEXICON)} + 1] AS nouns FROM ids),
n AS (SELECT id, category, domain, grp[{sql_seeded(SEED, 'template', _ID)} % len(grp) + 1] AS template, nouns[{sql_seeded(SEED, 'noun', _ID)} % len(nouns) + 1] AS noun FROM g),
two AS (SELECT *, replace(template, '{{domain}}', noun) AS text FROM n)"""


@query("sample_two_stage", f"WITH ids AS (SELECT o_orderkey AS id FROM orders), {_TWO_STAGE} SELECT id, category, template, domain, noun, text FROM two")
def sample_two_stage(spark, sf_dir):
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return S.sample_two_stage(ids, "id", SEED)


_GROUPS = [[t for c, ts in C.TEMPLATES.items() if p in c for t in ts] for p in ("positive", "negative")]


@query("sample_label_first", f"""
WITH ids AS (SELECT o_orderkey AS id FROM orders),
g AS (SELECT id, {sql_pick(['Positive', 'Negative'], 'label', _ID)} AS label, {sql_nested(_GROUPS)}[{sql_seeded(SEED, 'label', _ID)} % 2 + 1] AS grp, {sql_pick(list(C.LEXICON), 'domain', _ID)} AS domain FROM ids),
t AS (SELECT id, label, domain, grp[{sql_seeded(SEED, 'template', _ID)} % len(grp) + 1] AS template FROM g)
SELECT id, label, template, domain, replace(template, '{{domain}}', domain) AS text FROM t""")
def sample_label_first(spark, sf_dir):
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return S.sample_label_first(ids, "id", SEED)


@query("inject_intensifier", f"""
WITH d AS (SELECT o_orderkey AS id, {sql_pick([a + ' thing, ' + b for a, b in zip(C.ADJECTIVES, C.ADJECTIVES[::-1])] + ['plain text'], 'x', 'o_orderkey::VARCHAR')} AS text FROM orders
  UNION ALL SELECT -1 - doc_id, text FROM documents)
SELECT id, {sql_intensify('text', _ID)} AS text FROM d""")
def inject_intensifier(spark, sf_dir):
    options = [a + " thing, " + b for a, b in zip(C.ADJECTIVES, C.ADJECTIVES[::-1])] + ["plain text"]
    key = F.col("o_orderkey")
    made = table(spark, sf_dir, "orders").select(key.alias("id"), pick(options, SEED, "x", key).alias("text"))
    docs = table(spark, sf_dir, "documents").select((-1 - F.col("doc_id")).alias("id"), "text")
    return made.unionByName(docs).select("id", S.inject_intensifier(F.col("text"), SEED, F.col("id")).alias("text"))


@query("vary_punctuation", f"SELECT doc_id AS id, {sql_punctuate('text', 'doc_id::VARCHAR')} AS text FROM documents")
def vary_punctuation(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), S.vary_punctuation(F.col("text"), SEED, F.col("doc_id")).alias("text"))


@query("vary_casing", f"SELECT doc_id AS id, {sql_case('text', 'doc_id::VARCHAR')} AS text FROM documents")
def vary_casing(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), S.vary_casing(F.col("text"), SEED, F.col("doc_id")).alias("text"))


@query("wrap_instruction", f"""
SELECT doc_id AS id, replace({sql_pick(C.INSTRUCTIONS, 'instruction', 'doc_id::VARCHAR')}, '{{text}}', text) AS varied, replace({sql_text(C.INSTRUCTIONS[0])}, '{{text}}', text) AS fixed FROM documents""")
def wrap_instruction(spark, sf_dir):
    key = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        key.alias("id"), S.wrap_instruction(F.col("text"), SEED, key).alias("varied"),
        S.wrap_instruction(F.col("text"), SEED, key, formats=C.INSTRUCTIONS[:1]).alias("fixed"),
    )


@query("wrap_task", f"""
SELECT conv_id, turn, replace({sql_list(list(C.TASK_ENVELOPES.values()))}[(conv_id + turn) % 4 + 1], '{{text}}', text) AS prompt FROM conversations""")
def wrap_task(spark, sf_dir):
    names = F.array(*[F.lit(n) for n in C.TASK_ENVELOPES])
    task = F.get(names, ((F.col("conv_id") + F.col("turn")) % 4).cast("int"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", S.wrap_task(F.col("text"), task).alias("prompt"))


_MUTATED = f"""
m1 AS (SELECT id, category, {sql_intensify('text', _ID)} AS text FROM two),
m2 AS (SELECT id, category, {sql_punctuate('text', _ID)} AS text FROM m1),
m3 AS (SELECT id, category, {sql_case('text', _ID)} AS text FROM m2)"""


@query("synthesise_dataset", f"""
WITH ids AS (SELECT o_orderkey AS id FROM orders), {_TWO_STAGE}, {_MUTATED},
f AS (SELECT * FROM (SELECT * FROM m3 QUALIFY row_number() OVER (PARTITION BY text ORDER BY id) = 1) ORDER BY id LIMIT {EXACTLY})
SELECT id, category, text, {_LABEL} AS label, replace({sql_pick(C.INSTRUCTIONS, 'instruction', _ID)}, '{{text}}', text) AS user_content, {_LABEL} AS model_content FROM f""")
def synthesise_dataset(spark, sf_dir):
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    made = S.synthesise(ids, "id", SEED, EXACTLY)
    return made.select(
        "id", "category", "text", "label", F.col("messages")[0]["content"].alias("user_content"), F.col("messages")[1]["content"].alias("model_content")
    )
