"""Queries over dedup, distribution and quotas."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.operators import balance as B
from chatloom.operators import dedup as D
from chatloom.plans.q_texts import sql_clean, sql_words
from chatloom.plans.registry import query, sql_seeded, table, texts


@query("dedup_first", """
SELECT doc_id, text, lang, source FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""")
def dedup_first(spark, sf_dir):
    return D.dedup_first(texts(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"), "text", ["doc_id"])


@query("dedup_normalised", f"""
SELECT doc_id, text FROM documents QUALIFY row_number() OVER (PARTITION BY {sql_clean('text')} ORDER BY doc_id) = 1""")
def dedup_normalised(spark, sf_dir):
    return D.dedup_normalised(texts(spark, sf_dir, "documents", "doc_id", "text"), "text", ["doc_id"])


@query("near_dup_structure", f"""
WITH RECURSIVE w AS (SELECT doc_id, {sql_words(sql_clean('text'))} AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) >= 3 THEN [array_to_string(ws[i:i + 2], ' ') for i in range(1, len(ws) - 1)] ELSE [chr(1) || array_to_string(ws, ' ')] END) AS grams FROM w),
e AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS g FROM s),
p AS (SELECT b.doc_id AS id, a.doc_id AS head FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id AND a.n >= 0.7 * b.n AND b.n >= 0.7 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING count(*)::DOUBLE / (a.n + b.n - count(*)) >= 0.7),
q AS MATERIALIZED (SELECT id, list(head) AS heads, row_number() OVER (ORDER BY id) AS k FROM p GROUP BY id),
f AS (SELECT 0::BIGINT AS k, []::BIGINT[] AS gone
  UNION ALL SELECT q.k, CASE WHEN len(list_filter(heads, lambda h: NOT list_contains(gone, h))) > 0 THEN list_append(gone, q.id) ELSE gone END FROM f JOIN q ON q.k = f.k + 1),
r AS (SELECT unnest(gone) AS doc_id FROM (SELECT gone FROM f ORDER BY k DESC LIMIT 1))
SELECT doc_id, doc_id IN (SELECT doc_id FROM r) AS rejected FROM documents""")
def near_dup_structure(spark, sf_dir):
    """The SQL compares all pairs that share a shingle and then walks the rows in order."""
    found = D.near_dups(texts(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text")
    return found.select("doc_id", (F.col("kept_id") != F.col("doc_id")).alias("rejected"))


@query("label_distribution", """
WITH c AS (SELECT lang, quality::VARCHAR AS label, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY ALL),
g AS (SELECT lang, l.label FROM (SELECT DISTINCT lang FROM c), (VALUES ('0'), ('1'), ('2')) l(label)),
f AS (SELECT lang, g.label, coalesce(n, 0) AS n FROM g LEFT JOIN c USING (lang, label))
SELECT lang, label, n, round(100.0::DOUBLE * n / sum(n) OVER (PARTITION BY lang), 1) AS pct FROM f""")
def label_distribution(spark, sf_dir):
    langs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    joined = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("quality")).join(langs, "doc_id")
    return B.label_distribution(joined, "quality", ["0", "1", "2"], ["lang"])


@query("event_distribution", """
WITH c AS (SELECT event_type AS label, count(*) AS n FROM events GROUP BY 1 UNION ALL SELECT 'refund', 0)
SELECT label, n, round(100.0::DOUBLE * n / sum(n) OVER (), 1) AS pct FROM c""")
def event_distribution(spark, sf_dir):
    return B.label_distribution(table(spark, sf_dir, "events"), "event_type", ["signup", "purchase", "error", "view", "click", "refund"])


@query("majority_baseline", """
WITH c AS (SELECT lang, toxic::VARCHAR AS label, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, label) AS rn, sum(n) OVER (PARTITION BY lang) AS total, count(*) OVER (PARTITION BY lang) AS k FROM c)
SELECT lang, label AS majority_label, CAST(total AS BIGINT) AS total, round(n / total, 4) AS accuracy, k - 1 AS labels_never_found FROM r WHERE rn = 1""")
def majority_baseline(spark, sf_dir):
    langs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    joined = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("string").alias("toxic")).join(langs, "doc_id")
    return B.majority_baseline(joined, "toxic", ["lang"])


_TARGETS = {"de": 200, "en": 400, "es": 200, "fr": 200, "ja": 100}
_TARGET_ROWS = ", ".join(f"('{k}', {v})" for k, v in _TARGETS.items())


@query("quota_audit", f"""
WITH t AS (SELECT * FROM (VALUES {_TARGET_ROWS}) t(lang, target)), a AS (SELECT lang, count(*) AS actual FROM documents GROUP BY 1),
j AS (SELECT lang, coalesce(actual, 0) AS actual, CAST(coalesce(target, 0) AS BIGINT) AS target FROM a FULL JOIN t USING (lang))
SELECT lang, actual, target, actual - target AS gap, actual = target AS ok FROM j""")
def quota_audit(spark, sf_dir):
    return B.quota_audit(table(spark, sf_dir, "documents"), "lang", _TARGETS)


_QUOTAS = {"de": 100, "en": 200, "es": 50, "fr": 100_000, "ja": 10}


@query("quota_sample", f"""
WITH r AS (SELECT doc_id, lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY {sql_seeded(11, 'quota', 'doc_id::VARCHAR')}, doc_id) AS rn FROM documents)
SELECT doc_id, lang, n_chars FROM r JOIN (VALUES {", ".join(f"('{k}', {v})" for k, v in _QUOTAS.items())}) t(lang, q) USING (lang) WHERE rn <= q""")
def quota_sample(spark, sf_dir):
    return B.quota_sample(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), "lang", _QUOTAS, 11, "doc_id")


@query("crosstab_mix", """
SELECT lang, source, count(*) AS n, CAST(GROUPING_ID(lang, source) AS BIGINT) AS level FROM documents GROUP BY CUBE (lang, source)""")
def crosstab_mix(spark, sf_dir):
    return B.mix_cube(table(spark, sf_dir, "documents"), ["lang", "source"])
