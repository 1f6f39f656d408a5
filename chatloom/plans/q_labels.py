"""Queries over label-level metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.operators import labels as L
from chatloom.plans import views as V
from chatloom.plans.registry import query, table

_HIT = "coalesce(predicted = expected, false)::INT"
_ACC = f"count(*) AS total, CAST(sum({_HIT}) AS BIGINT) AS correct, round(avg({_HIT}) * 100, 1) AS accuracy_pct"


@query("align_predictions", f"WITH {V.GOLD_PRED} SELECT id, category, expected, predicted FROM gold_pred")
def align_predictions(spark, sf_dir):
    both = V.gold_pred(spark, sf_dir)
    said = both.filter("predicted IS NOT NULL").select("id", "predicted")
    return L.align_predictions(both.select("id", "category", "expected"), said, "id")


@query("label_accuracy", f"WITH {V.GOLD_PRED} SELECT {_ACC} FROM gold_pred")
def label_accuracy(spark, sf_dir):
    return L.label_accuracy(V.gold_pred(spark, sf_dir))


@query("accuracy_by_category", f"WITH {V.GOLD_PRED} SELECT category, {_ACC} FROM gold_pred GROUP BY ROLLUP (category)")
def accuracy_by_category(spark, sf_dir):
    return L.accuracy_by(V.gold_pred(spark, sf_dir), ["category"])


@query("verdict", f"""WITH {V.GOLD_PRED}, s AS (SELECT source, {_ACC} FROM gold_pred GROUP BY source)
SELECT source, total, correct, CASE WHEN correct = total THEN 'perfect' WHEN 5 * correct >= 4 * total THEN 'excellent' ELSE 'needs training' END AS verdict FROM s""")
def verdict(spark, sf_dir):
    per_source = L.accuracy_by(V.gold_pred(spark, sf_dir), ["source"]).filter("source IS NOT NULL")
    return per_source.select("source", "total", "correct", L.verdict(F.col("correct"), F.col("total")).alias("verdict"))


_GRID = "grid AS (SELECT e AS expected, p AS predicted FROM (VALUES ('0'), ('1')) a(e), (VALUES ('0'), ('1'), (NULL)) b(p))"
_CELLS = f"{_GRID}, cells AS (SELECT g.expected, g.predicted, count(x.id) AS n FROM grid g LEFT JOIN gold_pred x ON x.expected = g.expected AND x.predicted IS NOT DISTINCT FROM g.predicted GROUP BY ALL)"


@query("confusion_matrix", f"WITH {V.GOLD_PRED}, {_CELLS} SELECT expected, predicted, n FROM cells")
def confusion_matrix(spark, sf_dir):
    return L.confusion_matrix(V.gold_pred(spark, sf_dir), ["0", "1"])


@query("class_metrics", f"""WITH {V.GOLD_PRED}, {_CELLS},
c AS (SELECT label, CAST(sum(n) FILTER (expected = label AND predicted IS NOT DISTINCT FROM label) AS BIGINT) AS tp,
  CAST(sum(n) FILTER (expected <> label AND predicted IS NOT DISTINCT FROM label) AS BIGINT) AS fp,
  CAST(sum(n) FILTER (expected = label AND predicted IS DISTINCT FROM label) AS BIGINT) AS fn,
  CAST(sum(n) FILTER (expected <> label AND predicted IS DISTINCT FROM label) AS BIGINT) AS tn
  FROM cells, (VALUES ('0'), ('1')) l(label) GROUP BY label),
m AS (SELECT * FROM c UNION ALL SELECT 'micro', CAST(sum(tp) AS BIGINT), CAST(sum(fp) AS BIGINT), CAST(sum(fn) AS BIGINT), CAST(sum(tn) AS BIGINT) FROM c),
r AS (SELECT *, coalesce((tp + tn) / nullif(tp + fp + fn + tn, 0), 0) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
   coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM m),
a AS (SELECT * FROM r UNION ALL SELECT 'macro', NULL, NULL, NULL, NULL, avg(accuracy), avg(precision), avg(recall), avg(f1) FROM r WHERE label <> 'micro')
SELECT label, tp, fp, fn, tn, round(accuracy, 4) AS accuracy, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1 FROM a""")
def class_metrics(spark, sf_dir):
    return L.class_metrics(V.gold_pred(spark, sf_dir), ["0", "1"])


@query("compare_variants", """
WITH w AS (SELECT user_id, max(props) FILTER (event_type = 'view') AS view, max(props) FILTER (event_type = 'click') AS click, max(props) FILTER (event_type = 'purchase') AS purchase,
  max(props) FILTER (event_type = 'signup') AS signup, max(props) FILTER (event_type = 'error') AS error FROM events GROUP BY user_id)
SELECT *, CAST(len(list_filter([view, click, purchase, signup, error], lambda x: x IS NOT NULL)) AS INTEGER) AS n_answers,
  len(list_distinct([view, click, purchase, signup, error])) <= 1 AS agree FROM w""")
def compare_variants(spark, sf_dir):
    return L.compare_variants(table(spark, sf_dir, "events"), "user_id", "event_type", "props", ["view", "click", "purchase", "signup", "error"])


@query("regression_diff", f"""WITH {V.GOLD_PRED}, {V.GOLD_PRED_B},
j AS (SELECT coalesce(a.category, b.category) AS category, a.predicted AS pa, b.predicted AS pb, a.predicted = a.expected AS oa, b.predicted = b.expected AS ob FROM gold_pred a FULL JOIN gold_pred_b b USING (id))
SELECT category, CASE WHEN pa IS NULL OR pb IS NULL THEN 'missing' WHEN NOT oa AND ob THEN 'fixed' WHEN oa AND NOT ob THEN 'broken' ELSE 'same' END AS status, count(*) AS n FROM j GROUP BY ALL""")
def regression_diff(spark, sf_dir):
    return L.regression_diff(V.gold_pred(spark, sf_dir), V.gold_pred_b(spark, sf_dir), "id", "category")


@query("new_and_gone_cases", """
SELECT coalesce(d.doc_id, c.item_id) AS id, CASE WHEN c.item_id IS NULL THEN 'only_a' WHEN d.doc_id IS NULL THEN 'only_b' ELSE 'both' END AS where_found
FROM (SELECT doc_id FROM labels) d FULL JOIN (SELECT conv_id + 50 AS item_id FROM conversations GROUP BY 1) c ON d.doc_id = c.item_id""")
def new_and_gone_cases(spark, sf_dir):
    a = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    b = table(spark, sf_dir, "conversations").select((F.col("conv_id") + 50).alias("id"))
    return L.case_sets(a, b, "id")


@query("prompt_sensitivity", f"""WITH {V.GOLD_PRED}, p AS (SELECT category, source, avg({_HIT}) AS acc FROM gold_pred GROUP BY ALL)
SELECT category, count(*) AS n_phrasings, round(min(acc), 4) AS worst, round(max(acc), 4) AS best, round(max(acc) - min(acc), 4) AS spread, round(stddev_pop(acc), 4) AS stddev FROM p GROUP BY category""")
def prompt_sensitivity(spark, sf_dir):
    return L.prompt_sensitivity(V.gold_pred(spark, sf_dir), "category", "source")
