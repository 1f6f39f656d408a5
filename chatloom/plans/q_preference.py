"""Queries over judges, preferences, calibration, safety and routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.operators import preference as P
from chatloom.plans import views as V
from chatloom.plans.registry import query, sql_seeded, table

_KS = [1, 5, 10]


def _sql_pass(k: int) -> str:
    terms = " * ".join(f"((n - c - {i})::DOUBLE / (n - {i}))" for i in range(k))
    return f"CASE WHEN n < {k} THEN NULL WHEN n - c < {k} THEN 1.0::DOUBLE ELSE 1 - {terms} END"


@query("pass_at_k", f"""WITH {V.ATTEMPTS}, g AS (SELECT problem, count(*) AS n, CAST(sum(passed::INT) AS BIGINT) AS c FROM attempts GROUP BY 1)
SELECT problem, n, c, {", ".join(f"round({_sql_pass(k)}, 4) AS pass_{k}" for k in _KS)} FROM g""")
def pass_at_k(spark, sf_dir):
    scored = P.pass_at_k(V.attempts(spark, sf_dir), "problem", "passed", _KS)
    return scored.select("problem", "n", "c", *[F.round(f"pass_{k}", 4).alias(f"pass_{k}") for k in _KS])


@query("pass_at_k_mean", f"""WITH {V.ATTEMPTS}, g AS (SELECT problem, count(*) AS n, sum(passed::INT) AS c FROM attempts GROUP BY 1),
v AS ({" UNION ALL ".join(f"SELECT CAST({k} AS INTEGER) AS k, {_sql_pass(k)} AS v FROM g" for k in _KS)})
SELECT k, round(avg(v), 4) AS pass_at_k, count(v) AS problems, count(*) - count(v) AS too_few_attempts FROM v GROUP BY k""")
def pass_at_k_mean(spark, sf_dir):
    return P.pass_at_k_mean(P.pass_at_k(V.attempts(spark, sf_dir), "problem", "passed", _KS), _KS)


_OUT = V.VERDICTS + """,
met AS (SELECT x.item, x.a, x.b, x.winner AS w1, y.winner AS w2, x.p_a AS p1, y.p_a AS p2,
   CASE WHEN x.winner = x.a AND y.winner = x.a THEN 'a' WHEN x.winner = x.b AND y.winner = x.b THEN 'b' ELSE 'tie' END AS outcome
 FROM verdicts x JOIN verdicts y ON x.item = y.item WHERE x.first_slot = 'a' AND y.first_slot = 'b')"""


def outcomes(spark, sf_dir):
    return P.swap_outcomes(V.verdicts(spark, sf_dir))


@query("swap_consistent_wins", f"WITH {_OUT} SELECT item, a, b, outcome FROM met")
def swap_consistent_wins(spark, sf_dir):
    return outcomes(spark, sf_dir).select("item", "a", "b", "outcome")


@query("swap_geometric", f"""WITH {_OUT}, g AS (SELECT item, sqrt(p1 * p2) AS ga, sqrt((1 - p1) * (1 - p2)) AS gb, p1 + p2 AS t FROM met)
SELECT item, round(ga, 4) AS g_a, round(gb, 4) AS g_b, CASE WHEN t > 1 THEN 'a' WHEN t < 1 THEN 'b' ELSE 'tie' END AS geo_outcome FROM g""")
def swap_geometric(spark, sf_dir):
    scored = P.swap_geometric(outcomes(spark, sf_dir))
    return scored.select("item", F.round("g_a", 4).alias("g_a"), F.round("g_b", 4).alias("g_b"), "geo_outcome")


@query("position_bias", f"""WITH {_OUT},
d AS (SELECT count(*) AS decided, round(avg((winner = CASE first_slot WHEN 'a' THEN a ELSE b END)::INT), 4) AS first_slot_win_rate FROM verdicts WHERE winner <> 'tie'),
f AS (SELECT count(*) AS meetings, round(avg((w1 <> w2)::INT), 4) AS flip_rate FROM met)
SELECT * FROM d, f""")
def position_bias(spark, sf_dir):
    return P.position_bias(outcomes(spark, sf_dir))


@query("length_bias", f"""WITH {V.VERDICTS},
r AS (SELECT (a_len - b_len)::DOUBLE AS diff, CASE winner WHEN a THEN 1.0::DOUBLE WHEN b THEN 0.0::DOUBLE ELSE 0.5::DOUBLE END AS y,
   winner, CASE WHEN a_len > b_len THEN a WHEN a_len < b_len THEN b END AS longer FROM verdicts)
SELECT count(*) AS n, round(avg(CASE WHEN winner <> 'tie' THEN (winner = longer)::INT END), 4) AS longer_win_rate, round(corr(diff, y), 4) AS length_correlation FROM r""")
def length_bias(spark, sf_dir):
    return P.length_bias(V.verdicts(spark, sf_dir))


@query("length_normalised", """
SELECT doc_id, round(quality * 1000.0::DOUBLE / n_chars, 4) AS score_per_1000 FROM documents JOIN labels USING (doc_id)""")
def length_normalised(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id")
    return docs.select("doc_id", F.round(P.length_normalised(F.col("quality"), F.col("n_chars")), 4).alias("score_per_1000"))


@query("judge_panel", f"""WITH {V.JUDGE_SCORES}
SELECT item, model, count(*) AS n_judges, round(avg(score), 4) AS panel_score, round(stddev_pop(score), 4) AS spread FROM judge_scores WHERE judge_family <> model_family GROUP BY ALL""")
def judge_panel(spark, sf_dir):
    return P.judge_panel(V.judge_scores(spark, sf_dir))


@query("expected_score", f"""WITH {V.SCORE_LOGPROBS}
SELECT item, aspect, round(sum(score * exp(logprob)) / sum(exp(logprob)), 4) AS expected_score FROM score_logprobs GROUP BY ALL""")
def expected_score(spark, sf_dir):
    scored = P.expected_score(V.score_logprobs(spark, sf_dir))
    return scored.select("item", "aspect", F.round("expected_score", 4).alias("expected_score"))


_MATRIX = _OUT + """,
sides AS (SELECT a AS model, b AS opponent, outcome = 'a' AS w, outcome = 'b' AS l, outcome = 'tie' AS t FROM met UNION ALL SELECT b, a, outcome = 'b', outcome = 'a', outcome = 'tie' FROM met),
matrix AS (SELECT model, opponent, CAST(sum(w::INT) AS BIGINT) AS wins, CAST(sum(l::INT) AS BIGINT) AS losses, CAST(sum(t::INT) AS BIGINT) AS ties FROM sides GROUP BY ALL)"""


@query("win_matrix", f"WITH {_MATRIX} SELECT model, opponent, wins, losses, ties, round(wins / (wins + losses + ties), 4) AS win_rate FROM matrix")
def win_matrix(spark, sf_dir):
    return P.win_matrix(outcomes(spark, sf_dir))


@query("bradley_terry", f"""WITH RECURSIVE {_MATRIX},
games AS (SELECT model, opponent, wins + ties / 2.0::DOUBLE + 0.5::DOUBLE AS w, wins + losses + ties + 1.0::DOUBLE AS n FROM matrix),
names AS (SELECT model, row_number() OVER (ORDER BY model) AS i FROM (SELECT DISTINCT model FROM games)),
won AS (SELECT i, sum(w) AS won FROM games JOIN names USING (model) GROUP BY i),
sched AS (SELECT x.i, list(y.i ORDER BY y.i) AS js, list(n ORDER BY y.i) AS ns FROM games g JOIN names x ON x.model = g.model JOIN names y ON y.model = g.opponent GROUP BY x.i),
plan AS (SELECT list({{'won': won, 'js': js, 'ns': ns}} ORDER BY i) AS rows FROM won JOIN sched USING (i)),
step AS (SELECT 0 AS it, list_transform(rows, lambda r: 1.0::DOUBLE) AS p, rows FROM plan
  UNION ALL SELECT it + 1, list_transform(rows, lambda r, i: r.won / list_sum(list_transform(r.js, lambda j, k: r.ns[k] / (p[i] + p[j])))), rows FROM step WHERE it < 1500),
last AS (SELECT unnest(p) AS p, unnest(range(1, len(p) + 1)) AS i FROM step WHERE it = 1500)
SELECT model, round(ln(p) - avg(ln(p)) OVER (), 3) AS theta, round(400 * log10(exp(1)) * (ln(p) - avg(ln(p)) OVER ()) + 1200, 1) AS elo FROM last JOIN names USING (i)""")
def bradley_terry(spark, sf_dir):
    """The SQL takes plain steps, many times as many as it needs."""
    rated = P.bradley_terry(P.win_matrix(outcomes(spark, sf_dir)))
    return rated.select("model", F.round("theta", 3).alias("theta"), F.round("elo", 1).alias("elo"))


@query("metric_grid", f"""WITH {V.GOLD_PRED},
c AS (SELECT source AS model, category AS scenario, avg(coalesce(expected = predicted, false)::INT) AS accuracy, avg(n_chars) AS length FROM gold_pred GROUP BY ALL),
r AS (SELECT *, percent_rank() OVER (PARTITION BY scenario ORDER BY accuracy) AS wa, percent_rank() OVER (PARTITION BY scenario ORDER BY length) AS wl FROM c),
u AS (SELECT model, scenario, accuracy, length, wa, wl FROM r UNION ALL SELECT model, 'all', avg(accuracy), avg(length), avg(wa), avg(wl) FROM r GROUP BY model)
SELECT model, scenario, round(accuracy, 4) AS accuracy, round(length, 4) AS length, round(wa, 4) AS win_rate_accuracy, round(wl, 4) AS win_rate_length FROM u""")
def metric_grid(spark, sf_dir):
    rows = V.gold_pred(spark, sf_dir).select(
        F.col("source").alias("model"), F.col("category").alias("scenario"),
        F.coalesce(F.col("expected") == F.col("predicted"), F.lit(False)).cast("int").alias("accuracy"), F.col("n_chars").alias("length"),
    )
    return P.metric_grid(rows, ["accuracy", "length"])


_BINS = V.CONFIDENCE + ", bins AS (SELECT CAST(least(floor(conf * 10), 9) AS INTEGER) AS bin, count(*) AS n, avg(conf) AS mean_conf, avg(correct::INT) AS accuracy FROM confidence GROUP BY 1)"


@query("calibration_bins", f"WITH {_BINS} SELECT bin, n, round(mean_conf, 4) AS mean_conf, round(accuracy, 4) AS accuracy FROM bins")
def calibration_bins(spark, sf_dir):
    bins = P.calibration_bins(V.confidence(spark, sf_dir))
    return bins.select("bin", "n", F.round("mean_conf", 4).alias("mean_conf"), F.round("accuracy", 4).alias("accuracy"))


@query("calibration_error", f"WITH {_BINS} SELECT CAST(sum(n) AS BIGINT) AS n, round(sum(abs(mean_conf - accuracy) * n) / sum(n), 4) AS ece, round(max(abs(mean_conf - accuracy)), 4) AS mce FROM bins")
def calibration_error(spark, sf_dir):
    return P.calibration_error(P.calibration_bins(V.confidence(spark, sf_dir)))


@query("slice_gap", f"""WITH {V.GOLD_PRED}, s AS (SELECT category, avg(coalesce(expected = predicted, false)::INT) AS m FROM gold_pred GROUP BY 1)
SELECT count(*) AS n_slices, (SELECT category FROM s ORDER BY m, category LIMIT 1) AS worst_slice, round(min(m), 4) AS worst,
  (SELECT category FROM s ORDER BY m DESC, category LIMIT 1) AS best_slice, round(max(m), 4) AS best, round(max(m) - min(m), 4) AS gap FROM s""")
def slice_gap(spark, sf_dir):
    hit = F.coalesce(F.col("expected") == F.col("predicted"), F.lit(False)).cast("int")
    return P.slice_gap(V.gold_pred(spark, sf_dir), "category", hit)


@query("annotator_agreement", f"""WITH {V.GOLD_PRED}, {V.GOLD_PRED_B},
p AS (SELECT 'human' AS a, 'rule' AS b, expected AS la, predicted AS lb FROM gold_pred UNION ALL SELECT 'human', 'strict', expected, predicted FROM gold_pred_b
  UNION ALL SELECT 'rule', 'strict', x.predicted, y.predicted FROM gold_pred x JOIN gold_pred_b y USING (id)),
f AS (SELECT * FROM p WHERE la IS NOT NULL AND lb IS NOT NULL),
t AS (SELECT a, b, count(*) AS n, avg((la = lb)::INT) AS po FROM f GROUP BY ALL),
m AS (SELECT a, b, l, sum((la = l)::INT)::DOUBLE AS na, sum((lb = l)::INT)::DOUBLE AS nb FROM f, (VALUES ('0'), ('1')) v(l) GROUP BY ALL),
e AS (SELECT a, b, n, po, (SELECT sum(na * nb) FROM m WHERE m.a = t.a AND m.b = t.b) / (n::DOUBLE * n) AS pe FROM t)
SELECT a AS rater_a, b AS rater_b, n, round(po, 4) AS agreement, round((po - pe) / (1 - pe), 4) AS kappa FROM e""")
def annotator_agreement(spark, sf_dir):
    rated = V.gold_pred(spark, sf_dir).withColumn("strict", F.when(F.col("n_chars") >= 2000, "1").otherwise("0"))
    votes = F.explode(F.array(*[
        F.struct(F.lit(name).alias("rater"), F.col(c).alias("label")) for name, c in (("human", "expected"), ("rule", "predicted"), ("strict", "strict"))
    ]))
    long = rated.select("id", votes.alias("v")).select("id", "v.rater", "v.label")
    return P.annotator_agreement(long, "id", "rater", "label", ["human", "rule", "strict"])


_THRESHOLDS = {"toxicity": 0.9, "severe_toxicity": 0.8, "insult": 0.95, "profanity": 0.99}
_LIMITS = ", ".join(f"('{a}', {i}, {t}::DOUBLE)" for i, (a, t) in enumerate(_THRESHOLDS.items()))
_FLAGS = f"""{V.SAFETY_SCORES}, flags AS (SELECT id, lang, toxic, coalesce(string_agg(attribute, ',' ORDER BY o) FILTER (score >= t), '') AS violations,
   bool_or(score >= t) AS blocked FROM safety_scores JOIN (VALUES {_LIMITS}) l(attribute, o, t) USING (attribute) GROUP BY ALL)"""


@query("safety_flags", f"WITH {_FLAGS} SELECT id, violations, blocked FROM flags")
def safety_flags(spark, sf_dir):
    flagged = P.safety_flags(V.safety_scores(spark, sf_dir), _THRESHOLDS)
    return flagged.select("id", F.array_join("violations", ",").alias("violations"), "blocked")


@query("safety_rates", f"""WITH {_FLAGS}
SELECT lang, count(*) AS n, round(avg(blocked::INT), 4) AS block_rate, round(coalesce(sum(blocked::INT * toxic) / nullif(sum(toxic), 0), 0), 4) AS recall,
  round(coalesce(sum(blocked::INT * toxic) / nullif(sum(blocked::INT), 0), 0), 4) AS precision FROM flags GROUP BY lang""")
def safety_rates(spark, sf_dir):
    flagged = P.safety_flags(V.safety_scores(spark, sf_dir), _THRESHOLDS)
    return P.safety_rates(flagged, ["lang"], F.col("toxic"))


@query("route_tiers", f"""WITH {V.SAFETY_SCORES},
t AS (SELECT id, toxic, max(score) FILTER (attribute = 'insult') AS insult, max(score) FILTER (attribute = 'profanity') AS profanity FROM safety_scores GROUP BY ALL),
f AS (SELECT *, CASE WHEN profanity >= 0.9 THEN 'rejected' WHEN toxic = 1 OR insult BETWEEN 0.45 AND 0.55 THEN 'human' END AS tier0 FROM t),
j AS (SELECT id FROM f WHERE tier0 IS NULL ORDER BY {sql_seeded(5, 'judge', 'id::VARCHAR')}, id LIMIT 100)
SELECT id, coalesce(tier0, CASE WHEN id IN (SELECT id FROM j) THEN 'judge' END, 'programmatic') AS tier FROM f""")
def route_tiers(spark, sf_dir):
    scored = V.safety_scores(spark, sf_dir)
    insult, profanity = F.col("scores")["insult"], F.col("scores")["profanity"]
    human = (F.col("toxic") == 1) | insult.between(0.45, 0.55)
    return P.route_tiers(scored, "id", profanity >= 0.9, human, 100, 5).select("id", "tier")
