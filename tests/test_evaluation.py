import math
import random

import pytest
from pyspark.sql import functions as F

from chatloom.operators import labels as L
from chatloom.operators import preference as P

CASES = [("a", "Positive", " positive\n"), ("a", "Negative", "Positive"), ("b", "Neutral", None), ("b", "Negative", "NEGATIVE"), ("b", "Positive", "maybe")]


@pytest.fixture()
def cases(spark):
    return spark.createDataFrame([(i, *c) for i, c in enumerate(CASES)], "id int, category string, expected string, predicted string")


def test_accuracy_counts_failures_as_wrong(cases):
    row = L.label_accuracy(cases).first()
    assert (row.total, row.correct, row.accuracy_pct) == (5, 2, 40.0)
    by = {r.category: (r.correct, r.total) for r in L.accuracy_by(cases, ["category"]).collect()}
    assert by == {"a": (1, 2), "b": (1, 3), None: (2, 5)}


def test_accuracy_of_nothing(cases):
    row = L.label_accuracy(cases.filter("id < 0")).first()
    assert (row.total, row.correct, row.accuracy_pct) == (0, 0, None)


def test_verdict_edges(spark):
    df = spark.createDataFrame([(8, 8), (4, 5), (7, 9), (0, 1)], "c int, t int")
    assert [r.v for r in df.select(L.verdict(F.col("c"), F.col("t")).alias("v")).collect()] == ["perfect", "excellent", "needs training", "needs training"]


def test_confusion_cells_add_up(cases):
    labels = ["Positive", "Negative", "Neutral"]
    cells = L.confusion_matrix(cases, labels).collect()
    assert len(cells) == 12 and sum(c.n for c in cells) == 5
    assert {(c.expected, c.predicted): c.n for c in cells}[("Positive", None)] == 2  # " positive\n" and "maybe" are no labels


def test_class_never_predicted_scores_zero(spark):
    df = spark.createDataFrame([("x", "x"), ("y", "x")], "expected string, predicted string")
    got = {r.label: r for r in L.class_metrics(df, ["x", "y"]).collect()}
    assert (got["y"].precision, got["y"].recall, got["y"].f1) == (0.0, 0.0, 0.0)
    assert (got["x"].precision, got["x"].recall, got["x"].f1) == (0.5, 1.0, 0.6667)
    assert got["macro"].f1 == 0.3333 and got["micro"].precision == 0.5


def test_regression_diff(spark):
    a = spark.createDataFrame([(1, "c", "x", "x"), (2, "c", "x", "y"), (3, "c", "x", None), (4, "c", "x", "x")], "id int, cat string, expected string, predicted string")
    b = spark.createDataFrame([(1, "c", "x", "y"), (2, "c", "x", "x"), (3, "c", "x", "x"), (5, "d", "x", "x")], "id int, cat string, expected string, predicted string")
    got = {(r.cat, r.status): r.n for r in L.regression_diff(a, b, "id", "cat").collect()}
    assert got == {("c", "broken"): 1, ("c", "fixed"): 1, ("c", "missing"): 2, ("d", "missing"): 1}


def test_pass_at_k_equals_the_binomials(spark):
    groups = {"p": (10, 3), "q": (4, 0), "r": (5, 5), "s": (2, 1)}
    rows = [(g, i < c) for g, (n, c) in groups.items() for i in range(n)]
    got = {r.problem: r for r in P.pass_at_k(spark.createDataFrame(rows, "problem string, passed boolean"), "problem", "passed", [1, 3]).collect()}
    for g, (n, c) in groups.items():
        for k in (1, 3):
            want = None if n < k else 1 - math.comb(n - c, k) / math.comb(n, k)
            have = got[g][f"pass_{k}"]
            assert have is None if want is None else have == pytest.approx(want)


def test_swap_needs_both_orders(spark):
    rows = [(1, "m", "n", "a", "m", 0.9), (1, "m", "n", "b", "m", 0.4), (2, "m", "n", "a", "m", 0.9), (2, "m", "n", "b", "n", 0.1), (3, "m", "n", "a", "n", 0.5)]
    met = P.swap_outcomes(spark.createDataFrame(rows, "item int, a string, b string, first_slot string, winner string, p_a double"))
    assert {r.item: r.outcome for r in met.collect()} == {1: "a", 2: "tie", 3: "incomplete"}
    assert {r.item: r.geo_outcome for r in P.swap_geometric(met).filter("item < 3").collect()} == {1: "a", 2: "tie"}


def test_bradley_terry_recovers_odds(spark):
    matrix = spark.createDataFrame([("a", "b", 10, 1, 0), ("b", "a", 1, 10, 0)], "model string, opponent string, wins long, losses long, ties long")
    got = {r.model: r for r in P.bradley_terry(matrix, pseudo=0.0, tolerance=1e-9).collect()}
    assert got["a"].elo - got["b"].elo == pytest.approx(400, abs=0.5)
    assert got["a"].theta + got["b"].theta == pytest.approx(0)
    whitewash = spark.createDataFrame([("a", "b", 5, 0, 0), ("b", "a", 0, 5, 0)], "model string, opponent string, wins long, losses long, ties long")
    assert all(math.isfinite(r.elo) for r in P.bradley_terry(whitewash).collect())


@pytest.mark.parametrize("n,reach,block,tolerance,slack", [(20, 1, 512, 1e-8, 1e-6), (8, 7, 4, 1e-3, 0.05)])
def test_bradley_terry_is_stationary(spark, n, reach, block, tolerance, slack):
    """A ring in one block, and a full tournament in two."""
    rng = random.Random(2)
    met = {(i, (i + d) % n): (rng.randint(0, 9), rng.randint(0, 9)) for i in range(n) for d in range(1, reach + 1) if reach == 1 or i + d < n}
    lines = [(f"m{a:02d}", f"m{b:02d}", w, x, 0) for (a, b), (w, x) in met.items()]
    matrix = spark.createDataFrame(lines + [(b, a, x, w, 0) for a, b, w, x, _ in lines], "model string, opponent string, wins long, losses long, ties long")
    got = {int(r.model[1:]): r.theta for r in P.bradley_terry(matrix, tolerance=tolerance, block=block).collect()}
    slope = dict.fromkeys(got, 0.0)
    for (a, b), (w, x) in met.items():
        gap = w + 0.5 - (w + x + 1) / (1 + math.exp(got[b] - got[a]))
        slope[a] += gap
        slope[b] -= gap
    assert max(map(abs, slope.values())) < slack and abs(sum(got.values())) < 1e-9


def test_route_tiers_takes_samples_of_any_size(spark):
    df = spark.range(3000).select("id", (F.col("id") % 10 == 0).alias("bad"), (F.col("id") % 10 == 1).alias("odd"))
    for n in (0, 1, 700, 5000):
        got = P.route_tiers(df, "id", F.col("bad"), F.col("odd"), n, 3)
        counts = {r.tier: r["count"] for r in got.groupBy("tier").count().collect()}
        assert counts.get("judge", 0) == min(n, 2400) and counts["rejected"] == counts["human"] == 300


def test_expected_score_renormalises(spark):
    df = spark.createDataFrame([(1, {1: math.log(0.1), 5: math.log(0.3)})], "item int, logprobs map<int,double>")
    assert P.expected_score(df).first().expected_score == pytest.approx(4.0)


def test_expected_score_of_every_row(spark):
    rows = [(1, {1: math.log(0.2), 2: math.log(0.2)}), (2, {5: -800.0, 1: -800.0 + math.log(3.0)}), (3, {}), (4, None)]
    got = {r.item: r.expected_score for r in P.expected_score(spark.createDataFrame(rows, "item int, logprobs map<int,double>")).collect()}
    assert got[1] == pytest.approx(1.5) and got[2] == pytest.approx(2.0) and got[3] is None and got[4] is None


def test_calibration(spark):
    df = spark.createDataFrame([(1.0, True), (0.95, False), (0.05, False)], "conf double, correct boolean")
    row = P.calibration_error(P.calibration_bins(df)).first()
    assert row.ece == round((2 * abs(0.975 - 0.5) + 0.05) / 3, 4)


def test_kappa(spark):
    votes = [(i, "x", a) for i, a in enumerate("aabb")] + [(i, "y", a) for i, a in enumerate("aaba")]
    row = P.annotator_agreement(spark.createDataFrame(votes, "i int, r string, l string"), "i", "r", "l", ["x", "y"]).first()
    assert (row.n, row.agreement, row.kappa) == (4, 0.75, 0.5)


def test_safety_missing_attribute_is_no_violation(spark):
    df = spark.createDataFrame([(1, {"toxicity": 0.9}), (2, {})], "id int, scores map<string,double>")
    got = {r.id: (r.violations, r.blocked) for r in P.safety_flags(df, {"toxicity": 0.9, "insult": 0.1}).collect()}
    assert got == {1: (["toxicity"], True), 2: ([], False)}


def test_routing_precedence(spark):
    df = spark.range(300).select("id", (F.col("id") % 10 == 0).alias("bad"), (F.col("id") % 5 == 0).alias("odd"))
    tiers = {r.tier: r["count"] for r in P.route_tiers(df, "id", F.col("bad"), F.col("odd"), 100, 1).groupBy("tier").count().collect()}
    assert tiers == {"rejected": 30, "human": 30, "judge": 100, "programmatic": 140}
    with pytest.raises(ValueError):
        P.route_tiers(df, "id", F.col("bad"), F.col("odd"), 501, 1)
