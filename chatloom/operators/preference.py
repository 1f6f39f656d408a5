"""Judges, pairwise preferences, ratings, calibration, agreement, safety and routing."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions.seeded import draw
from chatloom.functions.text import let
from chatloom.plans.positions import smallest, with_places
from chatloom.session import cut_lineage, written


def pass_at_k(df: DataFrame, problem: str, passed: str, ks: Sequence[int]) -> DataFrame:
    """Unbiased pass@k per problem; null where fewer than ``k`` attempts exist.

    Uses the k-term product C(n-c,k)/C(n,k) = prod (n-c-i)/(n-i), so the cost depends on k,
    never on how many attempts a problem has.
    """
    counts = df.groupBy(problem).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(passed).cast("bigint")).alias("c"))

    def score(k: int) -> Column:
        misses = F.aggregate(
            F.sequence(F.lit(0), F.lit(k - 1)), F.lit(1.0),
            lambda acc, i: acc * (F.col("n") - F.col("c") - i).cast("double") / (F.col("n") - i).cast("double"),
        )
        return F.when(F.col("n") < k, None).when(F.col("n") - F.col("c") < k, 1.0).otherwise(1 - misses)

    return counts.select(problem, "n", "c", *[score(k).alias(f"pass_{k}") for k in ks])


def pass_at_k_mean(per_problem: DataFrame, ks: Sequence[int]) -> DataFrame:
    """Mean over the problems with enough attempts, and how many were too small."""
    rows = per_problem.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"pass_{k}").alias("v")) for k in ks])).alias("r"))
    return rows.groupBy(F.col("r.k").alias("k")).agg(
        F.round(F.avg("r.v"), 4).alias("pass_at_k"), F.count("r.v").alias("problems"), F.sum(F.col("r.v").isNull().cast("bigint")).alias("too_few_attempts")
    )


def swap_outcomes(df: DataFrame) -> DataFrame:
    """Meetings judged in both slot orders, one line each.

    Input ``item, a, b, first_slot, winner, p_a``. A win counts only if it holds in both orders,
    otherwise the meeting is a tie; one missing order makes it ``incomplete``. A grouped
    aggregate replaces the self-join: each order is read once and combined on the map side.
    """
    in_a, in_b = F.col("first_slot") == "a", F.col("first_slot") == "b"
    # verdicts as small numbers keep the aggregation hash-based
    said = F.when(F.col("winner") == F.col("a"), 1).when(F.col("winner") == F.col("b"), -1).when(F.col("winner").isNotNull(), 0)
    met = df.groupBy("item", "a", "b").agg(
        F.max(F.when(in_a, said)).alias("w1"), F.max(F.when(in_b, said)).alias("w2"),
        F.max(F.when(in_a, F.col("p_a"))).alias("p1"), F.max(F.when(in_b, F.col("p_a"))).alias("p2"),
    )
    outcome = (
        F.when(F.col("w1").isNull() | F.col("w2").isNull(), "incomplete")
        .when(F.col("w1") + F.col("w2") == 2, "a").when(F.col("w1") + F.col("w2") == -2, "b").otherwise("tie")
    )
    return met.withColumn("outcome", outcome)


def swap_geometric(outcomes: DataFrame) -> DataFrame:
    """Geometric means of the two win probabilities, and who has the larger one."""
    scored = outcomes.withColumn("g_a", F.sqrt(F.col("p1") * F.col("p2"))).withColumn("g_b", F.sqrt((1 - F.col("p1")) * (1 - F.col("p2"))))
    # p1 p2 > (1-p1)(1-p2) reduces to p1 + p2 > 1, which keeps exact ties exact
    total = F.col("p1") + F.col("p2")
    return scored.withColumn("geo_outcome", F.when(total > 1, "a").when(total < 1, "b").when(total == 1, "tie"))


def position_bias(outcomes: DataFrame) -> DataFrame:
    """Win rate of the first slot over decided verdicts; share of meetings whose verdict flips on swap.

    ``w1`` is the verdict with ``a`` first, ``w2`` the one with ``b`` first (1 = a, -1 = b, 0 = tie).
    """
    def total(cond: Column) -> Column:
        return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")

    decided = total(F.col("w1") != 0) + total(F.col("w2") != 0)
    first_won = total(F.col("w1") == 1) + total(F.col("w2") == -1)
    both = F.col("outcome") != "incomplete"
    return outcomes.agg(
        decided.alias("decided"), F.round(F.try_divide(first_won.cast("double"), decided), 4).alias("first_slot_win_rate"),
        total(both).alias("meetings"), F.round(F.try_divide(total(both & (F.col("w1") != F.col("w2"))).cast("double"), total(both)), 4).alias("flip_rate"),
    )


def length_bias(df: DataFrame) -> DataFrame:
    """Does the longer answer win? Input ``a, b, winner, a_len, b_len``."""
    diff = (F.col("a_len") - F.col("b_len")).cast("double")
    outcome = F.when(F.col("winner") == F.col("a"), 1.0).when(F.col("winner") == F.col("b"), 0.0).otherwise(0.5)
    longer = F.when(diff > 0, F.col("a")).when(diff < 0, F.col("b"))
    rows = df.select(diff.alias("diff"), outcome.alias("y"), (F.col("winner") == longer).cast("double").alias("long_won"), "winner")
    return rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(F.when(F.col("winner") != "tie", F.col("long_won"))), 4).alias("longer_win_rate"),
        F.round(F.corr("diff", "y"), 4).alias("length_correlation"),
    )


def length_normalised(score: Column, length: Column, unit: float = 1000.0) -> Column:
    """Score per ``unit`` characters."""
    return F.try_divide(score * unit, length)


def judge_panel(df: DataFrame, item: Sequence[str] = ("item", "model")) -> DataFrame:
    """Mean and spread over judges, leaving out judges of the candidate's own family."""
    fair = df.filter(F.col("judge_family") != F.col("model_family"))
    return fair.groupBy(*item).agg(
        F.count(F.lit(1)).alias("n_judges"), F.round(F.avg("score"), 4).alias("panel_score"), F.round(F.stddev_pop("score"), 4).alias("spread")
    )


def expected_score(df: DataFrame, logprobs: str = "logprobs") -> DataFrame:
    """Add ``expected_score``: mean score under the renormalised log-probabilities."""
    scores, values = F.map_keys(logprobs), F.map_values(logprobs)
    top = df.withColumn("_s", scores).withColumn("_top", F.array_max(values)).withColumn("_v", values)
    weights = top.withColumn("_w", let(F.col("_top"), lambda t: F.transform("_v", lambda v: F.exp(v - t))))

    def total(c: Column) -> Column:
        return F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x)

    weighted = F.zip_with("_s", "_w", lambda s, w: s * w)
    return weights.withColumn("expected_score", F.try_divide(total(weighted), total(F.col("_w")))).drop("_s", "_top", "_v", "_w")


def win_matrix(outcomes: DataFrame) -> DataFrame:
    """Wins, losses, ties and win rate per ordered model pair, from ``a, b, outcome``."""
    counted = outcomes.filter("outcome <> 'incomplete'").groupBy("a", "b").agg(
        *[F.sum((F.col("outcome") == o).cast("bigint")).alias(f"_{o}") for o in ("a", "b", "tie")]
    )
    sides = F.explode(F.array(
        F.struct(F.col("a").alias("model"), F.col("b").alias("opponent"), F.col("_a").alias("wins"), F.col("_b").alias("losses"), F.col("_tie").alias("ties")),
        F.struct(F.col("b").alias("model"), F.col("a").alias("opponent"), F.col("_b").alias("wins"), F.col("_a").alias("losses"), F.col("_tie").alias("ties")),
    ))
    matrix = counted.select(sides.alias("s")).select("s.*").groupBy("model", "opponent").agg(*[F.sum(c).alias(c) for c in ("wins", "losses", "ties")])
    games = F.col("wins") + F.col("losses") + F.col("ties")
    return matrix.withColumn("win_rate", F.round(F.try_divide(F.col("wins").cast("double"), games), 4))


ELO_SCALE = 400 * math.log10(math.e)


def bradley_terry(
    matrix: DataFrame, pseudo: float = 0.5, tolerance: float = 1e-8, momentum: float = 0.7, block: int = 512
) -> DataFrame:
    """Maximum-likelihood strengths from a win matrix: ``model, theta, elo, step``.

    Models are placed in blocks of ``block``. In a round every block maximises by Newton's method what is exact for the games inside it and a minorant of
    the likelihood for its games with other blocks (ln(p_i + p_j) is replaced by its tangent at the current strengths, which separates the two). So a round
    never lowers the likelihood, one block is solved in one round whatever its schedule looks like, and several take
    rounds, with ``momentum`` times the last step on top, until no strength changes by more than ``tolerance`` of itself. A task holds the games of one block, at most
    ``block`` squared numbers; between blocks only sums per model travel. With ``pseudo`` at 0 a maximum must exist: no group of models may win or lose all its games
    with the rest. A tie is half a win for each side, and every pair that met gets ``pseudo`` extra wins both
    ways, so undefeated models stay finite. The gauge is mean theta 0 (Elo mean 1200). ``step``
    is the model's last relative change.
    """
    won = F.col("wins") + F.col("ties") / 2 + F.lit(pseudo)
    games = F.col("wins") + F.col("losses") + F.col("ties") + F.lit(2 * pseudo)
    met = matrix.select("model", "opponent", won.alias("won"), games.alias("n"))
    models = with_places(met.groupBy("model").agg(F.sum("won").alias("won"), F.sum(F.col("n") - F.col("won")).alias("lost")), ["model"], "at")
    start = F.log(F.col("won") / F.col("lost"))
    state = cut_lineage(models.select(
        "model", "at", F.floor(F.col("at") / block).alias("block"), "won", start.alias("theta"), start.alias("last"), F.lit(None).cast("double").alias("step")))
    named = state.select("model", "at", "block")
    lines = met.join(named, "model").join(named.select(F.col("model").alias("opponent"), F.col("at").alias("to"), F.col("block").alias("_b")), "opponent")
    lines = cut_lineage(lines.select("at", "to", "block", "_b", "n"))
    inner = lines.filter("block = _b AND at < to").select("block", "at", "to", "n")
    across = lines.filter("block <> _b").select("at", "to", "n")
    several = not across.isEmpty()
    push = momentum if several else 0.0

    def solve(own: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("at")
        n = np.zeros((len(own), len(own)))
        i, j = (np.searchsorted(own["at"].to_numpy(), pairs[c].to_numpy()) for c in ("at", "to"))
        n[i, j] = n[j, i] = pairs["n"].to_numpy(float)
        now = own["theta"].to_numpy(float)
        best, moved = _newton(n, own["won"].to_numpy(float), own["load"].to_numpy(float), now)
        best = best + push * (now - own["last"].to_numpy(float))
        change = np.abs(np.expm1(best - now)) if several else moved
        return pd.DataFrame({"model": own["model"], "at": own["at"], "block": own["block"], "won": own["won"], "theta": best, "last": now, "step": change})

    while True:
        load = F.lit(0.0)
        facts = state.withColumn("load", load)
        if several:
            mine, theirs = (state.select(F.col("at").alias(k), F.exp("theta").alias(p)) for k, p in (("at", "_p"), ("to", "_q")))
            loads = across.join(mine, "at").join(theirs, "to").groupBy("at").agg(F.sum(F.col("n") / (F.col("_p") + F.col("_q"))).alias("_load"))
            facts = state.join(loads, "at", "left").withColumn("load", F.coalesce("_load", load)).drop("_load")
        solved = facts.groupBy("block").cogroup(inner.groupBy("block")).applyInPandas(solve, state.schema)
        state = written(solved, "ratings")
        if not several or (state.agg(F.max("step")).first()[0] or 0.0) < tolerance:
            break
    # one line per model: the mean is taken over the ratings, not over the verdicts
    mean = state.agg(F.avg("theta")).first()[0] or 0.0
    theta = F.col("theta") - F.lit(mean)
    return state.select("model", theta.alias("theta"), (F.lit(ELO_SCALE) * theta + 1200).alias("elo"), "step")


def _newton(n: np.ndarray, won: np.ndarray, load: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximum of sum won theta - sum_{i<j} n ln(e^theta_i + e^theta_j) - sum load e^theta, and the last relative change."""
    def value(t: np.ndarray) -> float:
        return float(won @ t - (n * np.logaddexp(t[:, None], t[None, :])).sum() / 2 - load @ np.exp(t))

    moved = np.zeros(len(theta))
    for _ in range(200):
        share = 1 / (1 + np.exp(np.clip(theta[None, :] - theta[:, None], -700, 700)))
        pull = load * np.exp(theta)
        slope = won - (n * share).sum(1) - pull
        weight = n * share * (1 - share)
        bend = np.diag(weight.sum(1) + pull) - weight
        # least squares: strengths that no game ties to the rest keep their level
        step = np.linalg.lstsq(bend, slope, rcond=1e-14)[0]
        scale, now = 1.0, value(theta)
        while scale > 1e-6 and value(theta + scale * step) < now:
            scale /= 2
        theta, moved = theta + scale * step, np.abs(np.expm1(scale * step))
        if moved.max(initial=0.0) < 1e-12 or scale <= 1e-6:
            break
    return theta, moved


def metric_grid(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Model x scenario x metric matrix from ``model, scenario`` and metric columns.

    One aggregation over the rows; model means and mean win rates are then taken from the
    small grid. A win rate is the share of the other models with a strictly lower value in
    the same scenario.
    """
    cells = df.groupBy("model", "scenario").agg(*[F.avg(m).alias(m) for m in metrics])
    ranked = cells
    for m in metrics:
        ranked = ranked.withColumn(f"_win_{m}", F.percent_rank().over(Window.partitionBy("scenario").orderBy(m)))
    # each cell is one line, so the roll-up returns the cells themselves plus the model means
    rolled = ranked.rollup("model", "scenario").agg(
        *[F.round(F.avg(m), 4).alias(m) for m in metrics], *[F.round(F.avg(f"_win_{m}"), 4).alias(f"win_rate_{m}") for m in metrics],
        F.grouping_id().alias("_level"),
    )
    named = rolled.filter("_level < 2").withColumn("scenario", F.when(F.col("_level") == 1, "all").otherwise(F.col("scenario")))
    return named.drop("_level")


def calibration_bins(df: DataFrame, conf: str = "conf", correct: str = "correct", bins: int = 10) -> DataFrame:
    """Confidence bins of equal width: count, mean confidence, accuracy; 1.0 belongs to the last bin."""
    index = F.least(F.floor(F.col(conf) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(index.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(conf).alias("mean_conf"), F.avg(F.col(correct).cast("double")).alias("accuracy")
    )


def calibration_error(bins: DataFrame) -> DataFrame:
    """Expected and maximum calibration error over the bins."""
    gap = F.abs(F.col("mean_conf") - F.col("accuracy"))
    return bins.agg(
        F.sum("n").alias("n"), F.round(F.try_divide(F.sum(gap * F.col("n")), F.sum("n").cast("double")), 4).alias("ece"), F.round(F.max(gap), 4).alias("mce")
    )


def slice_gap(df: DataFrame, slice_col: str, metric: Column) -> DataFrame:
    """Largest difference of a metric between slices, with the worst and best slice (first name on ties)."""
    per_slice = df.groupBy(slice_col).agg(F.avg(metric).alias("_m"))
    worst, best = F.min(F.struct("_m", slice_col)), F.min(F.struct((-F.col("_m")).alias("_neg"), F.col(slice_col)))
    found = per_slice.agg(F.count(F.lit(1)).alias("n_slices"), worst.alias("_w"), best.alias("_b"))
    return found.select(
        "n_slices", F.col(f"_w.{slice_col}").alias("worst_slice"), F.round("_w._m", 4).alias("worst"),
        F.col(f"_b.{slice_col}").alias("best_slice"), F.round(-F.col("_b._neg"), 4).alias("best"), F.round(-F.col("_b._neg") - F.col("_w._m"), 4).alias("gap"),
    )


def annotator_agreement(df: DataFrame, item: str, rater: str, label: str, raters: Sequence[str]) -> DataFrame:
    """Percent agreement and Cohen's kappa for each pair of the named raters.

    Ratings are pivoted to one line per item, so a pair of raters is a pair of columns and
    no self-join is needed.
    """
    wide = df.groupBy(item).pivot(rater, list(raters)).agg(F.max(label))
    pairs = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}`").alias("la"), F.col(f"`{b}`").alias("lb"))
        for i, a in enumerate(raters) for b in raters[i + 1:]
    ]
    both = wide.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").filter("la IS NOT NULL AND lb IS NOT NULL")
    cells = both.groupBy("a", "b", "la", "lb").agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select("a", "b", F.explode(F.array(
        F.struct(F.col("la").alias("l"), F.col("n").alias("na"), F.lit(0).cast("bigint").alias("nb"), F.when(F.col("la") == F.col("lb"), F.col("n")).otherwise(0).alias("same")),
        F.struct(F.col("lb").alias("l"), F.lit(0).cast("bigint").alias("na"), F.col("n").alias("nb"), F.lit(0).cast("bigint").alias("same")),
    )).alias("s")).select("a", "b", "s.*")
    margins = sides.groupBy("a", "b", "l").agg(F.sum("na").alias("na"), F.sum("nb").alias("nb"), F.sum("same").alias("same"))
    total = F.sum("na").cast("double")
    stats = margins.groupBy("a", "b").agg(
        F.sum("na").alias("n"), (F.sum("same") / total).alias("po"), (F.sum((F.col("na") * F.col("nb")).cast("double")) / (total * total)).alias("pe")
    )
    kappa = F.try_divide(F.col("po") - F.col("pe"), 1 - F.col("pe"))
    return stats.select(F.col("a").alias("rater_a"), F.col("b").alias("rater_b"), "n", F.round("po", 4).alias("agreement"), F.round(kappa, 4).alias("kappa"))


def safety_flags(df: DataFrame, thresholds: Mapping[str, float], scores: str = "scores") -> DataFrame:
    """Add ``violations`` (attributes at or above their threshold) and ``blocked``.

    Apply it to the input scores and to the output scores of a request alike.
    """
    hits = [F.when(F.try_element_at(F.col(scores), F.lit(a)) >= t, F.lit(a)) for a, t in thresholds.items()]
    flagged = df.withColumn("violations", F.filter(F.array(*hits), lambda v: v.isNotNull()))
    return flagged.withColumn("blocked", F.size("violations") > 0)


def safety_rates(df: DataFrame, by: Sequence[str], gold: Column, blocked: str = "blocked") -> DataFrame:
    """Block rate, and recall / precision of the block flag against gold, per group."""
    rows = df.select(*by, F.col(blocked).cast("int").alias("_b"), gold.cast("int").alias("_g"))
    hit = F.sum(F.col("_b") * F.col("_g"))
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("_b"), 4).alias("block_rate"),
        F.round(F.coalesce(F.try_divide(hit, F.sum("_g")), F.lit(0.0)), 4).alias("recall"),
        F.round(F.coalesce(F.try_divide(hit, F.sum("_b")), F.lit(0.0)), 4).alias("precision"),
    )


def route_tiers(df: DataFrame, id_col: str, rejected: Column, needs_human: Column, judge_sample: int, seed: int) -> DataFrame:
    """Send each generation to one tier.

    Guardrail failures are ``rejected``; flagged or borderline ones go to ``human``; a seeded
    sample of exactly ``judge_sample`` of the rest (all when there are fewer) goes to the ``judge``; everything else is scored by ``programmatic``
    metrics only. The sample may have any size: its largest draw is found by counts (:func:`chatloom.plans.positions.smallest`), ids meet it in a plain join. Ids are unique.
    """
    if judge_sample < 0:
        raise ValueError("judge_sample must not be negative")
    first = df.withColumn("_tier", F.when(rejected, "rejected").when(needs_human, "human"))
    free = first.filter("_tier IS NULL").select(id_col, draw(seed, "judge", F.col(id_col)).alias("_d"))
    chosen = smallest(free, [], F.lit(judge_sample), "_d", [id_col]).select(id_col, F.lit("judge").alias("_judge"))
    routed = first.join(chosen, id_col, "left")
    return routed.withColumn("tier", F.coalesce("_tier", "_judge", F.lit("programmatic"))).drop("_tier", "_judge")
