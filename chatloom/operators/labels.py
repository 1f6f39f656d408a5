"""Label-level evaluation.

Everything derives from one pre-aggregated table of ``(expected, predicted)`` counts, so the
wide rows are read once and only small counts cross the network.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.text import strip


def align_predictions(gold: DataFrame, pred: DataFrame, key: str) -> DataFrame:
    """Every gold case with its prediction; a missing prediction stays as a null."""
    return gold.join(pred, key, "left")


def is_correct(predicted: Column, expected: Column) -> Column:
    """Case-insensitive equality after stripping; a failed request counts as wrong."""
    return F.coalesce(F.lower(strip(predicted)) == F.lower(expected), F.lit(False))


def _hits(df: DataFrame, cols: Sequence[str], predicted: str, expected: str) -> DataFrame:
    return df.select(*cols, is_correct(F.col(predicted), F.col(expected)).cast("int").alias("_hit"))


def _accuracy() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total"), F.coalesce(F.sum("_hit"), F.lit(0)).alias("correct"),
        F.round(F.avg("_hit") * 100, 1).alias("accuracy_pct"),
    ]


def label_accuracy(df: DataFrame, predicted: str = "predicted", expected: str = "expected") -> DataFrame:
    """Share of all cases answered correctly."""
    return _hits(df, [], predicted, expected).agg(*_accuracy())


def accuracy_by(df: DataFrame, cols: Sequence[str], predicted: str = "predicted", expected: str = "expected") -> DataFrame:
    """Accuracy per category with sub-totals and the grand total (null keys)."""
    # only one line per category is expanded into the sub-totals
    per_cell = _hits(df, cols, predicted, expected).groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"), F.sum("_hit").alias("_c"))
    return per_cell.rollup(*cols).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total"), F.coalesce(F.sum("_c"), F.lit(0)).alias("correct"),
        F.round(F.try_divide(F.sum("_c").cast("double"), F.sum("_n")) * 100, 1).alias("accuracy_pct"),
    )


def verdict(correct: Column, total: Column) -> Column:
    """``perfect``, ``excellent`` from 80 %, else ``needs training``; integer arithmetic only."""
    return F.when(correct == total, "perfect").when(5 * correct >= 4 * total, "excellent").otherwise("needs training")


def confusion_matrix(
    df: DataFrame, labels: Sequence[str], predicted: str = "predicted", expected: str = "expected"
) -> DataFrame:
    """Counts per (expected, predicted) over the label domain; empty cells are 0.

    Answers outside the domain, missing ones included, land in predicted = null, so the
    cells always add up to the number of cases with a known expected label.
    """
    said = F.when(F.col(predicted).isin(*labels), F.col(predicted))
    counts = df.filter(F.col(expected).isin(*labels)).groupBy(F.col(expected).alias("expected"), said.alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # the full grid enters as extra zero counts, so no join is needed
    domain = F.array(*[F.lit(x) for x in labels])
    answers = F.array(*[F.lit(x) for x in labels], F.lit(None).cast("string"))
    grid = df.sparkSession.range(1).select(F.explode(domain).alias("expected")).select("expected", F.explode(answers).alias("predicted"))
    zeros = grid.withColumn("n", F.lit(0).cast("bigint"))
    return counts.unionByName(zeros).groupBy("expected", "predicted").agg(F.sum("n").alias("n"))


def class_metrics(df: DataFrame, labels: Sequence[str], predicted: str = "predicted", expected: str = "expected") -> DataFrame:
    """One-vs-rest metrics per class plus ``macro`` and ``micro`` rows; zero denominators give 0."""
    cells = confusion_matrix(df, labels, predicted, expected)
    facts = cells.withColumn("label", F.explode(F.array(*[F.lit(x) for x in labels])))
    is_actual, is_said = F.col("expected") == F.col("label"), F.coalesce(F.col("predicted") == F.col("label"), F.lit(False))

    def total(cond: Column) -> Column:
        return F.sum(F.when(cond, F.col("n")).otherwise(0))

    counts = facts.groupBy("label").agg(
        total(is_actual & is_said).alias("tp"), total(~is_actual & is_said).alias("fp"),
        total(is_actual & ~is_said).alias("fn"), total(~is_actual & ~is_said).alias("tn"),
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    def rates(df: DataFrame) -> DataFrame:
        tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
        return df.withColumns({
            "accuracy": ratio(tp + tn, tp + fp + fn + tn), "precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "f1": ratio(2 * tp, 2 * tp + fp + fn),
        })

    # one roll-up gives the classes and, in its total line, both the summed counts and the mean rates
    names = ("accuracy", "precision", "recall", "f1")
    rolled = rates(counts).rollup("label").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")], *[F.avg(n).alias(f"mean_{n}") for n in names])
    kinds = F.when(F.col("label").isNull(), F.array(F.lit("micro"), F.lit("macro"))).otherwise(F.array("label"))
    lines = rates(rolled).withColumn("label", F.explode(kinds))
    macro = F.col("label") == "macro"
    shown = [F.when(~macro, F.col(c)).alias(c) for c in ("tp", "fp", "fn", "tn")]
    rounded = [F.round(F.when(macro, F.col(f"mean_{n}")).otherwise(F.col(n)), 4).alias(n) for n in names]
    return lines.select("label", *shown, *rounded)


def compare_variants(df: DataFrame, key: str, model: str, answer: str, models: Sequence[str]) -> DataFrame:
    """One row per prompt with a column per model, the number of distinct answers and agreement."""
    wide = df.groupBy(key).pivot(model, list(models)).agg(F.max(answer))
    given = F.filter(F.array(*[F.col(f"`{m}`") for m in models]), lambda a: a.isNotNull())
    return wide.withColumn("n_answers", F.size(given)).withColumn("agree", F.size(F.array_distinct(given)) <= 1)


def regression_diff(a: DataFrame, b: DataFrame, key: str, by: str) -> DataFrame:
    """Baseline run ``a`` against candidate run ``b``: fixed / broken / same / missing per category."""
    def side(df: DataFrame, name: str) -> DataFrame:
        ok = is_correct(F.col("predicted"), F.col("expected"))
        return df.select(key, F.col(by).alias(f"{by}_{name}"), ok.alias(f"ok_{name}"), F.col("predicted").alias(f"said_{name}"))

    both = side(a, "a").join(side(b, "b"), key, "full_outer")
    status = (
        F.when(F.col("said_a").isNull() | F.col("said_b").isNull(), "missing")
        .when(~F.col("ok_a") & F.col("ok_b"), "fixed")
        .when(F.col("ok_a") & ~F.col("ok_b"), "broken")
        .otherwise("same")
    )
    rows = both.select(F.coalesce(f"{by}_a", f"{by}_b").alias(by), status.alias("status"))
    return rows.groupBy(by, "status").agg(F.count(F.lit(1)).alias("n"))


def case_sets(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Each case id with where it occurs: ``only_a``, ``only_b`` or ``both``."""
    tagged = a.select(key, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(key, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    seen = tagged.groupBy(key).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    where = F.when(F.col("_b") == 0, "only_a").when(F.col("_a") == 0, "only_b").otherwise("both")
    return seen.select(key, where.alias("where_found"))


def prompt_sensitivity(df: DataFrame, group: str, phrasing: str, predicted: str = "predicted", expected: str = "expected") -> DataFrame:
    """Spread of accuracy over prompt phrasings for each item group."""
    per_phrase = _hits(df, [group, phrasing], predicted, expected).groupBy(group, phrasing).agg(F.avg("_hit").alias("_acc"))
    return per_phrase.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_phrasings"), F.round(F.min("_acc"), 4).alias("worst"), F.round(F.max("_acc"), 4).alias("best"),
        F.round(F.max("_acc") - F.min("_acc"), 4).alias("spread"), F.round(F.stddev_pop("_acc"), 4).alias("stddev"),
    )
