"""Label balance and quotas. Every report is a small table made from one map-side combined count."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions.seeded import draw
from chatloom.plans.positions import smallest


def label_distribution(df: DataFrame, label: str, labels: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count and percentage (1 decimal) per label, absent labels as 0, optionally per group.

    Labels outside the list are reported too. No rows at all give counts of 0 and a null
    percentage.
    """
    counts = df.groupBy(*by, F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    # every counted line also carries a zero for each expected label of its group, so the
    # rows are scanned once and no grid has to be joined
    zero = F.lit(0).cast("bigint")
    empty = [F.struct(F.lit(x).alias("label"), zero.alias("n")) for x in labels]
    lines = counts.select(*by, F.explode(F.array(F.struct("label", "n"), *empty)).alias("l")).select(*by, "l.label", "l.n")
    if not by:
        lines = lines.unionByName(df.sparkSession.range(1).select(F.explode(F.array(*empty)).alias("l")).select("l.*"))
    filled = lines.groupBy(*by, "label").agg(F.sum("n").alias("n"))
    total = F.sum("n").over(Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0)))
    return filled.withColumn("pct", F.round(F.try_divide(100.0 * F.col("n"), total), 1))


def majority_baseline(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy of always answering the commonest label (smallest label on ties)."""
    counts = df.groupBy(*by, F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col("label").alias("label")))
    grouped = counts.groupBy(*by).agg(best.alias("_b"), F.sum("n").alias("total"), F.count(F.lit(1)).alias("n_labels"))
    return grouped.select(
        *by, F.col("_b.label").alias("majority_label"), "total",
        F.round(-F.col("_b.neg") / F.col("total"), 4).alias("accuracy"),
        (F.col("n_labels") - 1).alias("labels_never_found"),
    )


def quota_audit(df: DataFrame, stratum: str, targets: Mapping[str, int]) -> DataFrame:
    """Actual against requested rows per stratum; strata without a target have target 0."""
    wanted = F.explode(F.array(*[F.struct(F.lit(k).alias(stratum), F.lit(v).cast("bigint").alias("target")) for k, v in targets.items()]))
    asked = df.sparkSession.range(1).select(wanted.alias("t")).select(f"t.{stratum}", F.lit(0).cast("bigint").alias("actual"), "t.target")
    actual = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("actual")).withColumn("target", F.lit(0).cast("bigint"))
    both = actual.unionByName(asked).groupBy(stratum).agg(F.sum("actual").alias("actual"), F.sum("target").alias("target"))
    return both.withColumn("gap", F.col("actual") - F.col("target")).withColumn("ok", F.col("gap") == 0)


def quota_sample(df: DataFrame, stratum: str, targets: Mapping[str, int], seed: int, id_col: str) -> DataFrame:
    """Exactly the requested rows per stratum in seeded order (all rows when there are fewer). Ids are unique.

    A row whose draw lies above a bound that the quota cannot reach is dropped at once: the bound is refined by counts (:func:`chatloom.plans.positions.smallest`).
    The rest is ranked over range partitions of any stratum's size.
    """
    quota = F.coalesce(*[F.when(F.col(stratum) == k, F.lit(int(v))) for k, v in targets.items()])
    rows = df.filter(F.col(stratum).isin(*targets)).withColumn("_draw", draw(seed, "quota", F.col(id_col)))
    chosen = smallest(rows.select(stratum, "_draw", id_col), [stratum], quota, "_draw", [id_col])
    return df.join(chosen.select(id_col), id_col, "left_semi")


def mix_cube(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Counts over every combination of the dimensions with sub-totals; ``level`` tells them apart."""
    # count once per full combination; only those few lines are expanded into the sub-totals
    cells = df.groupBy(*dims).agg(F.count(F.lit(1)).alias("_n"))
    return cells.cube(*dims).agg(F.sum("_n").alias("n"), F.grouping_id().alias("level"))

