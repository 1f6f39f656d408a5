"""Running totals and ranks that never put a whole group into one task.

A plain ``sum().over(partitionBy(group).orderBy(id))`` sends a group that holds a third
of the table to a single task, and a global window sends everything there. Here rows are range-partitioned by
group and order with sampled splitters, so partitions are even whatever the values are. Totals per partition and group
are prefix-summed (at most one line per group and one per partition), and the row-level window works inside one partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.session import cut_lineage

_PLACE_BITS = 33  # monotonically_increasing_id keeps the partition above these bits and the place below


def running_total(
    df: DataFrame,
    value: Column,
    by: Sequence[str],
    order: Sequence[str],
    out: str,
    below: Column | None = None,
    group_min: tuple[str, Column] | None = None,
) -> DataFrame:
    """Add ``out``: total of ``value`` over the group's rows up to and including this one, in ``order`` (columns of any orderable type).

    Pass narrow rows: they cross the network twice and go to a checkpoint. Rows with equal group and order may come in any order among themselves.
    ``below`` (a column of ``df`` constant inside a group) drops whole partitions of a group that start
    at or above that total before the row-level window runs; rows of the last kept partition
    may still exceed it and are the caller's to filter. ``group_min`` (name, column) adds the
    smallest value of a column in the whole group; it rides along with the totals.
    """
    keyed = df.withColumn("_value", value)
    extra_name, extra = group_min or ("_least", F.lit(None))
    keyed = keyed.withColumn("_extra", extra)
    line = [*by, *[o for o in order if o not in by]]
    # the partition's number is written with the row, so later stages and retries agree on it
    placed = cut_lineage(keyed.repartitionByRange(*line).sortWithinPartitions(*line).withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_at", _PLACE_BITS))
    keys = [*by, "_part"]
    totals = placed.groupBy(*keys).agg(F.sum("_value").alias("_sum"), F.min("_extra").alias("_min"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    least = F.min("_min").over(Window.partitionBy(*by)).alias(extra_name)
    bases = totals.select(*keys, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"), *([least] if group_min else []))
    # null-safe, so rows whose group is null keep their place too
    renamed = bases.select(*[F.col(k).alias(f"_b{i}") for i, k in enumerate(keys)], "_base", *([extra_name] if group_min else []))
    same = [placed[k].eqNullSafe(F.col(f"_b{i}")) for i, k in enumerate(keys)]
    joined = placed.drop("_extra").join(renamed, reduce(and_, same)).drop(*[f"_b{i}" for i in range(len(keys))])
    if below is not None:
        joined = joined.filter(F.col("_base") < below)
    inside = Window.partitionBy(*keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return joined.withColumn(out, F.col("_base") + F.sum("_value").over(inside)).drop("_value", "_base", "_part", "_at")


def with_places(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """Add ``out``: the place (from 0) of each row in ``order``, for columns of any orderable type.

    Sampled splitters range-partition the rows, partitions are sorted, and a row's place is its place in its partition plus the rows of the partitions
    before. The windows see one line per partition. Clumped or distant values do no harm.
    """
    placed = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_at", _PLACE_BITS))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    place = F.col("_base") + F.col("_at") - F.shiftleft("_part", _PLACE_BITS)
    return placed.join(bases, "_part").withColumn(out, place).drop("_at", "_part", "_base")


def smallest(df: DataFrame, by: Sequence[str], k: Column, value: str, ties: Sequence[str], bits: int = 32) -> DataFrame:
    """The ``k`` rows of each group with the smallest ``value`` (an integer of ``bits`` bits, not negative), ties by ``ties``; all rows of a smaller group.

    ``k`` is a column of ``df``, constant inside a group. The value of the k-th row is found by radix refinement: counts of the leading bits say in which slice it
    lies, counts inside that slice say more, and so on to the last bit. A pass shuffles at most one line per slice and group; no row is sorted but those
    that tie with the k-th. Pass narrow rows.
    """
    keys = list(by) or ["_all"]
    rows = cut_lineage(df.select("*", k.alias("_k"), *([] if by else [F.lit(0).alias("_all")])))
    bound = rows.groupBy(*keys).agg(F.max("_k").alias("_k"), F.count(F.lit(1)).alias("_n")).select(
        *keys, "_k", F.when(F.col("_n") > F.col("_k"), F.lit(0).cast("bigint")).alias("_slice"), F.lit(0).cast("bigint").alias("_below"))

    def met(facts: DataFrame) -> DataFrame:
        # one line per group; groups are few as each has a quota of its own, and a count proves it before they are broadcast
        named = facts.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(keys)], *[c for c in facts.columns if c not in keys])
        same = reduce(and_, [rows[c].eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(keys)], F.lit(True))
        return rows.drop("_k").join(broadcast_if_small(named), same).drop(*[f"_g{i}" for i in range(len(keys))])

    left = bits
    while left:
        step = min(11, left)
        inside = met(cut_lineage(bound)).filter(F.shiftright(value, left) == F.col("_slice"))
        left -= step
        counts = inside.groupBy(*keys, "_k", "_below", F.shiftright(value, left).alias("_s")).agg(F.count(F.lit(1)).alias("_n"))
        upto = F.col("_below") + F.sum("_n").over(Window.partitionBy(*keys).orderBy("_s"))
        crossed = counts.withColumn("_upto", upto).filter((F.col("_upto") >= F.col("_k")) & (F.col("_upto") - F.col("_n") < F.col("_k")))
        refined = crossed.select(*keys, F.col("_s").alias("_slice"), (F.col("_upto") - F.col("_n")).alias("_below"))
        named = refined.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(keys)], F.col("_slice").alias("_fine"), F.col("_below").alias("_lower"))
        same = reduce(and_, [bound[c].eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(keys)], F.lit(True))
        bound = bound.join(named, same, "left").select(
            *keys, "_k", F.when(F.col("_slice").isNotNull(), F.col("_fine")).alias("_slice"), F.coalesce("_lower", "_below").alias("_below"))
    placed = met(cut_lineage(bound)).filter(F.col("_k") > 0)
    sure = placed.filter(F.col("_slice").isNull() | (F.col(value) < F.col("_slice")))
    tied = placed.filter(F.col(value) == F.col("_slice"))
    first = Window.partitionBy(*keys).orderBy(*ties)
    some = tied.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= F.col("_k") - F.col("_below")).drop("_r")
    return sure.unionByName(some).select(*[c for c in df.columns])


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first in ``order``.

    ``row_number() = 1`` lets Spark drop the losers inside each map task before the shuffle,
    so a key shared by a third of the rows sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def salted_lookup(rows: DataFrame, facts: DataFrame, key: str, weight: str, hot: int = 100_000, salts: int = 64) -> DataFrame:
    """``rows`` joined to ``facts`` (one line per ``key``), with hot keys spread out.

    ``facts[weight]`` says how many rows share the key. A key above ``hot`` is repeated under
    ``salts`` salts on the small side, and its rows pick one of them by their own hash, so
    no task receives a whole hot key.
    """
    wide = F.when(F.col(weight) > hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    spread = facts.withColumn("_salt", F.explode(wide))
    hot_keys = facts.filter(F.col(weight) > hot).select(key, F.lit(True).alias("_hot"))
    # at most total_rows / hot keys can be hot, so this side stays small by construction
    marked = rows.join(F.broadcast(hot_keys), key, "left")
    own = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns if c != key]), F.lit(salts)).cast("int")
    salted = marked.withColumn("_salt", F.when(F.col("_hot"), own).otherwise(0)).drop("_hot")
    return salted.join(spread, [key, "_salt"]).drop("_salt")


def broadcast_if_small(df: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """Broadcast hint only when a bounded count proves the side small; otherwise unchanged."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a scan with fewer splits than task slots over all slots, for CPU-heavy work.

    Inputs that already have enough splits (any large table) pass through untouched.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots, *keys) if df.rdd.getNumPartitions() < slots else df
