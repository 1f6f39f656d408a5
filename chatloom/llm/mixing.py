"""Mixing sources to target weights by pivotal rounding, in DataFrame operations only."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions.text import let
from chatloom.llm.common import word_count
from chatloom.plans.positions import broadcast_if_small
from chatloom.session import cut_lineage

_PLACE_BITS = 33  # monotonically_increasing_id: the partition's number above, the place in it below


def ranked_sources(sources: DataFrame) -> DataFrame:
    """``rank`` (from 0) of each source by code point, null last, without one task that sees all sources."""
    order = [F.col("source").isNull(), F.col("source")]
    placed = cut_lineage(
        sources.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_at", _PLACE_BITS))
    # one line per partition
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    place = F.col("_at") - F.shiftleft(F.col("_part"), _PLACE_BITS)
    return placed.join(bases, "_part").withColumn("rank", F.col("_base") + place).drop("_at", "_part", "_base")


def source_targets(sources: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """``target`` of each source (columns ``source``, ``source_size``): its share of all sizes by weight, at most ``cap`` times its size.

    Sources take the weights in turn, by code point. What a source may not take is shared anew by
    weight among the rest. The driver sees two totals per round, and a round that caps nothing ends it.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    table = cut_lineage(ranked_sources(sources).withColumn("_weight", weight))
    level, full, limit = 0.0, -1, F.col("source_size") * cap
    while True:
        capped = F.lit(False) if full < 0 else limit <= F.col("_weight") * F.lit(level)
        total, taken, open_weight, n = table.agg(
            F.sum("source_size"), F.sum(F.when(capped, limit)), F.sum(F.when(~capped, F.col("_weight"))), F.count_if(capped)).first()
        if n == full or not open_weight:
            break
        level, full = ((total or 0) - (taken or 0)) / open_weight, n
    target = F.least(limit.cast("double"), F.col("_weight") * F.lit(level)) if full >= 0 else limit.cast("double")
    return table.select("source", "source_size", target.alias("target"))


def _settle(level: int, seed: int) -> Column:
    """Folds ``items`` (id, size, share), largest first, into decided copies and the few shares that stay open.

    A document is drawn to 1 with its share as probability, and the words that it gains or loses are taken from or given to all smaller open documents of the
    group, in the same proportions either way and within their own 0 and 1. So every share keeps its mean and the group its words. A document
    that the smaller ones cannot carry stays open for the next level; so do the last, smallest ones.
    """
    def step(items: Column, i: Column) -> Column:
        own = F.get(items, i)

        def with_draw(o: Column) -> Column:
            # o: id, size, share of the document, room: how much of its whole move the smaller ones can carry
            def room(y: Column, j: Column) -> Column:
                carried = y["size"] * F.least(y["share"] / ((1 - o["share"]) * o["size"]), (1 - y["share"]) / (o["share"] * o["size"]))
                return F.when((j > i) & (y["share"] > 0) & (y["share"] < 1), carried).otherwise(0.0)

            rooms = F.transform(items, room)
            total = F.aggregate(rooms, F.lit(0.0), lambda acc, x: acc + x)
            draw = F.pmod(F.xxhash64(F.lit(seed), F.lit(level), o["id"], F.lit(1)), F.lit(1 << 30)) / float(1 << 30)

            def moved(b: Column) -> Column:
                up = b["up"]
                words = F.when(up, -(1 - o["share"]) * o["size"]).otherwise(o["share"] * o["size"])

                def fresh(y: Column, j: Column) -> Column:
                    near = F.greatest(F.lit(0.0), F.least(F.lit(1.0), y["share"] + words * room(y, j) / b["total"] / y["size"]))
                    share = F.when(j == i, F.when(up, 1.0).otherwise(0.0)).when(j > i, near).otherwise(y["share"])
                    return F.struct(y["size"].alias("size"), y["id"].alias("id"), share.alias("share"))

                return F.when(b["total"] >= 1, F.transform(items, fresh)).otherwise(items)

            return let(F.struct(total.alias("total"), (draw < o["share"]).alias("up")), moved)

        return F.when((own["share"] > 0) & (own["share"] < 1), let(own, with_draw)).otherwise(items)

    return F.aggregate(F.sequence(F.lit(0), F.size("items") - 1), F.reverse(F.array_sort("items")), step)


def _pivot(level: int, seed: int) -> Column:
    """Folds ``items`` (id, size, share) into decided copies and at most one open share.

    Two open shares meet: words move from one document to the other until one of the shares is 0 or 1. The
    direction is drawn so that each share keeps its mean, and share x size keeps its sum.
    """
    kind = "struct<id:bigint,size:double,share:double>"
    start = F.struct(F.lit(None).cast(kind).alias("open"), F.array().cast("array<struct<id:bigint,up:boolean>>").alias("done"))

    def step(acc: Column, x: Column) -> Column:
        o = acc["open"]
        up = F.least((1 - o["share"]) * o["size"], x["share"] * x["size"])  # words that o can gain from x
        down = F.least(o["share"] * o["size"], (1 - x["share"]) * x["size"])
        draw = F.pmod(F.xxhash64(F.lit(seed), F.lit(level), o["id"], x["id"]), F.lit(1 << 30)) / float(1 << 30)
        gain = F.when(draw * (up + down) < down, up).otherwise(-down)
        # whichever bound was met is set to the integer itself, not to a sum that may miss it
        rise = gain >= 0
        o_ends = F.when(rise, (1 - o["share"]) * o["size"] <= x["share"] * x["size"]).otherwise(
            o["share"] * o["size"] <= (1 - x["share"]) * x["size"])
        rest_x = F.struct(x["id"].alias("id"), x["size"].alias("size"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), x["share"] - gain / x["size"])).alias("share"))
        rest_o = F.struct(o["id"].alias("id"), o["size"].alias("size"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), o["share"] + gain / o["size"])).alias("share"))
        ended = F.struct(F.when(o_ends, o["id"]).otherwise(x["id"]).alias("id"), F.when(o_ends, rise).otherwise(~rise).alias("up"))
        met = F.struct(F.when(o_ends, rest_x).otherwise(rest_o).cast(kind).alias("open"), F.array_append(acc["done"], ended).alias("done"))
        first = F.struct(F.struct(x["id"].alias("id"), x["size"].alias("size"), x["share"].alias("share")).cast(kind).alias("open"), acc["done"].alias("done"))
        return F.when(o.isNull(), first).otherwise(met)

    # the smaller of two ends first, so what stays open is a large one: only for what no larger group can settle
    return F.aggregate(F.reverse(F.array_sort("items")), start, step)


def row_key() -> Column:
    """What a row is known by: its id (or that it has none) and its text."""
    return F.xxhash64(F.col("doc_id").cast("bigint"), F.col("doc_id").isNull(), "text")


def _rounded(shares: DataFrame, most: int, seed: int, fan_in: int) -> DataFrame:
    """``_s`` (source), ``id``, ``up`` for open shares (``source, _rows, key, size, share``): a tree of groups of about ``fan_in`` documents of one source."""
    decided, open_now = [], shares
    level, groups = 0, max(1, math.ceil(most / fan_in))
    while True:
        # sources smaller than the largest use as many groups as their own rows need at this level
        count = F.greatest(F.lit(1), F.ceil(F.col("_rows") / F.lit(fan_in ** (level + 1)))).cast("int")
        place = F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "key"), count)
        # small rows, much work: a stated number of partitions is not merged by their bytes
        slots = int(shares.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        folded = cut_lineage(
            open_now.withColumn("_group", place).repartition(slots, "source", "_group").groupBy("source", "_rows", "_group")
            .agg(F.collect_list(F.struct("size", F.col("key").alias("id"), "share")).alias("items"))
            .select("source", "_rows", _settle(level, seed).alias("items")))
        lines = folded.select("source", "_rows", F.explode("items").alias("d")).select(
            "source", "_rows", F.col("d.id").alias("key"), F.col("d.size").alias("size"), F.col("d.share").alias("share"))
        decided.append(lines.filter("share IN (0.0, 1.0)").select(F.col("source").alias("_s"), F.col("key").alias("id"), (F.col("share") == 1).alias("up")))
        open_now = lines.filter("share NOT IN (0.0, 1.0)")
        if groups <= 1:
            break
        level, groups = level + 1, math.ceil(groups / fan_in)
    # the last group of a source: a bounded rest
    paired = cut_lineage(open_now.groupBy("source").agg(F.collect_list(F.struct("size", F.col("key").alias("id"), "share")).alias("items")).select(
        F.col("source").alias("_s"), _pivot(level, seed).alias("fold")))
    decided.append(paired.select("_s", F.explode("fold.done").alias("d")).select("_s", "d.id", "d.up"))
    draw = F.pmod(F.xxhash64(F.lit(seed), F.lit(-1), "fold.open.id"), F.lit(1 << 30)) / float(1 << 30)
    decided.append(paired.filter(F.col("fold.open").isNotNull()).select("_s", F.col("fold.open.id").alias("id"), (draw < F.col("fold.open.share")).alias("up")))
    return reduce(DataFrame.unionAll, decided)


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, seed: int = 17, fan_in: int = 64, rows_per_slice: int = 10_000) -> DataFrame:
    """How many copies of each document the mix takes, so that each source comes near its target.

    Columns: ``doc_id``, ``key`` (of id and text), ``source``, ``size`` (words), ``source_size``, ``target`` (of the source), ``copies``, ``taken``.
    A source at target / size = r takes each document floor(r) times and shares the rest: every document
    starts with the fraction of r as its share of one more copy. Groups of about ``fan_in``
    documents of one source round their shares, the large ones first against many smaller ones (:func:`_settle`); the few that stay open
    meet in groups again, up a tree of log n levels. What the last group of a source cannot settle is paired off (:func:`_pivot`) until one share is left,
    decided by a draw. This is done for the documents above the mean size of their source first; the words by which they miss their share move the shares of
    the others, which are rounded next. So a source misses its target by about one small document, unless the large ones outweigh the rest. No
    document exceeds ``cap`` copies. Draws are functions of the seed, ids and texts, so reruns agree.

    Null texts have size 0, and rows of size 0 take nothing; a null source is a source, the last one. A row is known by its id and
    text, so rows without id are rounded each by itself, and rows of one source that repeat both as one document. An empty table gives an empty result.
    Other columns are ignored.
    """
    rows = cut_lineage(docs.select(F.col("doc_id").cast("bigint"), F.col("source").cast("string"), word_count(F.col("text")).alias("size"), row_key().alias("key")))
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    sizes = sources.drop("_rows")
    targets = source_targets(sizes, weights, cap)
    plan = cut_lineage(targets.join(sources.select(F.col("source").alias("_s"), "_rows"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s").withColumn(
        "_rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)))
    # one line per slice of a source, so that the rows of a large source meet its facts in many tasks
    most = plan.agg(F.max("_rows")).first()[0] or 0
    widest = max(1, math.ceil(most / rows_per_slice))
    facts = plan.withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(widest - 1)))).withColumnRenamed("source", "_s").withColumn("_whole", F.floor("_rate"))
    own = rows.withColumn("_slice", F.pmod(F.xxhash64("key"), F.lit(widest)).cast("int"))
    met = own.join(facts, own["source"].eqNullSafe(facts["_s"]) & (own["_slice"] == facts["_t"])).drop("_s", "_t", "_slice")
    met = met.withColumn("_share", F.col("_rate") - F.col("_whole"))

    shares = cut_lineage(met.filter((F.col("size") > 0) & (F.col("_share") > 0)).groupBy("source", "_rows", "source_size", "key").agg(
        F.sum("size").cast("double").alias("size"), F.max("_share").alias("share")))
    # documents above their source's mean size come first, and the rest makes up for the words by which these miss their share
    large = F.col("size") * F.col("_rows") > F.col("source_size")
    first = _rounded(shares.filter(large).drop("source_size"), most, seed, fan_in)
    small = shares.filter(~large).drop("source_size")
    told = shares.filter(large).join(first, (F.col("key") == F.col("id")) & F.col("source").eqNullSafe(F.col("_s")))
    missed = told.groupBy(F.col("source").alias("_m")).agg(F.sum(F.col("size") * (F.col("up").cast("double") - F.col("share"))).alias("_over"))
    carried = small.groupBy("source").agg(F.sum("size").alias("_words")).join(missed, F.col("source").eqNullSafe(F.col("_m"))).select("_m", (F.col("_over") / F.col("_words")).alias("_shift"))
    shifts = broadcast_if_small(cut_lineage(carried))
    moved = small.join(shifts, F.col("source").eqNullSafe(F.col("_m")), "left")
    fair = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("share") - F.coalesce("_shift", F.lit(0.0))))
    second = _rounded(moved.select("source", "_rows", "key", "size", fair.alias("share")), most, seed + 1, fan_in)
    verdicts = first.unionAll(second)
    out = met.join(verdicts, (F.col("key") == F.col("id")) & F.col("source").eqNullSafe(F.col("_s")), "left")
    copies = F.when(F.col("size") > 0, F.col("_whole") + F.coalesce(F.col("up"), F.lit(False)).cast("bigint")).otherwise(0).cast("bigint")
    return out.select("doc_id", "key", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
