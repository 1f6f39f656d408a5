"""Exact dedup by content sort, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm.common import SPACES
from chatloom.session import cut_lineage


def exact_groups(docs: DataFrame, prefix_chars: int = 64, slices: int = 64) -> DataFrame:
    """Groups of equal normalised texts; one line per input row.

    Columns: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``. Texts are equal when they
    are identical after deleting spaces and the control characters from tab to carriage return.
    Of equal texts the row with most code points in the original text stays, then the smallest
    ``doc_id`` (a null id comes last).

    Sampled splitters range-partition the normalised texts by a bounded prefix, the text's
    digest and one of ``slices`` slices of the row's id; the partitions are sorted externally, and
    each row is compared in full with its neighbour. A splitter is thus a short line however long
    the texts are, and a text that a third of all rows share is cut at its slices. The runs
    of a text's slices meet as one narrow line each.

    Null texts count as empty. Repeated rows stay rows of their own; exactly one row of a group is
    kept. An empty table gives an empty result. Other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint"), F.length(text).alias("chars"), F.translate(text, SPACES, "").alias("content"))
    keyed = rows.select(
        "doc_id", "chars", "content", F.substring("content", 1, prefix_chars).alias("prefix"), F.sha2("content", 256).alias("digest"),
        F.pmod(F.xxhash64("doc_id"), F.lit(slices)).cast("int").alias("slice"),
    )
    spread = keyed.repartitionByRange("prefix", "digest", "slice")
    # the range keys are among the window's keys, so the windows run where the range partitioning put the rows
    place = Window.partitionBy("prefix", "digest", "slice")
    ordered = place.orderBy("content")
    compared = spread.withColumn("_new", F.coalesce(F.col("content") != F.lag("content").over(ordered), F.lit(True)).cast("int"))
    runs = compared.withColumn("run", F.sum("_new").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    best = Window.partitionBy("prefix", "digest", "slice", "run").orderBy(F.col("chars").desc(), F.col("doc_id").asc_nulls_last())
    ranked = cut_lineage(runs.select("doc_id", "chars", F.unhex("digest").alias("digest"), "slice", "run", F.row_number().over(best).alias("rank")))

    heads = ranked.groupBy("digest", "slice", "run").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct((-F.col("chars")).alias("chars"), F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))).alias("best"),
    )
    whole = heads.groupBy("digest", "run").agg(F.sum("n").alias("group_size"), F.min(F.struct("best", "slice")).alias("top"))
    facts = heads.join(whole, ["digest", "run"]).select(
        "digest", "slice", "run", "group_size", F.col("top.best.id").alias("keep_id"), (F.col("top.slice") == F.col("slice")).alias("_here"))
    out = ranked.join(facts, ["digest", "slice", "run"])
    return out.select(
        "doc_id", "keep_id", "group_size", (F.col("_here") & (F.col("rank") == 1)).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
