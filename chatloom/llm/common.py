"""What several operators share: words, label folds, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.session import cut_narrow

#: The characters that end a word, as a regular expression class and as a plain list.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACES = "\t\n\x0b\x0c\r "


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str | Column, folds: int) -> Column:
    """Remainder of crc32 of the id written as text; null for a null id."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(folds))


def word_count(text: Column) -> Column:
    """Number of words of a text; null and blank texts have none.

    Counts the starts of words, so no array of words is built.
    """
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges ``u, v`` of one partition as stars: every node but the smallest of its component with that smallest one."""
    held = list(batches)
    if not sum(b.num_rows for b in held):
        return
    table = pa.Table.from_batches(held)
    nodes, place = np.unique(np.concatenate([table["u"].to_numpy(), table["v"].to_numpy()]), return_inverse=True)
    u, v = place[: table.num_rows], place[table.num_rows:]
    label = np.arange(len(nodes))
    while True:
        high, low = np.maximum(label[u], label[v]), np.minimum(label[u], label[v])
        if (high == low).all():
            break
        np.minimum.at(label, high, low)
        while (label != label[label]).any():
            label = label[label]
    own = np.flatnonzero(label != np.arange(len(nodes)))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(nodes[label[own]])], names=["u", "v"])


def components(nodes: DataFrame, edges: DataFrame, few: int = 50_000) -> DataFrame:
    """``node`` and ``component``: the smallest node that can be reached over ``edges`` (columns ``a``, ``b``).

    Alternates large-star and small-star rounds until no edge changes, so a path of n nodes takes
    about log n rounds. Every round goes to a reliable checkpoint. A node with very many neighbours
    contributes rows to a grouped minimum and to a join, never a list.

    The edges lie in as many partitions as their number asks for (:func:`chatloom.session.cut_narrow`). Once they are ``few`` at most, the one
    partition that holds them is settled as it is: a round has a dozen shuffles, however few its edges.
    """
    live = cut_narrow(edges.filter("a <> b").selectExpr("greatest(a, b) as u", "least(a, b) as v").distinct(), few)
    while live.count() > few:
        # large star: every neighbour above a node is tied to the node's least neighbour
        both = live.unionAll(live.selectExpr("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) as m")
        large = both.join(least, "u").filter("v > u").selectExpr("v as u", "m as v").distinct()
        # small star: a node and its neighbours below it are tied to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = large.join(low, "u")
        small = pairs.filter("v <> m").selectExpr("v as u", "m as v").unionAll(low.selectExpr("u", "m as v")).distinct()
        after = cut_narrow(small, few)
        same = live.join(after, ["u", "v"], "left_semi").count() == after.count() == live.count()
        live = after
        if same:
            break
    else:
        live = live.coalesce(1).mapInArrow(_stars, "u bigint, v bigint")
    roots = live.groupBy("u").agg(F.min("v").alias("component"))
    joined = nodes.join(roots, nodes["node"] == roots["u"], "left")
    return joined.select("node", F.coalesce("component", "node").alias("component"))
