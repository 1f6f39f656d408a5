"""Documents whose word shingles resemble each other: SimHash links, verified, and the remaining exact Jaccard links by prefixes of rare shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import SPACES, components
from chatloom.llm.simhash import fingerprints, near_links
from chatloom.plans.candidates import first_candidates, shared_lines, sketch_of
from chatloom.plans.positions import broadcast_if_small, salted_lookup
from chatloom.session import cut_lineage, cut_narrow, text_batches


def shingles(text: bytes, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``width`` words, A-Z in lower case; a shorter text is one run, a blank one has none."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    joined, lengths = b" ".join(words), np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    last = min(width, n)
    starts = (ends - lengths)[: n - last + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[s:e], 42) for s, e in zip(starts, ends[last - 1:].tolist())], np.uint64))


def _narrow(df: DataFrame, per_task: int = 50_000) -> DataFrame:
    """A checkpoint in as many partitions as its rows need."""
    return cut_narrow(df, per_task, cut_lineage)


def _frequent(texts: DataFrame, width: int, least: int = 20_000, most: int = 500_000) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several documents of a sample have, sorted, and in how many of the sample. They only order the shingles."""
    share = max(1 / 16, min(1.0, least / max(1, texts.count())))
    sample = texts.filter(F.pmod(F.xxhash64("node"), F.lit(1 << 20)) < int(share * (1 << 20)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def full() -> pa.RecordBatch:
            token, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n.astype(np.int64))], names=["token", "n"])

        for batch in batches:
            for text in batch["text"]:
                held.append(shingles(text.as_py(), width))
                size += len(held[-1])
                if size >= 500_000:
                    yield full()
                    held, size = [], 0
        yield full()

    counted = sample.mapInArrow(run, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n")).filter("n >= 3")
    with text_batches(texts.sparkSession):
        rows = counted.orderBy(F.desc("n"), "token").limit(most).collect()
    token, n = np.array([r["token"] for r in rows], np.int64).view(np.uint64), np.array([r["n"] for r in rows], np.int64)
    order = np.argsort(token)
    return token[order], n[order]


def _named(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """The texts of these nodes; a list that a count proves small goes to the texts, a longer one meets them in a shuffle."""
    return texts.join(broadcast_if_small(nodes, 500_000), "node", "left_semi")


def _verified(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """``a, b, close``: whether the pairs have a Jaccard of 0.8 or more. A head of very many members is read by many tasks."""

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, known = [], (None, None)
            for b, x, y in zip(batch["b"].to_pylist(), batch["text_a"], batch["text_b"]):
                if known[0] != b:
                    known = b, shingles(y.as_py(), width)
                left, right = shingles(x.as_py(), width), known[1]
                common = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(9 * common >= 4 * (len(left) + len(right)))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"], pa.array(keep, pa.bool_())], names=["a", "b", "close"])

    # texts stay where they are unless a pair names them
    texts = _named(texts, _narrow(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()))
    weights = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    heads = weights.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    met = salted_lookup(pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a"), heads, "b", "n", hot=5_000)
    with text_batches(texts.sparkSession):
        return _narrow(met.select("a", "b", "text_a", "text_b").mapInArrow(exact, "a bigint, b bigint, close boolean"))


def signed_links(texts: DataFrame, width: int = 5, distance: int = 4) -> DataFrame:
    """Links ``a, b`` with a Jaccard of 0.8 or more among those that SimHash finds: every text with the first of its fingerprint, and the firsts of
    fingerprints that :func:`chatloom.llm.simhash.near_links` ties. Blank texts have none."""
    worded = texts.filter(F.length(F.translate(F.col("text").cast("string"), SPACES, "")) > 0)
    with text_batches(texts.sparkSession):
        rows = _narrow(fingerprints(worded.select(F.col("node").alias("doc_id"), "text"), width).select(F.col("doc_id").alias("node"), "fp").distinct())
    distinct = _narrow(rows.groupBy("fp").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n")), per_task=10_000)
    copies = salted_lookup(rows, distinct.filter("n > 1"), "fp", "n").filter("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    ties = _narrow(near_links(distinct, distance).distinct())
    for side in "ab":
        ties = ties.join(distinct.select(F.col("fp").alias(side), F.col("first").alias(f"first_{side}")), side)
    pairs = _narrow(copies.unionByName(ties.select(F.col("first_a").alias("a"), F.col("first_b").alias("b"))))
    return _verified(pairs, texts, width).filter("close").select("a", "b")


def resembling(texts: DataFrame, width: int = 5, hot: int = 20_000) -> DataFrame:
    """``node, component`` for documents (``node``: a number of its own for each; ``text``: bytes): links are Jaccards of 0.8 or more.

    SimHash comes first (:func:`signed_links`): what it ties is one component from the start. It cannot find all links, as a Jaccard of 0.8 leaves
    about ten bits different; the rest is found exactly.

    Exact for the sets of 64-bit hashes of ``width`` words. With all shingles in one order two sets of that Jaccard share one of their first
    n - ceil(0.8 n) + 1. The order puts shingles last that a sample knows to be frequent, which has no influence on the result.
    In the group of a shingle every document names its first earlier member of another component that size, place and sketch allow
    (:func:`chatloom.plans.candidates.first_candidates`); these pairs are verified, and those that hold are contracted to components. Groups in which someone
    may have had more candidates and which still hold several components are asked again, without the pairs that failed and for eight times as many names, until
    nobody has more. So the first round makes at most as many rows as there are lines, and near copies of one text meet its first copy in it; later ones name pairs that
    sketches could not tell from links, in about as many rounds as a group's size has digits. No group is capped; groups above
    ``hot`` lines are split by size. Equal texts are one component. Blank texts are alone. An empty table gives an empty result.
    """
    often_seen, often = _frequent(texts, width)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, tokens, sizes, places = [], [], [], []
            for node, text in zip(batch["node"].to_pylist(), batch["text"]):
                own = shingles(text.as_py(), width)
                n = len(own)
                if not n:
                    continue
                if len(often_seen):
                    at = np.minimum(np.searchsorted(often_seen, own), len(often_seen) - 1)
                    own = own[np.lexsort((own, np.where(often_seen[at] == own, often[at], 0)))]
                own = own[: n - (4 * n + 4) // 5 + 1]
                nodes.append(np.full(len(own), node, np.int64))
                tokens.append(own.view(np.int64))
                sizes.append(np.full(len(own), n, np.int32))
                places.append(np.arange(len(own), dtype=np.int32))
            if nodes:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (tokens, nodes, sizes, places)], names=["token", "id", "size", "place"])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [sketch_of(shingles(text.as_py(), width)) for text in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["node"], pa.array(bits, pa.binary())], names=["id", "bits"])

    with text_batches(texts.sparkSession):
        groups = _narrow(shared_lines(texts.mapInArrow(prefixes, "token bigint, id bigint, size int, place int"), 0.8, hot))
        members = _narrow(groups.select(F.col("id").alias("node")).distinct())
        bits = _narrow(_named(texts, members).mapInArrow(sketch, "id bigint, bits binary"))
    links = signed_links(texts, width)
    tied = components(links.select(F.explode(F.array("a", "b")).alias("node")).distinct(), links).select(F.col("node").alias("id"), "component")
    parts = _narrow(bits.select("id").join(tied, "id", "left").select("id", F.coalesce("component", "id").alias("part")))
    refused = texts.sparkSession.createDataFrame([], "a bigint, b bigint")
    lines, first, names = groups, True, 1
    while True:
        failed = refused.groupBy(F.col("a").alias("id")).agg(F.collect_set("b").alias("failed"))
        facts = bits.join(parts, "id") if first else bits.join(parts, "id").join(failed, "id", "left")
        named = _narrow(first_candidates(lines.join(facts, "id"), 0.8, names))
        pairs = _narrow(named.select(F.col("id").alias("a"), F.col("head").alias("b")).distinct())
        checked = _verified(pairs, texts, width)
        links = _narrow(links.unionByName(checked.filter("close").select("a", "b")))
        again = _narrow(named.filter("more").select("token", "band").distinct())
        if again.isEmpty():
            break
        refused = _narrow(refused.unionByName(checked.filter("NOT close").select("a", "b")))
        # only components that a new link ties together have to be looked at
        sides = checked.filter("close").select("a", "b")
        for side in "ab":
            sides = sides.join(parts.select(F.col("id").alias(side), F.col("part").alias(f"part_{side}")), side)
        ties = _narrow(sides.select(F.col("part_a").alias("a"), F.col("part_b").alias("b")).distinct())
        merged = components(ties.select(F.explode(F.array("a", "b")).alias("node")).distinct(), ties).select(F.col("node").alias("part"), "component")
        parts = _narrow(parts.join(merged, "part", "left").select("id", F.coalesce("component", "part").alias("part")))
        told = groups.join(broadcast_if_small(again), ["token", "band"], "left_semi").join(parts, "id").select("token", "band", "part")
        mixed = _narrow(told.groupBy("token", "band").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low <> high").select("token", "band"))
        lines, first, names = _narrow(groups.join(broadcast_if_small(mixed), ["token", "band"], "left_semi")), False, names * 8
        if lines.isEmpty():
            told = parts.select(F.col("id").alias("node"), F.col("part").alias("component"))
            return texts.select("node").distinct().join(told, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    return components(texts.select("node").distinct(), links)
