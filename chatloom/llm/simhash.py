"""Near duplicates by SimHash, linked with the generalised pigeonhole principle."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import components
from chatloom.session import cut_lineage

BITS = 64


def fingerprint(text: bytes, width: int = 4, seed: int = 42) -> int:
    """64-bit SimHash of a UTF-8 text over runs of ``width`` words, A-Z in lower case; 0 for a text without words."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    joined, lengths = b" ".join(words), np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    last = min(width, n)
    starts = (ends - lengths)[: n - last + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], seed) for s, e in zip(starts, ends[last - 1:].tolist())], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 4096):
        ones += np.unpackbits(hashes[i:i + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = 4, seed: int = 42) -> DataFrame:
    """``doc_id`` and ``fp`` (the 64 bits as a signed number) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), width, seed) for t in batch["text"]], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(fps)], names=["doc_id", "fp"])

    text = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    return docs.select(F.col("doc_id").cast("bigint"), text).mapInArrow(run, "doc_id bigint, fp bigint")


@dataclass(frozen=True)
class Part:
    """Some of the bits, and how many of them may differ; a part with threshold -1 is not looked at."""

    bits: tuple[int, ...]
    threshold: int

    @property
    def mask(self) -> int:
        return sum(1 << b for b in self.bits)

    def flips(self) -> list[int]:
        return [sum(1 << b for b in chosen) for r in range(self.threshold + 1) for chosen in combinations(self.bits, r)]


def bit_counts(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for each two bits, how many have both: 4096 sums over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((BITS, BITS))
        for batch in batches:
            fps = batch["fp"].to_numpy().view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(fps, axis=1, bitorder="little").astype(np.float32)
            n, both = n + len(bits), both + bits.T @ bits
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, BITS * BITS)), pa.array(np.concatenate([[n], both.ravel()]).round().astype(np.int64))], names=["cell", "n"])

    rows = distinct.select("fp").mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    cells = np.zeros(BITS * BITS + 1)
    for r in rows:
        cells[r["cell"] + 1] = r["n"]
    return int(cells[0]), cells[1:].reshape(BITS, BITS)


def _grouped_bits(n: int, both: np.ndarray, parts: int) -> list[tuple[int, ...]]:
    """Parts of nearly equal width; each starts with the free bit of least spread and takes the free bits that go with it most."""
    share = np.diag(both) / max(1, n)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9))
    linked = np.abs(both / max(1, n) - np.outer(share, share)) / np.outer(spread, spread)
    free, out = set(range(BITS)), []
    for i in range(parts):
        width = BITS // parts + (i < BITS % parts)
        own = [min(free, key=lambda b: (spread[b], b))]
        free.discard(own[0])
        while len(own) < width:
            best = max(sorted(free), key=lambda b: linked[b, own].sum())
            own.append(best)
            free.discard(best)
        out.append(tuple(sorted(own)))
    return out


def plan_parts(n: int, both: np.ndarray, distance: int, row_cost: float = 4.0, pair_cost: float = 0.02) -> list[Part]:
    """Parts and thresholds with the least estimated cost for ``n`` fingerprints.

    Any two fingerprints within ``distance`` differ by at most t_i bits in some part i as soon as the numbers t_i + 1 add up to
    distance + 1. For each number of parts a dynamic programme over (parts, what is left of the sum) places the thresholds; its
    costs are rows sent (signatures) and candidate pairs, the latter from the chance that two fingerprints
    differ in at most t bits of the part, given how often each bit is set.
    """
    share = np.diag(both) / max(1, n)
    best: tuple[float, list[Part]] = (math.inf, [])
    for parts in range(1, distance + 2):
        groups = _grouped_bits(n, both, parts)
        price = np.full((parts, distance + 2), math.inf)
        for i, bits in enumerate(groups):
            law = np.array([1.0])
            for b in bits:
                differ = 2 * share[b] * (1 - share[b])
                law = np.convolve(law, [1 - differ, differ])
            price[i, 0] = 0.0
            for t in range(distance + 1):
                signatures = sum(math.comb(len(bits), r) for r in range(t + 1))
                price[i, t + 1] = row_cost * n * signatures + pair_cost * n * n / 2 * law[: t + 1].sum() * (1 if t == 0 else 2)
        table = np.full((parts + 1, distance + 2), math.inf)
        table[0, 0] = 0.0
        choice = np.zeros((parts + 1, distance + 2), int)
        for i in range(parts):
            for total in range(distance + 2):
                for own in range(total + 1):
                    value = table[i, total - own] + price[i, own]
                    if value < table[i + 1, total]:
                        table[i + 1, total], choice[i + 1, total] = value, own
        if table[parts, distance + 1] < best[0]:
            left, thresholds = distance + 1, []
            for i in range(parts, 0, -1):
                thresholds.append(choice[i, left] - 1)
                left -= choice[i, left]
            best = (table[parts, distance + 1], [Part(g, int(t)) for g, t in zip(groups, thresholds[::-1])])
    return best[1]


def spanning_links(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that join exactly what all links within ``distance`` join, at most one fewer than there are fingerprints.

    A walk: what lies within reach of the current one and was not reached before is linked to it and walked from later. Memory is
    that of the group, however dense it is.
    """
    left = np.unique(fps)
    out, queue = [], []
    while len(left):
        if not queue:
            queue.append(left[0])
            left = left[1:]
            continue
        at = queue.pop()
        near = np.bitwise_count(left ^ at) <= distance
        if near.any():
            found = left[near]
            out += [(int(at), int(x)) for x in found]
            queue.extend(found)
            left = left[~near]
    return out


def near_links(distinct: DataFrame, distance: int = 4) -> DataFrame:
    """Links ``a, b`` between fingerprints (column ``fp``, each once) that connect whatever lies within ``distance`` bits.

    Signatures by :func:`plan_parts` bring candidates together; every candidate is verified on all 64 bits, and what leaves a
    group of candidates is a spanning forest of its links, not its pairs. Groups hold distinct fingerprints, eight bytes each; the plan
    keeps random groups small, and a group of near copies is no larger than the number of different fingerprints it has.
    """
    n, both = bit_counts(distinct)
    parts = [p for p in plan_parts(n, both, distance) if p.threshold >= 0]
    table = [(i, np.uint64(p.mask), np.array(p.flips(), np.uint64)) for i, p in enumerate(parts)]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch["fp"].to_numpy().view(np.uint64)
            for s in range(0, len(every), 8192):
                fps = every[s:s + 8192]
                for i, mask, flips in table:
                    keys = ((fps & mask)[:, None] ^ flips[None, :]).ravel()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(keys), i, np.int32)), pa.array(keys.view(np.int64)), pa.array(np.repeat(fps, len(flips)).view(np.int64))], names=["part", "key", "fp"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(part: np.ndarray, key: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            edge = np.flatnonzero((part[1:] != part[:-1]) | (key[1:] != key[:-1])) + 1
            starts = np.concatenate([[0], edge])
            sizes = np.diff(np.concatenate([starts, [len(key)]]))
            out: list[tuple[int, int]] = []
            for size in np.unique(sizes[sizes > 1]).tolist():
                first = starts[sizes == size]
                if size > 24:
                    for s in first.tolist():
                        out += spanning_links(fps[s:s + size], distance)
                    continue
                # small groups of one size are tested together; those with a link are walked
                for c in range(0, len(first), 4096):
                    rows = fps[first[c:c + 4096, None] + np.arange(size)[None, :]]
                    close = np.bitwise_count(rows[:, :, None] ^ rows[:, None, :]) <= distance
                    for g in np.flatnonzero(close.sum((1, 2)) > size).tolist():
                        out += spanning_links(rows[g], distance)
            a, b = (np.array(x, np.uint64).view(np.int64) for x in (zip(*out) if out else ((), ())))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            now = (batch["part"].to_numpy(), batch["key"].to_numpy(), batch["fp"].to_numpy().view(np.uint64))
            # the last group of a batch may go on in the next
            change = np.flatnonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1]))
            cut = int(change[-1]) + 1 if len(change) else 0
            same = bool(held) and held[-1][0][-1] == now[0][-1] and held[-1][1][-1] == now[1][-1]
            if cut or (held and not same):
                yield links(*(np.concatenate(x) for x in zip(*held, tuple(x[:cut] for x in now))))
                held = []
            held.append(tuple(x[cut:] for x in now))
        if held:
            yield links(*(np.concatenate(x) for x in zip(*held)))

    signed = distinct.select("fp").mapInArrow(sign, "part int, key bigint, fp bigint")
    return signed.repartition("part", "key").sortWithinPartitions("part", "key").mapInArrow(link, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, distance: int = 4, width: int = 4, seed: int = 42) -> DataFrame:
    """Fingerprint and component of every document, one line per row: ``doc_id, fingerprint, component_id, kept``.

    Two documents are linked when their fingerprints differ in at most ``distance`` bits; ``component_id`` is the smallest
    ``doc_id`` that can be reached over links. ``kept`` marks the row with that id. Equal fingerprints are folded before
    any search, so a text that a third of all rows share is one entry.

    Null and blank texts have fingerprint 0 and are linked like any other. Repeated rows get equal lines; rows
    with a null id take part in links, and a component of such rows alone has a null id. An empty table gives an empty result.
    """
    rows = cut_lineage(fingerprints(docs, width, seed))
    distinct = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    reached = components(distinct.select(F.col("fp").alias("node")), near_links(distinct, distance))
    named = distinct.join(reached, F.col("fp") == F.col("node")).select("fp", "least", "component")
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    facts = cut_lineage(named.join(ids, "component").select("fp", "component_id"))
    out = rows.join(facts, "fp")
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return out.select("doc_id", digits.alias("fingerprint"), "component_id", first.alias("kept"))
