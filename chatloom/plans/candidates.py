"""Pairs of rows that share a token and may resemble each other, found inside the groups of a token.

A group's pairs never leave its task: every row names at most a few earlier rows that pass cheap exact bounds on size,
position and sketch, so what comes out grows with the rows and not with the square of a group. Callers verify these pairs, settle or merge
rows, and ask again for the rows that had more candidates than they could name.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a parity sketch.
SKETCH = 1024


def sketch_of(hashes: np.ndarray) -> bytes:
    """Parity of the elements per bit: two sketches differ in no more bits than the sets differ in elements."""
    odd = np.bincount((hashes >> np.uint64(20)).astype(np.int64) % SKETCH, minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def with_sketch(sets: DataFrame, col: str) -> DataFrame:
    """``bits`` in place of the array of 64-bit hashes ``col``."""
    kept = [f for f in sets.schema.fields if f.name != col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [sketch_of(np.asarray(s.values.to_numpy(zero_copy_only=False), np.int64).view(np.uint64)) for s in batch[col]]
            yield pa.RecordBatch.from_arrays([*(batch[f.name] for f in kept), pa.array(bits, pa.binary())], names=[*(f.name for f in kept), "bits"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return sets.mapInArrow(run, f"{schema}, bits binary")


def whole_groups(keys: list[str], work: Callable[[np.ndarray, pa.Table], Iterator[pa.RecordBatch]]) -> Callable:
    """For rows sorted by the integer columns ``keys``: calls ``work`` with the starts of the groups in a stretch of whole groups."""

    def changes(table: pa.Table | pa.RecordBatch) -> np.ndarray:
        out = np.zeros(table.num_rows, bool)
        for k in keys:
            x = np.asarray(table[k].to_numpy(zero_copy_only=False) if isinstance(table, pa.RecordBatch) else table[k].to_numpy())
            out[1:] |= x[1:] != x[:-1]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None

        def stretch() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            starts = np.flatnonzero(changes(table))
            yield from work(np.append(0, starts), table)

        for batch in batches:
            if not batch.num_rows:
                continue
            first = [batch[k][0].as_py() for k in keys]
            if held and first != last:
                yield from stretch()
                held = []
            # the last group of a batch may go on in the next
            at = np.flatnonzero(changes(batch))
            if len(at):
                held.append(batch.slice(0, at[-1]))
                yield from stretch()
                held = []
                batch = batch.slice(at[-1])
            held.append(batch)
            last = [batch[k][0].as_py() for k in keys]
        if held:
            yield from stretch()

    return run


def shared_lines(lines: DataFrame, threshold: float, hot: int = 20_000) -> DataFrame:
    """The lines (``token, id, size, place``) whose token has company, with ``band``.

    Groups above ``hot`` rows are split by size: only sizes within ``threshold`` of each other can match, so each row goes to the band of
    its size and to the next one, and any two such rows meet in a band. Smaller groups have the one band 0.
    """
    step = math.log(1 / threshold)

    def run(starts: np.ndarray, table: pa.Table) -> Iterator[pa.RecordBatch]:
        counts = np.diff(np.append(starts, table.num_rows))
        many = np.repeat(counts, counts)
        band = np.where(many > hot, 1 + np.floor(np.log(table["size"].to_numpy()) / step + 1e-9), 0).astype(np.int32)
        once, again = np.flatnonzero(many > 1), np.flatnonzero(many > hot)
        for at, add in ((once, 0), (again, 1)):
            if len(at):
                part = table.take(pa.array(at)).append_column("band", pa.array(band[at] + np.int32(add)))
                yield from part.combine_chunks().to_batches(max_chunksize=100_000)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in lines.schema.fields)
    return lines.repartition("token").sortWithinPartitions("token").mapInArrow(whole_groups(["token"], run), f"{schema}, band int")


def may_reach(threshold: float, both: np.ndarray | Column, common: np.ndarray | Column):
    """Whether ``common`` elements of two sets with ``both`` in all make a Jaccard of ``threshold``."""
    return common * (1 + threshold) >= threshold * both - 1e-6


def first_candidates(lines: DataFrame, threshold: float, width: int = 1) -> DataFrame:
    """``token, band, id, head, more``: per line up to ``width`` earlier rows of its group (by ``id``) that may have a Jaccard of ``threshold`` with it.

    ``lines``: ``token, band, id, size, place, bits``; optional ``part`` (rows of one part are not paired), ``looks`` (false: the row is a possible
    head only) and ``failed`` (heads already refused). Sizes, places of the token in both orders, and sketches are exact bounds: a pair that
    reaches the threshold passes in the group of its first common token. ``more`` says that the line may have further candidates.
    """
    optional = [c for c in ("part", "looks", "failed") if c in lines.columns]
    kind = lines.schema["id"].dataType.simpleString()

    def run(starts: np.ndarray, table: pa.Table) -> Iterator[pa.RecordBatch]:
        n = table.num_rows
        counts = np.diff(np.append(starts, n))
        start = np.repeat(starts, counts)
        place_in = np.arange(n) - start
        size, place = (table[c].to_numpy().astype(np.int64) for c in ("size", "place"))
        bits = np.frombuffer(b"".join(table["bits"].to_pylist()), np.uint64).reshape(n, SKETCH // 64)
        part = table["part"].to_numpy() if "part" in optional else np.arange(n)
        looks = table["looks"].to_numpy(zero_copy_only=False) if "looks" in optional else np.ones(n, bool)
        refused = {i: set(x) for i, x in enumerate(table["failed"].to_pylist()) if x} if "failed" in optional else {}
        ids = table["id"].combine_chunks() if isinstance(table["id"], pa.ChunkedArray) else table["id"]
        least, most = np.minimum.reduceat(part, starts), np.maximum.reduceat(part, starts)
        active = np.flatnonzero((place_in > 0) & looks & np.repeat(least != most, counts))
        need = np.full(n, width)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        k = 0
        while len(active):
            other = start[active] + k
            common = np.minimum(size[active] - place[active], size[other] - place[other])
            fits = (part[active] != part[other]) & may_reach(threshold, size[active] + size[other], common)
            a, b = active[fits], other[fits]
            if len(a):
                differ = np.bitwise_count(bits[a] ^ bits[b]).sum(1, dtype=np.int64)
                near = differ * (1 + threshold) <= (1 - threshold) * (size[a] + size[b]) + 1e-6
                a, b = a[near], b[near]
                if refused and len(a):
                    free = np.array([i not in refused or ids[j].as_py() not in refused[i] for i, j in zip(a.tolist(), b.tolist())], bool)
                    a, b = a[free], b[free]
                if len(a):
                    found.append((a, b))
                    need[a] -= 1
            k += 1
            active = active[(place_in[active] > k) & (need[active] > 0)]
        if found:
            a, b = (np.concatenate(x) for x in zip(*found))
            rows = pa.array(a)
            out = [table[c].combine_chunks().take(rows) for c in ("token", "band")]
            yield pa.RecordBatch.from_arrays([*out, ids.take(rows), ids.take(pa.array(b)), pa.array(need[a] == 0)], names=["token", "band", "id", "head", "more"])

    order = ["token", "band"]
    wanted = lines.select(*order, "id", "size", "place", "bits", *optional)
    return wanted.repartition(*order).sortWithinPartitions(*order, "id").mapInArrow(whole_groups(order, run), f"token bigint, band int, id {kind}, head {kind}, more boolean")
