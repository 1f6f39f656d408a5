"""Removal of repeated passages by a distributed merge sort of suffixes that never compares a known prefix twice."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_NO_ID = (1 << 63) - 1  # stands for a null id inside the sort: it comes last
_PLACE = np.uint64((1 << 22) - 1)
_BLOCK = 1 << 21
_STRETCH = 1 << 18  # hashed at a time: its numbers stay in the processor's cache
_MARKS, _RUN = 0, 1


# ---- numbers on the wire -------------------------------------------------------------------------------------------------


def freeze(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob; the bytes of numbers are stored plane by plane."""
    head, body = [], []
    for a in arrays:
        a = np.ascontiguousarray(a)
        head.append(struct.pack("<2sq", a.dtype.str[1:].encode(), len(a)))
        body.append(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=3).compress(bytes([len(arrays)]) + b"".join(head) + b"".join(body))


def thaw(blob: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    at, out = 1 + 10 * data[0], []
    for i in range(data[0]):
        kind, n = struct.unpack_from("<2sq", data, 1 + 10 * i)
        dtype = np.dtype("<" + kind.decode())
        size = n * dtype.itemsize
        planes = np.frombuffer(data, np.uint8, size, at).reshape(dtype.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(dtype).reshape(n))
        at += size
    return out


# ---- anchors -------------------------------------------------------------------------------------------------------------


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return h ^ (h >> np.uint64(29))


def _gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k bytes, put together from runs of powers of two."""
    values, power = np.arange(256, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019), 0xD6E8FEB86659FD93
    step = (values ^ (values >> np.uint64(32)))[data]
    whole, done, size = None, 0, 1
    while size <= k:
        if k & size:
            whole = step if whole is None else whole[: len(step) - done] * np.uint64(power) + step[done:] if done else whole
            whole, done = (step, size) if done == 0 else (whole, done + size)
        if size * 2 <= k:
            step = step[:-size] * np.uint64(power) + step[size:]
        power = power * power % (1 << 64)
        size *= 2
    return _mixed(whole[: len(data) - k + 1])


def anchored_ranges(data: np.ndarray, ends: np.ndarray, window: int, k: int) -> tuple[np.ndarray, ...]:
    """``first, last, anchor, key`` of the ranges of windows that share an anchor.

    ``data`` holds texts end to end (``ends``: where each ends); no window crosses an end. The anchor of a window is its run of k
    bytes with the least hash, the leftmost of equals, so equal windows have their anchor at the same place. ``key`` is a 48-bit number of the anchor's bytes.
    """
    found = []
    # windows before and after the end of a text, or of its last window, share no range
    borders = np.concatenate([ends, ends[np.diff(ends, prepend=0) >= window] - window + 1])
    for s in range(0, max(0, len(data) - window + 1), _STRETCH):
        part = data[s:s + _STRETCH + window - 1]
        hashes = _gram_hashes(part, k)
        least = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        need, size = window - k + 1, 1
        while size * 2 <= need:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < need:
            least = np.minimum(least[: size - need], least[need - size:])
        n = len(least)
        fresh = np.ones(n, bool)
        np.not_equal(least[1:], least[:-1], out=fresh[1:])
        fresh[borders[(borders > s) & (borders < s + n)] - s] = True
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], n) - 1
        good = first + s + window <= ends[np.searchsorted(ends, first + s, "right")]
        first, last = first[good], last[good]
        at = (least[first] & _PLACE).astype(np.int64)
        key = (hashes[at] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(16)
        found.append((first + s, last + s, at + s, key))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


# ---- runs and their merge ------------------------------------------------------------------------------------------------


def front_code(rows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``prefix, lengths, tails`` of sorted rows: how much each shares with the row before, and what follows."""
    prefix = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        prefix[1:] = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
        prefix[1:] = np.minimum(prefix[1:], np.minimum(lengths[1:], lengths[:-1]))
    columns = np.arange(rows.shape[1])
    tails = rows[(columns >= prefix[:, None]) & (columns < lengths[:, None])]
    return prefix.astype(np.uint8), lengths.astype(np.uint8), tails


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, ``counts`` of them, end to end."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def _shared(a: np.ndarray, b: np.ndarray, at: int) -> np.ndarray:
    """Length of the common prefix of each row of ``a`` with the same row of ``b``, of which ``at`` bytes are known."""
    differ = np.ones((len(a), a.shape[1] - at + 1), bool)
    np.not_equal(a[:, at:], b[:, at:], out=differ[:, :-1])
    return at + differ.argmax(1)


def _look(rows: np.ndarray, which: np.ndarray, step: int) -> np.ndarray:
    """Eight bytes of some rows, the ``step``-th, as numbers that are ordered as they are."""
    return rows.view(">u8")[which, step].astype(np.uint64)


class Keys(Sequence):
    """Keys as rows that are filled up with zeros."""

    def __init__(self, rows: np.ndarray, lengths: np.ndarray) -> None:
        self.rows, self.lengths = rows, lengths

    def __len__(self) -> int:
        return len(self.lengths)

    def __getitem__(self, i: int) -> bytes:
        return self.rows[i, : self.lengths[i]].tobytes()

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Sequence) and list(self) == list(other)


def merge_runs(runs: list[tuple[Keys, np.ndarray]]) -> np.ndarray:
    """Rows ``run, place, shared`` of all keys in order; ``shared`` is the prefix that a key has in common with the key before it.

    All runs are merged together from the first bytes on, eight in a step. A step looks only at keys of which their own run does not tell that they
    go on like the key before them, and only where keys of other runs start alike: the bytes of a known prefix are not looked at again. Keys that their run ties
    to the one before move with it, and a stretch that is left to one run keeps that run's order. Equal keys keep the order of the runs.
    """
    lengths = np.concatenate([np.zeros(0, np.int64), *(keys.lengths for keys, _ in runs)])
    n = len(lengths)
    counts = np.array([len(keys) for keys, _ in runs], np.int64)
    run, place = np.repeat(np.arange(len(runs)), counts), _ranges(np.zeros(len(runs), np.int64), counts)
    prefix = np.where(place > 0, np.concatenate([np.zeros(0, np.int64), *(prefixes for _, prefixes in runs)]), 0)
    steps = -(-int(lengths.max(initial=0)) // 8)
    rows = np.zeros((n, 8 * steps), np.uint8)
    for (keys, _), end in zip(runs, np.cumsum(counts).tolist()):
        rows[end - len(keys): end, : keys.rows.shape[1]] = keys.rows[:, : 8 * steps]

    begin = np.zeros(n, np.int64)  # where the keys that start like this one begin in the order
    open_ = np.full(n, (counts > 0).sum() > 1)  # whether keys of several runs start like this one
    parted = np.full(n, -1)  # by place in the order, what the keys before and from there on share
    for step in range(steps + 1):
        # keys filled up with zeros that are equal differ by their lengths at most
        heads = np.flatnonzero(prefix < 8 * step + 8 if step < steps else (prefix < lengths) | (place == 0))
        mine = open_[heads]
        if not mine.any():
            break
        tied = np.diff(heads, append=n)
        which = heads[mine]
        word = _look(rows, which, step) if step < steps else lengths[which].astype(np.uint64)
        order = np.argsort(begin[which], kind="stable")
        group = begin[which][order]
        apart = group[1:] != group[:-1]
        uneven = ~apart & (word[order][1:] != word[order][:-1])
        if uneven.any():
            number = np.cumsum(np.append(False, apart))
            among = np.flatnonzero(np.isin(number, number[1:][uneven]))
            order[among] = order[among][np.lexsort((word[order[among]], number[among]))]
        word, size, owner = word[order], tied[mine][order], run[which][order]
        first = np.append(True, apart)
        fresh = first.copy()
        fresh[1:] |= word[1:] != word[:-1]
        before = np.cumsum(size) - size
        start = group + np.maximum.accumulate(np.where(fresh, before, 0)) - np.maximum.accumulate(np.where(first, before, 0))
        new = np.flatnonzero(fresh & ~first)
        differ = word[new] ^ word[new - 1]
        parted[start[new]] = 8 * step + sum((differ < np.uint64(1 << bits)).astype(np.int64) for bits in range(8, 64, 8))
        number = np.cumsum(fresh) - 1
        several = np.zeros(number[-1] + 1, bool)
        several[number[1:][~fresh[1:] & (owner[1:] != owner[:-1])]] = True
        for held, values in ((begin, start), (open_, several[number])):
            told, back = held[heads], np.empty_like(values)
            back[order] = values
            told[mine] = back
            held[:] = np.repeat(told, tied)

    order = np.argsort(begin, kind="stable")
    shared = lengths[order].astype(np.int64)
    follows = np.flatnonzero((np.diff(order) == 1) & (np.diff(run[order]) == 0)) + 1
    shared[follows] = prefix[order[follows]]
    shared = np.where(parted >= 0, parted, shared)
    shared[1:] = np.minimum(shared[1:], np.minimum(lengths[order[1:]], lengths[order[:-1]]))
    shared[:1] = 0
    return np.column_stack((run[order], place[order], shared))


class Runs:
    """Collects suffixes in bounded sorted runs. Equal ones are folded: what is proven repeated is put out as marks at once."""

    def __init__(self, width: int, targets: int, buckets: int, most: int = 300_000) -> None:
        self.width, self.targets, self.buckets, self.most = width, targets, buckets, most
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, rows: np.ndarray, lengths: np.ndarray, key: np.ndarray, doc: np.ndarray, version: np.ndarray, first: np.ndarray, span: np.ndarray) -> None:
        self.held.append((rows, lengths, key, doc, version, first, span))
        self.size += len(rows)

    def full(self) -> bool:
        return self.size >= self.most

    def flush(self) -> Iterator[tuple[int, int, bytes]]:
        """``target, kind, blob`` of the marks and of the run, cut by target."""
        if not self.size:
            return
        rows, lengths, key, doc, version, first, span = (np.concatenate(x) for x in zip(*self.held))
        self.held, self.size = [], 0
        order = np.lexsort((first, version, doc))
        words = np.ascontiguousarray(rows).view(f"S{self.width}").ravel()
        order = order[np.argsort(words[order], kind="stable")]
        rows, lengths, key, doc, version, first, span = (x[order] for x in (rows, lengths, key, doc, version, first, span))
        fresh = np.ones(len(rows), bool)
        fresh[1:] = (rows[1:] != rows[:-1]).any(1) | (lengths[1:] != lengths[:-1])
        heads = np.flatnonzero(fresh)
        group = np.cumsum(fresh) - 1
        later = doc > doc[heads][group]
        yield from marks(doc[later], version[later], first[later], span[later], self.buckets, self.targets)
        stay = ~later
        counts = np.bincount(group[stay], minlength=len(heads))
        target = (key[heads] % np.uint64(self.targets)).astype(np.min_scalar_type(self.targets))
        starts = np.concatenate([[0], np.cumsum(counts)])
        version, first, span = version[stay], first[stay], span[stay]
        by_target = np.argsort(target, kind="stable")
        cuts = np.flatnonzero(np.diff(target[by_target])) + 1
        for own in np.split(by_target, cuts):
            n = counts[own]
            inner = _ranges(starts[own], n)
            yield int(target[own[0]]), _RUN, freeze(
                *front_code(rows[heads[own]], lengths[heads[own]]), doc[heads[own]], n.astype(np.uint32), version[inner], first[inner], span[inner])


def marks(doc, version, first, span, buckets: int, targets: int) -> Iterator[tuple[int, int, bytes]]:
    """Ranges of removable windows, grouped by the bucket of their documents."""
    if len(doc):
        order = np.lexsort((first, version, doc, doc % buckets))
        doc, version, first, span = (x[order] for x in (doc, version, first, span))
        bucket = doc % buckets
        for own in np.split(np.arange(len(doc)), np.flatnonzero(np.diff(bucket)) + 1):
            b = int(bucket[own[0]])
            yield b % targets, _MARKS, freeze(np.array([b]), doc[own], version[own], first[own], span[own])


def open_run(arrays: list[np.ndarray]) -> tuple[Keys, np.ndarray]:
    prefix, lengths, tails = arrays[:3]
    prefix, lengths = prefix.astype(np.int64), lengths.astype(np.int64)
    columns = np.arange(lengths.max(initial=0))
    rows, at = np.zeros((len(lengths), len(columns)), np.uint8), 0
    for s in range(0, len(rows), 10_000):
        told, within = columns < prefix[s:s + 10_000, None], columns < lengths[s:s + 10_000, None]
        own = within & ~told
        block = np.zeros((len(own) + 1, len(columns)), np.uint8)
        block[0] = rows[s - 1]
        n = np.count_nonzero(own)
        block[1:][own] = tails[at:at + n]
        at += n
        # a byte of the prefix is that of the last key before that has its own there
        source = np.maximum.accumulate(np.where(told, 0, np.arange(1, len(block))[:, None]), 0)
        rows[s:s + 10_000] = np.where(within, np.take_along_axis(block, source, 0), 0)
    return Keys(rows, lengths), prefix


class Holders:
    """The distinct keys of some runs in order, and all that hold them.

    Of a key: its row (``width`` bytes), ``shared`` (with the key before) and ``least``, the smallest document. Of a holder, by key: ``doc``, ``key`` (its number) and its places.
    """

    def __init__(self, blobs: list[bytes], width: int) -> None:
        opened, doc, counts, places = [], [], [], []
        for blob in blobs:
            prefix, lengths, tails, docs, n, *spots = thaw(blob)
            opened.append(open_run([prefix, lengths, tails]))
            doc.append(docs)
            counts.append(n.astype(np.int64))
            places.append(spots)
        run, place, shared = merge_runs(opened).T
        sizes = np.array([len(keys) for keys, _ in opened])
        order = (np.cumsum(sizes) - sizes)[run] + place
        lengths = np.concatenate([keys.lengths for keys, _ in opened])[order]
        fresh = np.append(True, (shared[1:] < lengths[:-1]) | (lengths[1:] != lengths[:-1]))
        heads = np.flatnonzero(fresh)
        rows = np.zeros((len(order), width), np.uint8)
        for (keys, _), end in zip(opened, np.cumsum(sizes).tolist()):
            rows[end - len(keys): end, : keys.rows.shape[1]] = keys.rows
        self.rows, self.shared, self.key = rows[order[heads]], shared[heads], np.cumsum(fresh) - 1
        counts = np.concatenate(counts)
        self.doc, self.counts, self.begins = np.concatenate(doc)[order], counts[order], (np.cumsum(counts) - counts)[order]
        self.version, self.first, self.span = (np.concatenate(x) for x in zip(*places))
        self.least = np.minimum.reduceat(self.doc, heads)
        mine = self.doc == self.least[self.key]
        self.later, self.rest = np.flatnonzero(~mine), np.flatnonzero(mine)
        self.rest_key = self.key[self.rest]

    def places(self, which: np.ndarray) -> tuple[np.ndarray, ...]:
        """``doc, version, first, span`` of all places of some holders."""
        at = _ranges(self.begins[which], self.counts[which])
        return np.repeat(self.doc[which], self.counts[which]), self.version[at], self.first[at], self.span[at]

    def kept(self, keys: np.ndarray) -> tuple[np.ndarray, ...]:
        """``number, doc, version, first`` of the places of some keys in their smallest document; ``number`` is the key's index in ``keys``."""
        begin, end = np.searchsorted(self.rest_key, keys), np.searchsorted(self.rest_key, keys, "right")
        which = self.rest[_ranges(begin, end - begin)]
        number = np.repeat(np.repeat(np.arange(len(keys)), end - begin), self.counts[which])
        return number, *self.places(which)[:3]


class Marked:
    """Gathers removable ranges and puts them out in bounded blobs."""

    def __init__(self, buckets: int, targets: int) -> None:
        self.buckets, self.targets, self.held, self.size = buckets, targets, [], 0

    def add(self, *columns: np.ndarray) -> None:
        self.held.append(columns)
        self.size += len(columns[0])

    def flush(self) -> Iterator[tuple[int, int, bytes]]:
        if self.held:
            yield from marks(*(np.concatenate(x) for x in zip(*self.held)), self.buckets, self.targets)
        self.held, self.size = [], 0


# ---- the job -------------------------------------------------------------------------------------------------------------


def _prime_from(n: int) -> int:
    while any(n % p == 0 for p in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def _blobs(rows: Iterable[tuple], names: list[str], kinds: list, every: int = 2000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= every:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)


def _by_bucket(doc: np.ndarray, key: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    if len(doc):
        bucket = doc % buckets
        order = np.lexsort((key, doc, bucket))
        doc, key, bucket = doc[order], key[order], bucket[order]
        for own in np.split(np.arange(len(doc)), np.flatnonzero(np.diff(bucket)) + 1):
            # half of the number is enough to find the anchor again in one document; a wrong one would only add an item
            yield int(bucket[own[0]]), freeze(doc[own], key[own].astype(np.uint32))


class Texts:
    """Texts end to end, up to a bounded size."""

    def __init__(self, most: int = _BLOCK) -> None:
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.parts, self.docs, self.versions, self.size = [], [], [], 0

    def add(self, doc: int, version: int, text: bytes) -> bool:
        self.parts.append(text)
        self.docs.append(doc)
        self.versions.append(version)
        self.size += len(text)
        return self.size >= self.most or len(self.docs) >= 30_000

    def take(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes, ends, ids and versions."""
        data = np.frombuffer(b"".join(self.parts), np.uint8)
        out = data, np.cumsum([len(x) for x in self.parts]), np.array(self.docs, np.int64), np.array(self.versions, np.uint32)
        self.clear()
        return out


def remove_repeats(docs: DataFrame, window: int = 50, anchor: int = 24, buckets: int | None = None, keep_text: bool = False, few: int = 32) -> DataFrame:
    """Removes from each text every byte covered by a ``window``-byte string that also starts in a document with a smaller id.

    Columns: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and, if asked for, ``kept`` (the remaining bytes). Strings are judged on the
    input, as UTF-8 bytes, and never cross documents.

    Each window belongs to an anchor, its run of ``anchor`` bytes with the least hash, so equal windows have equal anchors.
    1. Tasks send the keys of their anchors, each once per task; anchors of one document drop out, as no window around them can repeat.
    2. Around every other anchor the suffix from the anchor to the end of its last window, followed by what lies between its first window and
       the anchor, becomes an item. Tasks sort items, fold equal ones, and exchange front-coded runs by the anchor's key.
    3. Runs are merged eight bytes a step, without a look at prefixes that they share (:func:`merge_runs`). Equal neighbours are repeats of the smallest
       document among them. Up to ``few`` different surroundings of one anchor are settled by the prefixes they share on both sides;
       of more, the windows become the items of a second such sort.
    4. The ranges found meet the texts again.
    A passage that very many documents share is one item per run, not one per document. All comparisons are of bytes; hashes only route.

    Null texts are empty: no bytes, no spans, and the digest of nothing. Rows with a null id come after all ids. Rows with
    equal ids do not count as smaller than one another. An empty table gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    targets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    width = window + window - anchor + 2  # of an item
    buckets = buckets or _prime_from(targets)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID)).alias("doc_id"), text.alias("text"))

    def send_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple[int, int, bytes]]:
            held: list[tuple[np.ndarray, np.ndarray]] = []
            size = 0
            buffer = Texts()

            def read() -> int:
                data, ends, ids, _ = buffer.take()
                first, _, _, key = anchored_ranges(data, ends, window, anchor)
                held.append((key, ids[np.searchsorted(ends, first, "right")]))
                return len(key)

            def flush() -> Iterator[tuple[int, int, bytes]]:
                key, doc = (np.concatenate(x) for x in zip(*held))
                held.clear()
                order = np.argsort(key)
                key, doc = key[order], doc[order]
                twin = np.append(False, key[1:] == key[:-1])
                again = np.flatnonzero(twin | np.append(twin[1:], False))
                doc[again] = doc[again][np.lexsort((doc[again], key[again]))]
                once = np.ones(len(key), bool)
                once[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
                key, doc = key[once], doc[once]
                fresh = np.ones(len(key), bool)
                fresh[1:] = key[1:] != key[:-1]
                heads = np.flatnonzero(fresh)
                many = np.diff(np.append(heads, len(key))) > 1
                shared = np.repeat(many, np.diff(np.append(heads, len(key))))
                for bucket, blob in _by_bucket(doc[shared], key[shared], buckets):
                    yield bucket % targets, bucket, blob
                target = (key[heads] % np.uint64(targets)).astype(np.min_scalar_type(targets))
                by_target = np.argsort(target, kind="stable")
                for own in np.split(by_target, np.flatnonzero(np.diff(target[by_target])) + 1):
                    yield int(target[own[0]]), -1, freeze(key[heads[own]], doc[heads[own]], many[own].astype(np.uint8))

            for batch in batches:
                for doc_id, value in zip(batch["doc_id"].to_pylist(), batch["text"]):
                    if buffer.add(doc_id, 0, value.as_py()):
                        size += read()
                        if size >= 3_000_000:
                            yield from flush()
                            size = 0
            if buffer.docs:
                size += read()
            if size:
                yield from flush()

        yield from _blobs(out(), ["target", "bucket", "data"], [pa.int32(), pa.int32(), pa.binary()])

    def find_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple[int, bytes]]:
            held = []
            for batch in batches:
                for bucket, blob in zip(batch["bucket"].to_pylist(), batch["data"].to_pylist()):
                    if bucket >= 0:
                        yield bucket, blob
                    else:
                        held.append(thaw(blob))
            if held:
                key, doc, many = (np.concatenate(x) for x in zip(*held))
                order = np.argsort(key, kind="stable")
                key, doc, many = key[order], doc[order], many[order]
                fresh = np.ones(len(key), bool)
                fresh[1:] = key[1:] != key[:-1]
                group = np.cumsum(fresh) - 1
                weight = np.bincount(group, weights=1 + many)
                found = (weight[group] > 1) & (many == 0)  # tasks have told their own shared anchors
                yield from _by_bucket(doc[found], key[found], buckets)

        yield from _blobs(out(), ["bucket", "data"], [pa.int32(), pa.binary()])

    def send_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple[int, bytes]]:
            for batch in batches:
                ids = batch["doc_id"].to_numpy()
                order = np.argsort(ids % buckets, kind="stable")
                for own in np.split(order, np.flatnonzero(np.diff(ids[order] % buckets)) + 1):
                    texts = [batch["text"][i].as_py() for i in own.tolist()]
                    yield int(ids[own[0]] % buckets), freeze(ids[own], np.array([len(x) for x in texts], np.int64), np.frombuffer(b"".join(texts), np.uint8))

        yield from _blobs(out(), ["bucket", "data"], [pa.int32(), pa.binary()], every=500)

    def meeting(told: DataFrame) -> DataFrame:
        """What is told of each bucket, then the texts of its documents, which travel as compressed blobs."""
        texts = rows.mapInArrow(send_texts, "bucket int, data binary")
        both = told.select("bucket", F.lit(0).alias("kind"), "data").unionAll(texts.select("bucket", F.lit(1).alias("kind"), "data"))
        return both.repartition("bucket").sortWithinPartitions("bucket", "kind")

    def send_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple[int, int, bytes]]:
            runs, buffer = Runs(width, targets, buckets), Texts()

            def read(known: list[list[np.ndarray]]) -> None:
                data, ends, ids, versions = buffer.take()
                first, last, at, key = anchored_ranges(data, ends, window, anchor)
                if not known or not len(first):
                    return
                text = np.searchsorted(ends, first, "right")
                doc, wanted = (np.concatenate(x) for x in zip(*known))
                # pairs of document and key as one number
                names = np.unique(ids)
                place = np.minimum(np.searchsorted(names, doc), len(names) - 1)
                here = names[place] == doc
                pairs = (wanted[here].astype(np.uint64) << np.uint64(15)) | place[here].astype(np.uint64)
                half = key.astype(np.uint32).astype(np.uint64)
                own = np.isin((half << np.uint64(15)) | np.searchsorted(names, ids[text]).astype(np.uint64), pairs)
                first, last, at, key, text = first[own], last[own], at[own], key[own], text[own]
                whole = np.lib.stride_tricks.sliding_window_view(np.append(data, np.zeros(window, np.uint8)), window)
                for s in range(0, len(first), 50_000):
                    part = slice(s, s + 50_000)
                    f, l, a, t = first[part], last[part], at[part], text[part]
                    right, left = l + window - a, a - f
                    columns = np.arange(width)
                    # the anchor, the two lengths, the rest to the right, and what is left of the anchor
                    length = right + left + 2
                    table = np.zeros((len(f), width), np.uint8)
                    ahead = whole[a]
                    ahead[columns[:window] >= right[:, None]] = 0
                    table[:, :anchor], table[:, anchor + 2:window + 2] = ahead[:, :anchor], ahead[:, anchor:]
                    table[:, anchor], table[:, anchor + 1] = right, left
                    table[(columns >= right[:, None] + 2) & (columns < length[:, None])] = whole[f][columns[:window] < left[:, None]]
                    starts = np.concatenate([[0], ends[:-1]])[t]
                    runs.add(table, length, key[part], ids[t], versions[t], f - starts, (l - f).astype(np.uint8))

            for known, doc_id, version, value, over in _visits(batches):
                if value is not None and buffer.add(doc_id, version, value) or over and buffer.docs:
                    read(known)
                    # a document's items stay in one run: texts are added as a whole
                    if runs.full():
                        yield from runs.flush()
            yield from runs.flush()

        yield from _blobs(out(), ["target", "kind", "data"], [pa.int32(), pa.int32(), pa.binary()])

    def merge_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.random.default_rng(5).integers(1, 1 << 62, window, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

        def out() -> Iterator[tuple[int, int, bytes]]:
            runs, marked = Runs(window, targets, buckets), Marked(buckets, targets)

            def pairs(held: Holders, keys: np.ndarray, begin: np.ndarray, many: np.ndarray, right: np.ndarray, left: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
                """Marks what a few surroundings of one anchor share: with their common parts on both sides all windows in between are equal.

                ``begin`` and ``many`` tell which keys surround the anchor of a key.
                """
                ahead = np.delete(held.rows, [anchor, anchor + 1], 1)[:, :window]
                back = np.take_along_axis(held.rows, (right + left + 1)[:, None] - np.minimum(np.arange(window - anchor), left[:, None]), 1)
                turns = np.cumsum(many[keys]) // 200_000
                for some in np.split(keys, np.flatnonzero(np.diff(turns)) + 1):
                    i, j = np.repeat(some, many[some]), _ranges(begin[some], many[some])
                    smaller = held.least[j] < held.least[i]
                    i, j = i[smaller], j[smaller]
                    # the anchor itself is known to be equal
                    after = np.minimum(_shared(ahead[i], ahead[j], anchor), np.minimum(right[i], right[j]))
                    behind = np.minimum(_shared(back[i], back[j], 0), np.minimum(left[i], left[j]))
                    span = after + behind - window
                    found = np.unique(((i << 16) + (left[i] - behind << 8) + span)[span >= 0])
                    number, doc, version, first = held.kept(found >> 16)
                    marked.add(doc, version, first + (found >> 8 & 255)[number], (found & 255).astype(np.uint8)[number])
                    if marked.size > 200_000:
                        yield from marked.flush()

            def windows(held: Holders, keys: np.ndarray, right: np.ndarray, left: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
                columns = np.arange(2 * window - anchor)
                number, doc, version, first = held.kept(keys)
                for s in range(0, len(number), 4_000):
                    part = slice(s, s + 4_000)
                    key = keys[number[part]]
                    r, l = right[key][:, None], left[key][:, None]
                    source = np.where(columns < l, r + 2 + columns, columns - l + np.where(columns - l < anchor, 0, 2))
                    block = np.take_along_axis(held.rows[key], np.minimum(source, held.rows.shape[1] - 1), 1)
                    n = (r + l)[:, 0] - window + 1
                    own, shift = np.repeat(np.arange(len(key)), n), _ranges(np.zeros(len(key), np.int64), n)
                    rows = np.lib.stride_tricks.sliding_window_view(block, window, 1)[own, shift]
                    hashed = _mixed(rows.astype(np.uint64) @ weights) >> np.uint64(16)
                    runs.add(rows, np.full(len(rows), window), hashed, doc[part][own], version[part][own], first[part][own] + shift, np.zeros(len(rows), np.uint8))
                    if runs.full():
                        yield from runs.flush()

            for kind, value in _targets(batches):
                if kind == _MARKS:
                    yield value
                    continue
                held = Holders(value, width)
                marked.add(*held.places(held.later))
                # the keys that surround one anchor
                begin = np.flatnonzero(held.shared < anchor)
                many = np.diff(begin, append=len(held.shared))
                begin, many = np.repeat(begin, many), np.repeat(many, many)
                right, left = held.rows[:, anchor].astype(np.int64), held.rows[:, anchor + 1].astype(np.int64)
                yield from pairs(held, np.flatnonzero((many > 1) & (many <= few)), begin, many, right, left)
                yield from windows(held, np.flatnonzero((many > 1) & (many > few)), right, left)
            yield from runs.flush()
            yield from marked.flush()

        yield from _blobs(out(), ["target", "kind", "data"], [pa.int32(), pa.int32(), pa.binary()])

    def merge_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple[int, bytes]]:
            marked = Marked(buckets, targets)
            for kind, value in _targets(batches):
                if kind == _MARKS:
                    yield int(thaw(value[2])[0][0]), value[2]
                    continue
                held = Holders(value, window)
                marked.add(*held.places(held.later))
            for _, _, blob in marked.flush():
                yield int(thaw(blob)[0][0]), blob

        yield from _blobs(out(), ["bucket", "data"], [pa.int32(), pa.binary()])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            table: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
            seen = None
            for known, doc_id, version, value, _ in _visits(batches):
                if known is not seen:
                    seen, table = known, {}
                    if known:
                        _, doc, ver, first, span = (np.concatenate(x) for x in zip(*known))
                        order = np.lexsort((ver, doc))
                        doc, ver, first, span = doc[order], ver[order], first[order], span[order].astype(np.int64)
                        heads = np.flatnonzero((np.diff(doc, prepend=doc[0] - 1 if doc[0] > -_NO_ID else doc[0] + 1) != 0) | (np.diff(ver.astype(np.int64), prepend=-1) != 0))
                        for s, e in zip(heads.tolist(), [*heads[1:].tolist(), len(doc)]):
                            table[int(doc[s]), int(ver[s])] = first[s:e], first[s:e] + span[s:e] + window
                if value is None:
                    continue
                n = len(value)
                ranges = table.get((doc_id, version))
                if ranges is None:
                    kept, removed, spans = value, 0, 0
                else:
                    steps = np.bincount(ranges[0], minlength=n + 1) - np.bincount(ranges[1], minlength=n + 1)
                    gone = np.cumsum(steps)[:n] > 0
                    kept = np.frombuffer(value, np.uint8)[~gone].tobytes()
                    removed, spans = n - len(kept), int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
                yield (None if doc_id == _NO_ID else doc_id), n, removed, spans, hashlib.sha256(kept).hexdigest(), kept if keep_text else None

        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        yield from _blobs(out(), ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"], kinds)

    shared = rows.mapInArrow(send_anchors, "target int, bucket int, data binary").repartition("target").mapInArrow(find_shared, "bucket int, data binary")
    items = meeting(shared).mapInArrow(send_items, "target int, kind int, data binary")
    once = items.repartition("target").sortWithinPartitions("target").mapInArrow(merge_items, "target int, kind int, data binary")
    found = once.repartition("target").sortWithinPartitions("target").mapInArrow(merge_windows, "bucket int, data binary")
    out = meeting(found).mapInArrow(cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
    return out if keep_text else out.drop("kept")


def _visits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, int | None, int, bytes | None, bool]]:
    """``known, doc_id, version, text, over`` for the texts of each bucket, by id; ``known`` is what was told of the bucket.

    ``over`` marks the end of a bucket, which comes without a text. Equal ids with different texts get versions 0, 1, ...
    """

    def visit(known: list, blobs: list[bytes]) -> Iterator[tuple]:
        texts = []
        for blob in blobs:
            ids, lengths, data = thaw(blob)
            data, at = data.tobytes(), 0
            for i, n in zip(ids.tolist(), lengths.tolist()):
                texts.append((i, data[at:at + n]))
                at += n
        texts.sort()
        last, version = None, 0
        for doc_id, text in texts:
            if last is not None and last[0] == doc_id:
                version += last[1] != text
            else:
                version = 0
            last = (doc_id, text)
            yield known, doc_id, version, text, False
        yield known, None, 0, None, True

    bucket, known, blobs = None, [], []
    for batch in batches:
        for b, kind, data in zip(batch["bucket"].to_pylist(), batch["kind"].to_pylist(), batch["data"].to_pylist()):
            if b != bucket:
                if bucket is not None:
                    yield from visit(known, blobs)
                bucket, known, blobs = b, [], []
            if kind == 0:
                known.append(thaw(data))
            else:
                blobs.append(data)
    if bucket is not None:
        yield from visit(known, blobs)


def _targets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, object]]:
    """Marks as they come, as (kind, row); the runs of each target together, as (kind, blobs)."""
    target, runs = None, []
    for batch in batches:
        for t, kind, data in zip(batch["target"].to_pylist(), batch["kind"].to_pylist(), batch["data"].to_pylist()):
            if t != target:
                if runs:
                    yield _RUN, runs
                target, runs = t, []
            if kind == _MARKS:
                yield _MARKS, (t, _MARKS, data)
            else:
                runs.append(data)
    if runs:
        yield _RUN, runs
