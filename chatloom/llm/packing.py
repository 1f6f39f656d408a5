"""Best-fit packing of tokenised documents into training sequences."""

from __future__ import annotations

import math
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatloom.session import cut_lineage, text_batches

_MARKS = ".,!?;:$#*%&|<>"
_LONGEST_KEPT = 48  # bytes of a chunk whose ids are remembered


def _kinds(of: str | range) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(x) for x in of] if isinstance(of, str) else list(of)] = True
    return out


_IS_MARK = _kinds(_MARKS)
_IS_NAME = _kinds("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
#: White space, and the first bytes of characters that may be white space.
_MAY_BE_SPACE = _kinds(range(0x21)) | _kinds("\u00c2\u00e1\u00e2\u00e3")


def _goes_on(data: np.ndarray, follows: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Those of the places ``at`` that are followed by something else than white space. ``follows``: the next byte, white space at the end of a text."""
    first = follows[at]
    surely = ~_MAY_BE_SPACE[first]
    wide = np.flatnonzero((first >= 0xC2) & ~surely)
    second, third = data[at[wide] + 2], data[np.minimum(at[wide] + 3, len(data) - 1)]
    first = first[wide]
    surely[wide] = (first == 0xC2) & (second != 0x85) & (second != 0xA0) | (first == 0xE2) & (second > 0x81) | (first == 0xE2) & (second == 0x80) & (third > 0x8A) & (third < 0xA8) | (first == 0xE3) & (second != 0x80)
    return at[surely]


def _binary(offsets: np.ndarray, data: bytes | np.ndarray) -> pa.LargeBinaryArray:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])


def _parts(array: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of an array."""
    _, offsets, data = array.buffers()
    return np.frombuffer(offsets, np.int64)[array.offset:array.offset + len(array) + 1], np.frombuffer(data or b"", np.uint8)


class Known:
    """Chunks and their ids, side by side in Arrow arrays: a fraction of the memory of Python's objects."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.chunks = self.ids = pa.array([], pa.large_binary())

    def __iter__(self) -> Iterator[bytes]:
        return iter(self.chunks.to_pylist())


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit numbers, by a byte-level tokenizer file.

    Such a tokenizer never joins what stands left and right of a space that is followed by something else than white space, so
    texts are cut there, each distinct chunk is encoded once for many texts, and the ids of chunks are remembered within a bound. With the plain byte-level split
    a line feed followed by something else than white space is a token of its own, and so is what comes before a mark after a letter or a digit; texts are cut
    there too. A text that holds an added token of the file literally goes to the tokenizer as it is.
    """

    def __init__(self, path: str, most: int = 400_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.most = most
        self.known = Known()
        size = self.tokenizer.get_vocab_size()
        # ids whose bytes begin with a space
        self.opens = np.array([(self.tokenizer.id_to_token(i) or "").startswith("\u0120") for i in range(size)], bool)
        split = self.tokenizer.pre_tokenizer
        self.lines = isinstance(split, ByteLevel) and split.use_regex and not split.add_prefix_space and self.tokenizer.normalizer is None
        self.feed = self.tokenizer.token_to_id("\u010a")

    def encode(self, texts: list[str]) -> list[bytes]:
        whole = [i for i, t in enumerate(texts) if any(a in t for a in self.added)]
        if whole:
            out = dict(zip(whole, self._ids([texts[i] for i in whole])))
            rest = iter(self.encode([t for i, t in enumerate(texts) if i not in out]))
            return [out[i] if i in out else next(rest) for i in range(len(texts))]
        bounds, data = _parts(pa.array(texts, pa.large_string()))
        if not bounds[-1]:
            return [b""] * len(texts)
        starts = self._cuts(data, bounds)
        coded = _binary(np.append(starts, bounds[-1]), data).dictionary_encode()
        chunks, which = coded.dictionary, coded.indices.to_numpy()
        known = self.known
        row = pc.index_in(chunks, value_set=known.chunks).fill_null(-1).to_numpy().astype(np.int64)
        lacking = np.flatnonzero(row < 0)
        order, new = self._encoded(chunks.take(pa.array(lacking)))
        row[lacking[order]] = len(known.ids) + np.arange(len(lacking))
        ids = pa.concat_arrays([known.ids, new])
        at, found = _parts(ids.take(pa.array(row[which])))
        out = found.tobytes()
        ends = at[np.searchsorted(starts, bounds)].tolist()
        if len(lacking):
            every = pa.concat_arrays([known.chunks, chunks.take(pa.array(lacking[order]))])
            # what these texts have stays
            stay = np.sort(row) if len(every) > self.most else np.arange(len(every))
            stay = pa.array(stay[np.diff(_parts(every)[0])[stay] <= _LONGEST_KEPT])
            known.chunks, known.ids = every.take(stay), ids.take(stay)
        return [out[a:b] for a, b in zip(ends, ends[1:])]

    def _cuts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where chunks start."""
        follows = np.append(data[1:], np.uint8(0x20))
        follows[bounds[1:][bounds[1:] > 0] - 1] = 0x20
        starts = np.zeros(len(data) + 1, bool)
        starts[bounds] = True
        starts[_goes_on(data, follows, np.flatnonzero(data == 0x20))] = True
        if self.lines:
            feeds = _goes_on(data, follows, np.flatnonzero(data == 0x0A))
            starts[feeds] = starts[feeds + 1] = True
            marks = np.flatnonzero(_IS_MARK[data])
            last, lead = data[np.maximum(marks - 1, 0)], data[np.maximum(marks - 2, 0)]
            # U+00C0 to U+027F are letters but for two signs
            latin = (last >= 0x80) & (last < 0xC0) & (lead >= 0xC3) & (lead <= 0xC9) & ~((lead == 0xC3) & ((last == 0x97) | (last == 0xB7)))
            starts[marks[_IS_NAME[last] | latin]] = True
        return np.flatnonzero(starts[:-1])

    def _encoded(self, chunks: pa.LargeBinaryArray, together: int = 400) -> tuple[np.ndarray, pa.LargeBinaryArray]:
        """Ids of distinct chunks, in the order of the places that come first.

        Chunks without white space but for one space before them are encoded many together and told apart by that space; those without any by line feeds put
        before them. The others are encoded one by one.
        """
        offsets, data = _parts(chunks)
        if not len(chunks):
            return np.zeros(0, np.int64), chunks
        head = data[offsets[:-1]]
        many = np.append(0, np.cumsum(_MAY_BE_SPACE[data], dtype=np.int64))
        odd = many[offsets[1:]] - many[offsets[:-1] + 1] > 0
        spaced = (head == 0x20) & ~odd & (np.diff(offsets) > 1)
        bare = ~_MAY_BE_SPACE[head] & ~odd if self.lines else np.zeros(len(chunks), bool)
        order, out = [], []
        for kind, before in ((np.flatnonzero(spaced), b""), (np.flatnonzero(bare), b"\n")):
            if not len(kind):
                continue
            words = [data[a:b].tobytes() for a, b in zip(offsets[kind].tolist(), offsets[kind + 1].tolist())]
            groups = [(before + before.join(words[i:i + together])).decode() for i in range(0, len(words), together)]
            ids = np.frombuffer(b"".join(self._ids(groups)), "<u4")
            if before:
                fed = ids == self.feed
                cuts = np.flatnonzero(fed) - np.arange(len(kind))
                ids = ids[~fed]
            else:
                cuts = np.flatnonzero(self.opens[ids])
            if len(cuts) != len(kind):
                raise ValueError("the tokenizer joins what a space or a line feed parts")
            order.append(kind)
            out.append(_binary(np.append(cuts, len(ids)) * 4, ids.tobytes()))
        alone = np.flatnonzero(~spaced & ~bare)
        if len(alone):
            order.append(alone)
            texts = [data[a:b].tobytes().decode() for a, b in zip(offsets[alone].tolist(), offsets[alone + 1].tolist())]
            out.append(pa.array(self._ids(texts), pa.large_binary()))
        return np.concatenate(order), pa.concat_arrays(out)

    def _ids(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for i in range(0, len(texts), 32):
            out += [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts[i:i + 32], add_special_tokens=False)]
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process, so that remembered chunks serve all its tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``): a document's ids and the end id, cut only when longer than ``capacity``.

    All pieces but the first are full.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            text, ids_of = batch["text"], batch["doc_id"].to_pylist()
            sizes = pc.binary_length(text).to_pylist()
            rows: list[tuple] = []
            # a bounded number of bytes at a time
            at = 0
            while at < len(sizes):
                size, to = 0, at
                while to < len(sizes) and (to == at or size < 3_000_000):
                    size += sizes[to]
                    to += 1
                for doc_id, ids in zip(ids_of[at:to], coder.encode(text.slice(at, to - at).to_pylist())):
                    ids += end
                    n = len(ids) // 4
                    start, piece = 0, 0
                    while start < n:
                        length = capacity if piece or n % capacity == 0 else n % capacity
                        part = ids[4 * start:4 * (start + length)]
                        rows.append((doc_id, piece, start, length, zlib.crc32(part), part if keep_ids else None))
                        start, piece = start + length, piece + 1
                at = to
                pa.default_memory_pool().release_unused()
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    out = docs.select(F.col("doc_id").cast("bigint"), text).mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary")
    return out if keep_ids else out.drop("ids")


@dataclass(frozen=True)
class Slot:
    """Pieces of one length with ranks from ``first``: ``copies`` side by side from ``offset`` in each of ``bins`` sequences."""

    length: int
    first: int
    copies: int
    bins: int
    sequence: int
    offset: int


def best_fit(counts: dict[int, int], capacity: int = 2048, max_pieces: int | None = None, max_cost: int | None = None,
             weights: tuple[float, float, float] = (1.0, 0.05, 0.05)) -> list[Slot]:
    """Vector best fit over a histogram of lengths, longest first.

    A piece of length x asks for (x tokens, 1 document, x * x of attention cost). Among the open sequences with room in all three it takes the one
    whose residual, scaled by the capacities, has the smallest weighted norm after the piece. Pieces of one length are alike and so are
    sequences with the same residual, so both are handled by number: the work depends on ``capacity``, not on the number of documents.
    """
    most = (capacity, max_pieces or capacity, max_cost or capacity * capacity)
    scale = [w / m**2 for w, m in zip(weights, most)]
    # open sequences by residual: number of sequences and content as (length, copies); closed ones are final
    groups: list[list] = []
    residual = np.zeros((0, 3), np.int64)
    for length in sorted((x for x, n in counts.items() if n), reverse=True):
        ask = np.array([length, 1, length * length])
        if (ask > most).any():
            raise ValueError(f"a piece of {length} tokens exceeds the capacities {most}")
        left = counts[length]
        while left:
            fits = np.flatnonzero((residual >= ask).all(1))
            if len(fits):
                after = residual[fits] - ask
                g = int(fits[np.argmin((after * after) @ scale)])
                per = int((residual[g] // ask).min())
                bins, content = groups[g]
                rest = residual[g].copy()
            else:
                rest = np.array(most)
                per = int((rest // ask).min())
                g, bins, content = -1, math.ceil(left / per), ()
            # the same sequence stays the best one for further pieces of this length until it is full
            whole = min(bins, left // per)
            use, copies = (whole, per) if whole else (1, left)
            if g >= 0:
                groups[g][0] -= use
                if not groups[g][0]:
                    residual[g] = -1
            groups.append([use, (*content, (length, copies))])
            residual = np.vstack([residual, rest - copies * ask])
            left -= use * copies
        alive = np.array([x[0] > 0 for x in groups])
        if not alive.all():
            groups = [x for x in groups if x[0] > 0]
            residual = residual[alive]
    slots: list[Slot] = []
    rank: dict[int, int] = {}
    sequence = 0
    for bins, content in groups:
        offset = 0
        for length, copies in content:
            slots.append(Slot(length, rank.get(length, 0), copies, bins, sequence, offset))
            rank[length] = rank.get(length, 0) + bins * copies
            offset += length * copies
        sequence += bins
    return slots


def ranked(rows: DataFrame, counts: dict[int, int], per_bucket: int = 20_000) -> DataFrame:
    """``rank`` (from 0) of each piece among those of its length, by a hash of the piece and then its place.

    A length is cut into buckets of about ``per_bucket`` pieces, so a frequent length is no single task.
    """
    # at most one line per possible length
    widths = F.create_map(*[F.lit(x) for n in counts for x in (n, max(1, math.ceil(counts[n] / per_bucket)))])
    keyed = rows.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), widths[F.col("length")].cast("bigint")))
    sizes = keyed.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece")
    placed = keyed.withColumn("_in", F.row_number().over(inside)).join(bases, ["length", "_bucket"])
    return placed.withColumn("rank", F.col("_base") + F.col("_in") - 1).drop("_bucket", "_in", "_base")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, max_pieces: int | None = None,
                   max_cost: int | None = None, keep_ids: bool = False) -> DataFrame:
    """Every piece with its place: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``).

    Lengths are counted over all documents; the driver sees the histogram, at most ``capacity`` numbers, and plans sequences by
    number (:func:`best_fit`). A piece finds its sequence from its rank among pieces of its length. No sequence
    exceeds ``capacity`` tokens, ``max_pieces`` pieces or ``max_cost`` of summed squared lengths (a full piece must fit), and none has a gap.

    Null texts count as empty: one piece, the end id. Repeated rows are packed one by one. An empty table gives an empty
    result. Other columns are ignored.
    """
    with text_batches(docs.sparkSession):
        rows = cut_lineage(pieces(docs, tokenizer, capacity, end_id, keep_ids))
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return rows.withColumns({"sequence_id": F.lit(0).cast("bigint"), "offset": F.lit(0).cast("bigint")})
    by_length: dict[int, list[Slot]] = {}
    for slot in best_fit(counts, capacity, max_pieces, max_cost):
        by_length.setdefault(slot.length, []).append(slot)
    table = {n: np.array([(s.first, s.copies, s.sequence, s.offset) for s in slots], np.int64).T for n, slots in by_length.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = batch["length"].to_numpy(), batch["rank"].to_numpy()
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for n in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == n)
                first, copies, base, start = table[n]
                slot = np.searchsorted(first, ranks[at], "right") - 1
                place = ranks[at] - first[slot]
                sequence[at] = base[slot] + place // copies[slot]
                offset[at] = start[slot] + place % copies[slot] * n
            kept = [batch[k] for k in batch.schema.names if k != "rank"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=names)

    placed = ranked(rows, counts).select(*rows.columns, "rank")
    names = [*rows.columns, "sequence_id", "offset"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields) + ", sequence_id bigint, offset bigint"
    return placed.mapInArrow(run, schema)
