"""The prefix trie of conversations: adaptive radix trees over fixed-width turn ids, merged into one trie."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.plans.positions import salted_lookup, with_places
from chatloom.session import cut_lineage

#: Bytes of a turn id: the leading ones of a SHA-256, compared as a big-endian number.
WIDTH = 16
ROOT = bytes(WIDTH)
_NO_ENDS = hashlib.sha256(b"").hexdigest()


# ---- adaptive radix tree


class Sorted:
    """Up to 4 or 16 children: their bytes in order beside the children."""

    def __init__(self, room: int):
        self.room, self.bytes, self.children = room, bytearray(), []

    def get(self, b: int):
        at = bisect_left(self.bytes, b)
        return self.children[at] if at < len(self.bytes) and self.bytes[at] == b else None

    def put(self, b: int, child):
        at = bisect_left(self.bytes, b)
        if at < len(self.bytes) and self.bytes[at] == b:
            self.children[at] = child
            return self
        if len(self.bytes) == self.room:
            grown = Sorted(16) if self.room == 4 else Indexed()
            for k, c in self.items():
                grown.put(k, c)
            return grown.put(b, child)
        self.bytes.insert(at, b)
        self.children.insert(at, child)
        return self

    def items(self):
        return zip(self.bytes, self.children)


class Indexed:
    """Up to 48 children: 256 one-byte places into a short list."""

    def __init__(self):
        self.index, self.children = bytearray(b"\xff" * 256), []

    def get(self, b: int):
        at = self.index[b]
        return None if at == 255 else self.children[at]

    def put(self, b: int, child):
        at = self.index[b]
        if at != 255:
            self.children[at] = child
            return self
        if len(self.children) == 48:
            grown = Direct()
            for k, c in self.items():
                grown.put(k, c)
            return grown.put(b, child)
        self.index[b] = len(self.children)
        self.children.append(child)
        return self

    def items(self):
        return ((b, self.children[at]) for b, at in enumerate(self.index) if at != 255)


class Direct:
    """One place per byte."""

    def __init__(self):
        self.children = [None] * 256

    def get(self, b: int):
        return self.children[b]

    def put(self, b: int, child):
        self.children[b] = child
        return self

    def items(self):
        return ((b, c) for b, c in enumerate(self.children) if c is not None)


class Node:
    """A compressed path ``path``, then a branch by the next byte; ``value`` belongs to the key that ends after the path."""

    __slots__ = ("path", "kids", "value")

    def __init__(self, path: bytes, value=None):
        self.path, self.kids, self.value = path, None, value

    def child(self, b: int):
        return self.kids.get(b) if self.kids is not None else None

    def hang(self, b: int, child: "Node") -> None:
        self.kids = (self.kids if self.kids is not None else Sorted(4)).put(b, child)


def insert(root: Node | None, key: bytes, value) -> Node:
    """The tree with ``key`` in it; a key that is there gets the new value."""
    if root is None:
        return Node(key, value)
    node, above, at = root, None, 0
    while True:
        path = node.path
        n = min(len(path), len(key) - at)
        same = n if path[:n] == key[at: at + n] else next(i for i in range(n) if path[i] != key[at + i])
        if same < len(path):
            # the path parts here: its head becomes a node of its own
            head = Node(path[:same])
            node.path = path[same + 1:]
            head.hang(path[same], node)
            if at + same == len(key):
                head.value = value
            else:
                head.hang(key[at + same], Node(key[at + same + 1:], value))
            if above is None:
                return head
            above[0].hang(above[1], head)
            return root
        at += len(path)
        if at == len(key):
            node.value = value
            return root
        nxt = node.child(key[at])
        if nxt is None:
            node.hang(key[at], Node(key[at + 1:], value))
            return root
        above, node, at = (node, key[at]), nxt, at + 1


# ---- nodes of the trie


def _name(prefix: bytes) -> bytes:
    return hashlib.sha256(prefix).digest()[:WIDTH]


class _Part:
    """What hangs below a point of a path: totals, and the lines of the nodes right below that still lack their parent."""

    __slots__ = ("n", "least", "children", "leaves", "saved", "below", "first")

    def __init__(self):
        self.n, self.least, self.children, self.leaves, self.saved, self.below, self.first = 0, None, 0, 0, 0, [], None

    def add(self, other: "_Part") -> None:
        self.n += other.n
        self.least = other.least if self.least is None else min(self.least, other.least)
        self.children += other.children
        self.leaves += other.leaves
        self.saved += other.saved
        self.below += other.below
        self.first = self.first or other.first


def trie_lines(keys: list[dict]) -> list[tuple]:
    """Trie nodes of sorted distinct keys: closed ones are final but for what an open parent adds, open ones (on the way to the first or the last key) may go on elsewhere.

    A key is ``state`` (name of the node where it starts), ``ids``, ``sizes``, ``n``, ``least``, ``ends``, and ``children, leaves, saved`` of what goes on below its end.
    """
    tree = None
    for key in keys:
        tree = insert(tree, key["state"] + key["ids"], key)
    first, last = (keys[i]["state"] + keys[i]["ids"] for i in (0, -1))
    out: list[tuple] = []

    def is_open(prefix: bytes) -> bool:
        return first.startswith(prefix) or last.startswith(prefix)

    def node_at(part: _Part, end: int, terminal: dict | None) -> None:
        """Makes the node at byte ``end`` out of what hangs below it."""
        whole = part.first["state"] + part.first["ids"]
        prefix, depth = whole[:end], end // WIDTH - 1
        size = part.first["sizes"][depth - 1] if depth else 0
        ends = terminal["ends"] if terminal else None
        # a starting node is always open: it is known by its state
        if not depth or is_open(prefix):
            ways = [prefix[:WIDTH] if i == WIDTH else _name(prefix[:i]) for i in range(WIDTH, end, WIDTH)]
            name = _name(prefix) if depth else prefix
            for line in part.below:
                out.append((*line, None, name))
            out.append((True, depth, part.least, part.n, part.children, part.leaves, part.saved, ends, size, [*ways, name], None, ways[-1] if ways else None))
            part.below, part.children, part.leaves, part.saved = [], 0, 0, 0
            return
        for line in part.below:
            out.append((*line, part.least, None))
        leaves, saved = part.leaves or 1, part.saved + (part.n - 1) * size
        part.below = [(False, depth, part.least, part.n, part.children, leaves, saved, ends, size, None)]
        part.children, part.leaves, part.saved = 1, leaves, saved

    # post-order without recursion: a node is opened, its children are folded into its part, then its path is climbed
    parts: list[_Part] = []
    work: list[tuple[Node, int, bool]] = [(tree, 0, False)]
    while work:
        node, start, done = work.pop()
        if not done:
            parts.append(_Part())
            work.append((node, start, True))
            below = start + len(node.path) + 1
            if node.kids is not None:
                work.extend((child, below, False) for _, child in node.kids.items())
            continue
        part, end = parts.pop(), start + len(node.path)
        terminal = node.value
        if terminal is not None:
            part.n += terminal["n"]
            part.least = terminal["least"] if part.least is None else min(part.least, terminal["least"])
            part.first = terminal
            part.children += terminal["children"]
            part.leaves += terminal["leaves"]
            part.saved += terminal["saved"]
        # the byte before the path belongs to this node, too: it chose this child
        at = end - end % WIDTH
        while at >= max(start, WIDTH):
            node_at(part, at, terminal if at == end else None)
            at -= WIDTH
        if parts:
            parts[-1].add(part)
    return out


_LINES = ("open boolean, depth bigint, least bigint, n bigint, children bigint, leaves bigint, saved bigint, ends string, size bigint, "
          "ways array<binary>, parent_least bigint, parent binary")
_LINE_TYPES = [pa.bool_(), *[pa.int64()] * 6, pa.string(), pa.int64(), pa.list_(pa.binary()), pa.int64(), pa.binary()]
_LINE_NAMES = [c.split()[0] for c in _LINES.split(", ")]


def _tries(chunk_bytes: int):
    """Sorted keys to trie lines, one tree per stretch of about ``chunk_bytes`` of keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            lines = trie_lines(held)
            for i in range(0, len(lines), 50_000):
                columns = list(zip(*lines[i: i + 50_000]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _LINE_TYPES)], names=_LINE_NAMES)

        for batch in batches:
            for key in batch.to_pylist():
                held.append(key)
                size += len(key["ids"]) + 64
                if size >= chunk_bytes:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return run


def _distinct_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and conversation to one row per key; the ids that end there pass through a running SHA-256."""
    names = ["level", "state", "ids", "sizes", "next", "n", "least", "ends"]
    types = [pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.int64(), pa.string()]
    current = None
    rows: list[tuple] = []

    def done() -> None:
        rows.append((*current["row"], current["n"], current["least"], current["sha"].hexdigest() if current["sha"] else None))

    for batch in batches:
        for level, state, ids, sizes, nxt, conv, ends, name in zip(*(batch[c].to_pylist() for c in ("level", "state", "ids", "sizes", "next", "conv", "ends", "name"))):
            if current is None or name != current["name"]:
                if current:
                    done()
                current = {"name": name, "row": [level, state, ids, sizes, nxt], "n": 0, "least": conv, "sha": None}
            current["n"] += 1
            current["least"] = min(current["least"], conv)
            current["row"][4] = current["row"][4] or nxt
            if ends:
                if current["sha"] is None:
                    current["sha"] = hashlib.sha256(str(conv).encode())
                else:
                    current["sha"].update(b",%d" % conv)
        if len(rows) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
            rows.clear()
    if current:
        done()
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of long conversations, sorted by conversation and level, to the names of the nodes where the next pieces start."""
    conv, state = None, ROOT
    for batch in batches:
        out = []
        for c, level, ids in zip(batch["conv"].to_pylist(), batch["level"].to_pylist(), batch["ids"].to_pylist()):
            if c != conv:
                conv, state = c, ROOT
            state = _name(state + ids)
            out.append((c, level + 1, state))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary()))], names=["conv", "level", "state"])


def rebuilt_turns(turns: DataFrame, heads: int = 9, family: int = 5) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns ``conv, at, key, size`` and conversations ``conv, length`` (turnless ones too).

    Conversation c takes the first h = crc32(c) % ``heads`` turns of conversation c - c % ``family``, then its own turns after its first h.
    Turns are placed by one global sort of ids and keys, so a conversation of any length is spread over tasks.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    narrow = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv"), F.col("turn").cast("bigint").alias("turn"),
        F.substring(F.unhex(F.sha2(whole.cast("binary"), 256)), 1, WIDTH).alias("key"), F.octet_length(text).cast("bigint").alias("size"))
    placed = cut_lineage(with_places(narrow, ["conv", "turn", "key"], "place"))
    held = cut_lineage(placed.groupBy("conv").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n_own")).withColumn(
        "base", F.col("conv") - F.col("conv") % family).withColumn("h", F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(heads))))
    bases = held.select(F.col("conv").alias("base"), F.col("n_own").alias("n_base"))
    facts = held.join(bases, "base", "left").withColumn("n_head", F.least("h", F.coalesce("n_base", F.lit(0))))
    facts = cut_lineage(facts.withColumn("length", F.col("n_head") + F.greatest(F.lit(0), F.col("n_own") - F.col("h"))))
    own = salted_lookup(placed, facts.select("conv", "first", "n_own", "h", "n_head", "base"), "conv", "n_own").withColumn("pos", F.col("place") - F.col("first"))
    tail = own.filter("pos >= h").select("conv", (F.col("pos") - F.col("h") + F.col("n_head")).alias("at"), "key", "size")
    lead = own.filter(F.col("pos") < heads).select(F.col("conv").alias("base"), "pos", "key", "size")
    # a base has at most `family` members on either side of zero, and lends each at most `heads` turns
    members = facts.select("conv", "base", "h")
    head = members.join(lead, "base").filter("pos < h").select("conv", F.col("pos").alias("at"), "key", "size")
    return tail.unionByName(head), facts.select("conv", "length")


def conversation_trie(turns: DataFrame, piece: int = 512, chunk_bytes: int = 4 << 20, heads: int = 9, family: int = 5) -> DataFrame:
    """Nodes of the prefix trie of rebuilt conversations (:func:`rebuilt_turns`): ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    A turn (role, text) is known by the first 16 bytes of a SHA-256, so a conversation is a byte key of fixed-width ids.
    1. Conversations are cut into pieces of ``piece`` turns. A piece starts at a node named by a digest of everything before it, so no key is longer than a piece.
       Equal pieces become one key; the ids that end at it run through a SHA-256 in order, one at a time.
    2. Keys are sorted over all tasks by sampled splitters. Each stretch of them becomes an adaptive radix tree with compressed paths, whose turn-aligned depths are nodes.
       Nodes on the way to the first and the last key of a stretch may go on in another one: they leave the task open, with partial totals, and are merged by name.
       So neither a hot first turn nor a hot prefix fills one task.
    3. Deep pieces come first, their totals go into the nodes that they hang from. Pieces that no other conversation shares need no tree; so there are as many
       rounds as the longest shared prefix has pieces.

    Turns without conv_id belong to no conversation and are left out. Null role and text are ''; a null turn number comes first; equal numbers go by the digest of
    role and text. Repeated rows are turns of their own. Without any conversation there is no node. Other columns are ignored.
    """
    rows, convs = rebuilt_turns(turns, heads, family)
    level = F.floor(F.col("at") / piece).cast("bigint")
    item = F.struct("at", "key", "size")
    cut = rows.groupBy("conv", level.alias("level")).agg(F.sort_array(F.collect_list(item)).alias("turns"))
    ids = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["key"])), ""))
    cut = cut.select("conv", "level", ids.alias("ids"), F.transform("turns", lambda t: t["size"]).alias("sizes"))
    lone = convs.filter("length = 0").select("conv", F.lit(0).cast("bigint").alias("level"), F.lit(b"").alias("ids"), F.array().cast("array<bigint>").alias("sizes"))
    pieces = cut_lineage(cut.unionByName(lone).join(convs, "conv").withColumn("ends", F.col("length") <= (F.col("level") + 1) * piece))
    deepest = pieces.agg(F.max("level")).first()[0]
    root = F.lit(ROOT)
    alone = None
    if not deepest:  # no conversation is longer than a piece
        keyed = pieces.withColumn("state", root).withColumn("next", F.lit(None).cast("binary"))
        levels = 0
    else:
        long = pieces.filter(~F.col("ends")).select("conv", "level", "ids").repartition("conv").sortWithinPartitions("conv", "level")
        states = cut_lineage(long.mapInArrow(_states, "conv bigint, level bigint, state binary"))
        crowd = states.groupBy("state").agg(F.count(F.lit(1)).alias("n_state"))
        told = salted_lookup(states, crowd, "state", "n_state")
        reached = told.select("conv", "level", "state", "n_state")
        left = told.select("conv", (F.col("level") - 1).alias("level"), F.col("state").alias("next"))
        keyed = pieces.join(reached, ["conv", "level"], "left").join(left, ["conv", "level"], "left")
        keyed = cut_lineage(keyed.withColumn("state", F.coalesce("state", root)).withColumn("n_state", F.coalesce("n_state", F.lit(2))))
        alone = keyed.filter("level > 0 AND n_state = 1")
        keyed = keyed.filter("level = 0 OR n_state > 1")
        levels = keyed.agg(F.max("level")).first()[0]

    named = keyed.withColumn("name", F.unhex(F.sha2(F.concat("state", "ids"), 256)))
    streamed = named.select("level", "state", "ids", "sizes", "next", "conv", "ends", "name").repartition("name").sortWithinPartitions("name", "conv")
    keys = cut_lineage(streamed.mapInArrow(
        _distinct_keys, "level bigint, state binary, ids binary, sizes array<bigint>, next binary, n bigint, least bigint, ends string"))

    # a node where pieces start has members that end there, too: they are known from the keys above it
    uppers = keys.filter("next IS NOT NULL").select(F.col("next").alias("state"), F.col("least").alias("upper"))
    parts = []
    below = None
    for at in range(levels, -1, -1):
        now = keys.filter(F.col("level") == at)
        zero = F.lit(0).cast("bigint")
        if below is None:
            now = now.withColumn("b_children", F.lit(None).cast("bigint")).withColumn("b_leaves", zero).withColumn("b_saved", zero)
        else:
            now = now.join(below, "next", "left")
        # what nobody else shares goes on as one path to one leaf
        goes = F.col("next").isNotNull()
        now = now.select(
            "state", "ids", "sizes", "n", "least", "ends", F.coalesce("b_children", F.when(goes, 1).otherwise(0)).cast("bigint").alias("children"),
            F.coalesce("b_leaves", zero).alias("b_leaves"), goes.alias("goes"), F.coalesce("b_saved", zero).alias("saved"))
        now = now.withColumn("leaves", F.when(F.col("goes") & (F.col("b_leaves") == 0), 1).otherwise(F.col("b_leaves")).cast("bigint")).drop("goes", "b_leaves")
        ranged = now.repartitionByRange("state", "ids").sortWithinPartitions("state", "ids")
        lines = cut_lineage(ranged.mapInArrow(_tries(chunk_bytes), _LINES))
        nodes, roots = _merged(lines, uppers)
        base = at * piece
        kept = nodes if at == 0 else nodes.filter("depth > 0")
        parts.append(kept.withColumn("depth", F.col("depth") + base))
        below = roots
    if alone is not None:
        first = F.col("level") * piece
        met = alone.join(uppers, "state", "left").withColumn("first", first).withColumn("upper", F.coalesce("upper", "conv"))
        lonely = met.select("conv", "length", "first", "upper", F.explode(F.sequence(first + 1, F.least(F.col("length"), first + piece))).alias("depth"))
        last = F.col("depth") == F.col("length")
        parts.append(lonely.select(
            F.col("conv").alias("conv_id"), "depth", F.when(F.col("depth") == F.col("first") + 1, F.col("upper")).otherwise(F.col("conv")).alias("parent_conv_id"), F.lit(1).cast("bigint").alias("n_convs"),
            F.when(last, 0).otherwise(1).cast("bigint").alias("n_children"), F.lit(1).cast("bigint").alias("n_leaves"), F.lit(0).cast("bigint").alias("saved_tokens"),
            F.when(last, F.sha2(F.col("conv").cast("string").cast("binary"), 256)).otherwise(_NO_ENDS).alias("ends_sha256")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _merged(lines: DataFrame, uppers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Final nodes of a level, and ``next, b_children, b_leaves, b_saved`` of the nodes where its keys start."""
    named = lines.filter("open").withColumn("name", F.element_at("ways", -1))
    own = named.groupBy("name").agg(
        F.max("depth").alias("depth"), F.min("least").alias("least"), F.sum("n").alias("n"), F.sum("children").alias("children"), F.sum("leaves").alias("leaves"),
        F.sum("saved").alias("saved"), F.max("ends").alias("ends"), F.max("size").alias("size"), F.first("ways").alias("ways"), F.first("parent").alias("parent"))
    own = cut_lineage(own)
    inner = own.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("open_children"))
    full = own.join(inner, "name", "left").withColumn("children", F.col("children") + F.coalesce("open_children", F.lit(0)))
    # what a node brings by itself goes to every open node on its way
    brings = full.select(F.explode("ways").alias("name"), F.when(F.col("children") == 0, 1).otherwise(F.col("leaves")).alias("leaves"),
                         (F.col("saved") + (F.col("n") - 1) * F.col("size")).alias("saved"))
    sums = brings.groupBy("name").agg(F.sum("leaves").alias("all_leaves"), F.sum("saved").alias("all_saved"))
    known = cut_lineage(full.join(sums, "name"))
    parents = known.join(uppers, F.col("name") == F.col("state"), "left").select(F.col("name").alias("_p"), F.coalesce("upper", "least").alias("_pl"))
    opened = known.join(parents, F.col("parent") == F.col("_p"), "left").select(
        F.col("least").alias("conv_id"), "depth", F.col("_pl").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("all_leaves").alias("n_leaves"), F.col("all_saved").alias("saved_tokens"), "ends")
    # an open parent may have very many closed children
    closed = lines.filter("NOT open").select("depth", "least", "n", "children", "leaves", "saved", "ends", "parent_least", F.coalesce("parent", F.lit(b"")).alias("_p"))
    weights = closed.filter("_p <> X''").groupBy("_p").agg(F.count(F.lit(1)).alias("_w"))
    facts = weights.join(parents, "_p", "left").unionByName(closed.sparkSession.createDataFrame([(b"", 1 << 60, None)], "_p binary, _w bigint, _pl bigint"))
    met = salted_lookup(closed, facts, "_p", "_w")
    shut = met.select(
        F.col("least").alias("conv_id"), "depth", F.coalesce("parent_least", "_pl").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends")
    nodes = opened.unionByName(shut).withColumn("ends_sha256", F.coalesce("ends", F.lit(_NO_ENDS))).drop("ends")
    roots = known.filter("depth = 0").select(F.col("name").alias("next"), F.col("children").alias("b_children"), F.col("all_leaves").alias("b_leaves"), F.col("all_saved").alias("b_saved"))
    return nodes, roots
