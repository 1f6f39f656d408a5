"""How far the sources of a language are apart in their words."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.plans.positions import salted_lookup
from chatloom.session import cut_lineage

#: Letters of A-Z in lower case and every byte of other alphabets: on UTF-8 bytes the same runs as on code points.
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_FLUSH = 600_000
_CHUNK = 512


def term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, text, held`` (source and copies of it there) to ``lang, source, term, n, docs``: each text is cut into terms once."""
    counts: dict[tuple[str, str], Counter] = {}
    docs: dict[tuple[str, str], Counter] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), held in counts.items():
            terms = list(held)
            seen = docs[lang, source]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array([t.decode() for t in terms], pa.string()),
                 pa.array(list(held.values()), pa.int64()), pa.array([seen[t] for t in terms], pa.int64())], names=["lang", "source", "term", "n", "docs"])
        counts.clear()
        docs.clear()

    size = 0
    for batch in batches:
        for lang, text, held in zip(batch["lang"].to_pylist(), batch["text"], batch["held"].to_pylist()):
            own = Counter(_TERM.findall(text.as_py().encode().lower()))
            for place in held:
                key, copies = (lang, place["source"]), place["copies"]
                total, seen = counts.setdefault(key, Counter()), docs.setdefault(key, Counter())
                before = len(total)
                if copies == 1:
                    total.update(own)
                    seen.update(own.keys())
                else:
                    total.update({t: n * copies for t, n in own.items()})
                    seen.update(dict.fromkeys(own, copies))
                size += len(total) - before
            if size >= _FLUSH:
                yield from flush()
                size = 0
    yield from flush()


def _share(n: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(10^9 (n + 5) / (total + 5 terms))`` in exact decimals."""
    wide = "decimal(20,0)"
    scaled = F.lit(1_000_000_000).cast("decimal(10,0)") * (n + 5).cast(wide)
    return F.call_function("div", scaled, (total + 5 * terms).cast(wide)) + 1


def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of absolute differences of two blocks of sources, for rows sorted by block pair, slice and term.

    The rows of a block pair begin with one row per source (no term), which holds its share ``p`` of a term it lacks.
    Only terms that a source of the pair has are looked at; all others differ by the difference of these shares.
    """
    names: dict[int, tuple[str, int]] = {}
    left: list[int] = []
    right: list[int] = []
    place: dict[int, int] = {}
    total = base = empty = None
    key = None
    terms = 0
    rows: list[tuple[int, int, int]] = []
    n_rows, last = -1, None

    def start() -> None:
        nonlocal left, right, place, base, total, empty
        low, high = key[1], key[2]
        left = [i for i in names if names[i][2] == low]
        right = [i for i in names if names[i][2] == high]
        everyone = list(names)
        place = {i: at for at, i in enumerate(everyone)}
        empty = np.array([names[i][1] for i in everyone], np.int64)
        left, right = ([place[i] for i in side] for side in (left, right))
        base = np.abs(empty[left][:, None] - empty[right][None, :])
        total = np.zeros_like(base)

    def add() -> None:
        nonlocal rows, n_rows, last
        if not rows:
            return
        shares = np.repeat(empty[None, :], n_rows + 1, 0)
        at, who, p = np.array(rows, np.int64).T
        shares[at, who] = p
        other = shares[:, right]
        for i, s in enumerate(left):
            total[i] += np.abs(shares[:, s, None] - other).sum(0) - base[i] * len(shares)
        rows, n_rows, last = [], -1, None

    def close() -> Iterator[pa.RecordBatch]:
        if key is None:
            return
        if total is None:
            start()
        add()
        value = total + base * terms if key[3] == 0 else total
        everyone = list(names)
        a, b = np.nonzero((value != 0) | (key[3] == 0))
        same = key[1] == key[2]
        pick = [(everyone[left[i]], everyone[right[j]], int(value[i, j])) for i, j in zip(a.tolist(), b.tolist()) if not same or left[i] < right[j]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0]] * len(pick), pa.string()), pa.array([names[i][0] for i, _, _ in pick], pa.string()),
             pa.array([names[j][0] for _, j, _ in pick], pa.string()), pa.array([v for *_, v in pick], pa.int64())], names=["lang", "a", "b", "value"])

    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("lang", "low", "high", "slice", "term", "source", "at", "block", "p", "terms")]
        for lang, low, high, piece, term, source, at, block, p, n_terms in zip(*columns):
            if (lang, low, high, piece) != key:
                yield from close()
                key, names, total = (lang, low, high, piece), {}, None
            if term is None:
                names[at] = (source, p, block)
                terms = n_terms
                continue
            if total is None:
                start()
            if term != last:
                if n_rows + 1 >= _CHUNK:
                    add()
                n_rows, last = n_rows + 1, term
            rows.append((n_rows, place[at], p))
    yield from close()


def source_divergence(docs: DataFrame, min_docs: int = 30, top: int = 50, block: int = 256, slices: int = 32) -> DataFrame:
    """Distances between the sources of a language and each source's typical terms: ``lang, source, part, item, value, rank``.

    1. Identical texts of a language are collapsed to one with its number of copies per source; copies are counted inside the map tasks, so a text that a third
       of all rows have arrives as one line per task. Each text is cut into terms once and weighs as often as it occurs.
    2. A language keeps the terms that at least ``min_docs`` of its documents have. A source's share of a term is ``1 + floor(10^9 (count + 5) / (N + 5 V))``.
    3. Part ``pair``: the sum of absolute differences over all kept terms. Terms that neither source has need no line: they differ by one and
       the same amount. Sources meet in blocks of ``block`` and in ``slices`` of the terms; a task adds the terms up in a matrix of one block pair and
       no pair of lines leaves it. Part ``term``: the ``top`` terms whose share exceeds that of the whole language.

    Null text, lang and source are ''. Blank texts count as documents without terms; a group without terms has the shares of an empty one. Ties go by the
    bytes of the item. Repeated rows count as often as they occur. An empty table gives an empty result; other columns are ignored.
    """
    def given(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)

    rows = docs.select(given("lang"), given("source"), given("text")).withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    copies = cut_lineage(rows.groupBy("lang", "digest", "source").agg(F.count(F.lit(1)).alias("copies")))
    held = copies.groupBy("lang", "digest").agg(F.collect_list(F.struct("source", "copies")).alias("held"))
    texts = rows.groupBy("lang", "digest").agg(F.any_value("text").alias("text"))
    single = texts.join(held, ["lang", "digest"]).select("lang", "text", "held")
    # tasks have added up their own counts; dealt and sorted by term once, all further sums need no shuffle, and only kept terms get a list of their sources
    lines = single.mapInArrow(term_counts, "lang string, source string, term string, n bigint, docs bigint").repartition("lang", "term")
    often = lines.withColumn("all_docs", F.sum("docs").over(Window.partitionBy("lang", "term"))).filter(F.col("all_docs") >= min_docs)
    # one line per term of a language; its list is as long as the language has sources
    kept = cut_lineage(often.groupBy("lang", "term", "source").agg(F.sum("n").alias("n")).groupBy("lang", "term").agg(
        F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("held")))

    per_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("all_n"))
    found = kept.select("lang", "term", "total", F.explode("held").alias("h")).select(F.struct("lang", F.col("h.source").alias("source")).alias("group"), "term", "total", F.col("h.n").alias("n"))
    per_group = found.groupBy("group").agg(F.sum("n").alias("group_n"), F.count(F.lit(1)).alias("n_lines"))
    groups = copies.select("lang", "source").distinct().withColumn("group", F.struct("lang", "source"))
    numbered = groups.withColumn("at", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("int"))
    facts = numbered.join(per_group, "group", "left").join(per_lang, "lang", "left").fillna(0, ["group_n", "n_lines", "terms", "all_n"])
    none = F.lit(0)
    facts = cut_lineage(facts.withColumn("block", F.floor(F.col("at") / block).cast("int")).withColumn(
        "empty", F.when(F.col("terms") > 0, _share(none, F.col("group_n"), F.col("terms"))).otherwise(F.lit(0).cast("bigint"))))

    known = facts.select("group", "at", "block", "group_n", "n_lines", "terms", "all_n")
    shared = cut_lineage(salted_lookup(found, known, "group", "n_lines").select(
        "group.lang", "group.source", "term", "at", "block", _share(F.col("n"), F.col("group_n"), F.col("terms")).alias("p"),
        _share(F.col("total"), F.col("all_n"), F.col("terms")).alias("q")))

    typical = shared.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    typical = typical.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)

    # every block meets every block from itself on: one copy of a line per block of the language
    widest = facts.agg(F.max("block")).first()[0] or 0
    blocks = facts.groupBy("lang").agg(F.max("block").alias("last"))
    lined = shared.select("lang", "source", "term", "at", "block", "p", F.lit(0).cast("bigint").alias("terms"), F.pmod(F.xxhash64("term"), F.lit(slices)).cast("int").alias("slice"))
    heads = facts.select("lang", "source", F.lit(None).cast("string").alias("term"), "at", "block", F.col("empty").alias("p"), "terms",
                         F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))
    both = lined.unionByName(heads)
    if widest:
        both = both.join(F.broadcast(blocks) if blocks.count() <= 10_000 else blocks, "lang")
        other = F.explode(F.sequence(F.lit(0), F.col("last")))
        both = both.withColumn("other", other)
    else:
        both = both.withColumn("other", F.lit(0))
    met = both.select("lang", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "slice", "term", "source", "at", "block", "p", "terms")
    order = ["lang", "low", "high", "slice"]
    sums = met.repartition(*order).sortWithinPartitions(*order, "term", "at").mapInArrow(_distances, "lang string, a string, b string, value bigint")
    pairs = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    sides = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    apart = pairs.select("lang", "value", sides.alias("s")).select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value")
    apart = apart.withColumn("rank", F.row_number().over(best))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return apart.select(*columns).unionAll(typical.select(*columns))
