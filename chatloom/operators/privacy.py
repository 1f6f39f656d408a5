"""Personal data and benchmark contamination."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.text import clean_words, gram_hash, let, word_hashes
from chatloom.operators.prepare import build_messages
from chatloom.operators.synthesis import wrap_task
from chatloom.plans.positions import broadcast_if_small
from chatloom.session import cut_lineage

# Most specific first: a card number also looks like a run of phone digits.
PII_PATTERNS = [
    ("EMAIL", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    ("SSN", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"),
    ("CARD", r"\b[0-9](?:[ -]?[0-9]){12,18}\b"),
    ("PHONE", r"(?:\+[0-9]{1,3}[ -]?)?(?:\([0-9]{2,4}\)[ -]?|\b[0-9]{2,4}[ .-])[0-9]{3}[ .-]?[0-9]{4}\b"),
]
# What any match of a pattern holds; texts without it are spared the pattern.
_NAME_WORD = r"[\p{L}\p{N}_]+"
_SIGNS = {"EMAIL": "@", "CARD": "[0-9](?:[ -]?[0-9]){3}"}


def redact(c: Column, names: Sequence[str] = ()) -> Column:
    """Replace personal data by ``[REDACTED_...]`` tags; everything else stays byte-identical.

    Names are only taken from a supplied gazetteer, which enters the plan as one pattern.
    """
    def step(tag: str, pattern: str):
        sign = F.lit(_SIGNS.get(tag, "[0-9]{4}"))
        return lambda x: F.when(F.rlike(x, sign), F.regexp_replace(x, pattern, f"[REDACTED_{tag}]")).otherwise(x)

    out = c
    for tag, pattern in PII_PATTERNS:
        out = let(out, step(tag, pattern))
    if names:
        longest_first = sorted(set(names), key=lambda n: (-len(n), n))
        alone = r"(?<![\p{L}\p{N}_])(?:" + "|".join(re.escape(n) for n in longest_first) + r")(?![\p{L}\p{N}_])"
        out = F.regexp_replace(out, alone, "[REDACTED_NAME]")
    return out


def redact_pii(df: DataFrame, col: str, names: Sequence[str] = ()) -> DataFrame:
    return df.withColumn("redacted", redact(F.col(col), names))


def redact_names(df: DataFrame, id_col: str, col: str, names: DataFrame, name: str) -> DataFrame:
    """Add ``redacted``: the text with every name of a table replaced by a tag, the longest one first where several fit. Ids are unique.

    The table may have any number of names: a text is cut into word n-grams as long as names have words, their hashes are looked up by an equi-join, and only the names
    that a text holds (or, by an equal hash, seems to hold) enter its own pattern. So the cost of a text does not depend on the list. Names stand alone, as in :func:`redact`, and
    match case; a name without letters, digits or underscores is never found. Null texts stay null.
    """
    def cut(c: Column) -> Column:
        return F.regexp_extract_all(c, F.lit(_NAME_WORD), F.lit(0))

    listed = names.select(F.col(name).alias("name")).filter("name IS NOT NULL").distinct().withColumn("w", cut(F.col("name"))).filter(F.size("w") > 0)
    # names of a language have few words, so there are few lengths
    sizes = sorted(r[0] for r in listed.select(F.size("w")).distinct().collect())
    own = F.coalesce(*[F.when(F.size("w") == n, gram_hash(word_hashes(F.col("w")), F.lit(0), n, n)) for n in sizes], F.lit(None).cast("bigint"))
    known = listed.select("name", own.alias("gram"))
    rows = df.select(F.col(id_col).alias("row"), F.col(col).alias("t"))

    def grams(h: Column) -> Column:
        empty = F.array().cast("array<bigint>")
        runs = [F.when(F.size(h) >= n, F.transform(F.sequence(F.lit(0), F.size(h) - n), lambda i: gram_hash(h, i, n, n))).otherwise(empty) for n in sizes] or [empty]
        return F.array_distinct(F.flatten(F.array(*runs)))

    # explode_outer: for a plain explode Spark infers a size filter that would compute all grams again
    cuts = rows.select("row", F.explode_outer(let(word_hashes(cut(F.coalesce("t", F.lit("")))), grams)).alias("gram"))
    hits = cuts.filter("gram IS NOT NULL").join(broadcast_if_small(known), "gram")
    longest = F.expr("array_sort(collect_set(name), (a, b) -> CASE WHEN length(a) <> length(b) THEN length(b) - length(a) WHEN a < b THEN -1 WHEN a > b THEN 1 ELSE 0 END)")
    quoted = F.transform("found", lambda x: F.regexp_replace(x, r"([^\p{L}\p{N}\s])", r"\\$1"))
    alone = F.concat(F.lit(r"(?<![\p{L}\p{N}_])(?:"), F.array_join(quoted, "|"), F.lit(r")(?![\p{L}\p{N}_])"))
    patterns = hits.groupBy("row").agg(longest.alias("found")).select(F.col("row").alias("_row"), alone.alias("_pattern"))
    met = df.join(patterns, F.col(id_col) == F.col("_row"), "left")
    return met.withColumn("redacted", F.when(F.col("_pattern").isNull(), F.col(col)).otherwise(
        F.regexp_replace(F.col(col), F.col("_pattern"), F.lit("[REDACTED_NAME]")))).drop("_row", "_pattern")


def pii_leaks(df: DataFrame, source: str, answer: str, names: Sequence[str] = ()) -> DataFrame:
    """Check redacted answers: personal data left over, and edits beyond the tags."""
    left = [F.size(F.regexp_extract_all(answer, F.lit(p), F.lit(0))).alias(f"{tag.lower()}_left") for tag, p in PII_PATTERNS]
    counted = df.select("*", *left)
    total = sum((F.col(f"{tag.lower()}_left") for tag, _ in PII_PATTERNS), F.lit(0))
    return counted.withColumn("leaks", total > 0).withColumn("altered", ~(redact(F.col(source), names).eqNullSafe(F.col(answer))))


def build_redaction_pairs(conversations: DataFrame, messages: str = "messages", names: Sequence[str] = ()) -> DataFrame:
    """Transcript -> redacted transcript training samples from assembled conversations."""
    transcript = F.array_join(F.transform(messages, lambda m: F.concat_ws(": ", m["role"], m["content"])), "\n")
    texts = conversations.withColumn("transcript", transcript).withColumn("redacted", redact(F.col("transcript"), names))
    return texts.withColumn("sample", build_messages(wrap_task(F.col("transcript"), "redact"), F.col("redacted")))


def contamination(
    train: DataFrame, bench: DataFrame, train_id: str, bench_id: str, text: str = "text", n: int = 8, min_shared: int = 1,
    max_broadcast_rows: int = 200_000,
) -> DataFrame:
    """(training row, evaluation item) pairs that overlap: ``shared`` distinct n-grams and ``verbatim``.

    Both sides are cleaned and cut into word n-grams, known by two 64-bit hashes; a gram that a text repeats is one line. The join is on
    equal n-grams, with the evaluation side broadcast while a count
    proves it small, so of the training side only matches are shuffled, one line per gram, row and item. A row that has all grams of an item
    may hold it whole: only for such pairs both texts are read again and compared (``verbatim``: the item's words stand in a row in this order). An
    item shorter than ``n`` words counts as one gram of its own length.
    """
    cleaned = bench.select(F.col(bench_id).alias("item"), clean_words(F.col(text)).alias("w")).filter(F.size("w") > 0)
    # only items below n words need other gram sizes, so there are at most n sizes
    sizes = sorted({r[0] for r in cleaned.select(F.least(F.size("w"), F.lit(n)).alias("g")).distinct().collect()}) or [n]

    def own_size(h: Column) -> Column:
        return F.coalesce(*[F.when(F.least(F.size(h), F.lit(n)) == g, _grams(h, g)) for g in sizes])

    # let() binds the hashes once: a column named outside would be pasted into every lambda call
    own = let(word_hashes(F.col("w")), own_size)
    cut = cleaned.select("item", own.alias("grams")).withColumn("n_grams", F.size("grams"))
    wanted = cut.select("item", "n_grams", F.explode_outer("grams").alias("g")).filter("g IS NOT NULL").select("item", "n_grams", "g.*")

    def all_sizes(h: Column) -> Column:
        # grams of different sizes are salted apart
        return F.flatten(F.array(*[_grams(h, g) for g in sizes]))

    # explode_outer: for a plain explode Spark infers a size filter that would compute all grams again
    grams = F.explode_outer(let(word_hashes(clean_words(F.col(text))), all_sizes))
    rows = train.select(F.col(train_id).alias("row"), grams.alias("g")).filter("g IS NOT NULL").select("row", "g.*")
    hits = rows.join(broadcast_if_small(wanted, max_broadcast_rows), ["h1", "h2"])
    found = cut_lineage(hits.groupBy("row", "item").agg(F.count(F.lit(1)).alias("shared"), F.max("n_grams").alias("n_grams")))

    def padded(words: Column) -> Column:
        return F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))

    full = found.filter("shared >= n_grams").select("row", "item")
    whole = full.join(cleaned.select("item", padded(F.col("w")).alias("_item")), "item").join(
        train.select(F.col(train_id).alias("row"), padded(clean_words(F.col(text))).alias("_row")), "row")
    copies = whole.filter(F.contains("_row", F.col("_item"))).select("row", "item", F.lit(True).alias("verbatim")).distinct()
    told = found.join(copies, ["row", "item"], "left").select(
        F.col("row").alias(train_id), F.col("item").alias(bench_id), "shared", F.coalesce("verbatim", F.lit(False)).alias("verbatim"))
    return told.filter(F.col("verbatim") | (F.col("shared") >= min_shared))


def _grams(h: Column, g: int) -> Column:
    """Distinct ``h1, h2`` of the g-grams over word hashes, sorted.

    Sorted and compared with the neighbour: Spark's array_distinct compares every struct of an array with all others.
    """
    def one(i: Column) -> Column:
        return F.struct(gram_hash(h, i, g, g).alias("h1"), gram_hash(h, i, g, -g).alias("h2"))

    empty = F.array().cast("array<struct<h1:bigint,h2:bigint>>")
    made = F.when(F.size(h) >= g, F.transform(F.sequence(F.lit(0), F.size(h) - g), one)).otherwise(empty)
    return let(F.sort_array(made), lambda s: F.filter(s, lambda x, i: (i == 0) | (x != F.get(s, i - 1))))


def decontaminate(train: DataFrame, overlaps: DataFrame, train_id: str) -> DataFrame:
    """Training rows without any overlap."""
    return train.join(overlaps.select(train_id).distinct(), train_id, "left_anti")
