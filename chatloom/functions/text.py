"""Text cleaning, tokens and overlap counts as native expressions."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() removes; Spark's trim() alone removes spaces only.
WHITESPACE = "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())
_SPACES = r"(?U)[\s\x1c-\x1f]+"
# Java reads this class as the 32 ASCII marks unless (?U) is set.
_PUNCTUATION = r"\p{Punct}+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``; keeps lambdas from recomputing it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def squeeze(c: Column) -> Column:
    """Collapse whitespace runs to one space and trim."""
    return F.trim(F.regexp_replace(c, _SPACES, " "))


def plain_text(c: Column) -> Column:
    """Lower case, ASCII punctuation deleted. Null counts as empty."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), _PUNCTUATION, "")


def clean_text(c: Column) -> Column:
    """Lower case, ASCII punctuation deleted, whitespace collapsed. Null counts as empty."""
    return squeeze(plain_text(c))


def clean_prediction(c: Column) -> Column:
    """Cut at the first ``<`` (leaked turn markers) and strip; null counts as empty."""
    return strip(F.substring_index(F.coalesce(c, F.lit("")), "<", 1))


def split_words(squeezed: Column) -> Column:
    """Words of an already squeezed text; the empty text has none."""
    return F.when(squeezed == "", F.array().cast("array<string>")).otherwise(F.split(squeezed, " "))


def words(c: Column) -> Column:
    """Whitespace tokens of the raw text."""
    return let(squeeze(F.coalesce(c, F.lit(""))), split_words)


def clean_words(c: Column) -> Column:
    """Tokens after :func:`clean_text`."""
    return let(clean_text(c), split_words)


def ascii_words(c: Column) -> Column:
    """Tokens after deleting everything but ASCII letters, digits and whitespace."""
    kept = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"(?U)[^a-zA-Z0-9\s\x1c-\x1f]", "")
    return let(squeeze(kept), split_words)


def word_hashes(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.xxhash64(t))


def gram_hash(hashes: Column, i: Column, n: int, salt: int = 0) -> Column:
    """64-bit hash of the ``n`` words from position ``i``, made from word hashes without building strings."""
    return F.xxhash64(F.lit(salt), *[F.get(hashes, i + j) for j in range(n)])


def repeats(tokens: Column) -> Column:
    """Every occurrence beyond the first of its token, sorted."""
    return let(F.sort_array(tokens), lambda s: F.filter(s, lambda x, i: (i > 0) & (x == F.get(s, i - 1))))


def numbered(sorted_tokens: Column) -> Column:
    """Distinct tags for a sorted bag: the k-th repeat of a token gets its own tag.

    Finds where each run of equal tokens starts and numbers the members of the run, so it is
    linear in the length of the bag.
    """
    def number_run(s: Column, st: Column, p: Column, j: Column) -> Column:
        length = F.coalesce(F.get(st, j + 1), F.size(s)) - p
        return F.transform(F.sequence(F.lit(1), length), lambda k: F.concat(F.get(s, p), F.lit(" "), k.cast("string")))

    def number_runs(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return let(starts, lambda st: F.flatten(F.transform(st, lambda p, j: number_run(s, st, p, j))))

    return F.when(F.size(sorted_tokens) == 0, F.array().cast("array<string>")).otherwise(number_runs(sorted_tokens))


def bag_overlap(a: Column, b: Column) -> Column:
    """Size of the multiset intersection: sum over tokens of the smaller count.

    Common tokens count once, plus the overlap of the repeats on both sides. That is
    O(n log n) inside the row, so two bags meet without exploding them into a shuffle.
    """
    extra = F.size(F.array_intersect(let(repeats(a), numbered), let(repeats(b), numbered)))
    return set_overlap(a, b) + extra


def set_overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def f1(precision: Column, recall: Column) -> Column:
    """Harmonic mean, 0 when both are 0."""
    return F.when(precision + recall == 0, F.lit(0.0)).otherwise(2 * precision * recall / (precision + recall))
