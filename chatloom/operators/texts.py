"""Text-level evaluation.

Three token-F1 definitions exist side by side and disagree on purpose: multiset counts,
set overlap over list lengths, and the pure set formula. All of them are computed inside
the row: no explode, no shuffle until the final averages. Bags of words and n-grams are counted
by NumPy on Arrow batches.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions.text import ascii_words, clean_text, clean_words, f1, plain_text, set_overlap, strip


def exact_match(prediction: Column, reference: Column) -> Column:
    """1 when the cleaned texts are equal, else 0."""
    return (clean_text(prediction) == clean_text(reference)).cast("int")


def _scored(df: DataFrame, overlap: Column, p_len: Column, r_len: Column, both_empty: Column, one_empty: Column) -> DataFrame:
    """Precision, recall and F1 from an overlap, with 1/1/1 and 0/0/0 for empty sides."""
    counted = df.withColumn("_o", overlap.cast("double"))
    ratio = counted.withColumn("precision", F.when(both_empty, 1.0).when(one_empty, 0.0).otherwise(F.try_divide("_o", p_len)))
    ratio = ratio.withColumn("recall", F.when(both_empty, 1.0).when(one_empty, 0.0).otherwise(F.try_divide("_o", r_len)))
    return ratio.withColumn("f1_score", f1(F.col("precision"), F.col("recall"))).drop("_o")


def _pair(df: DataFrame, prediction: str, reference: str, tokens) -> tuple[DataFrame, Column, Column]:
    both = df.withColumn("_p", tokens(F.col(prediction))).withColumn("_r", tokens(F.col(reference)))
    none = (F.size("_p") == 0) & (F.size("_r") == 0)
    some = (F.size("_p") == 0) | (F.size("_r") == 0)
    return both, none, some


def overlaps(p: str, r: str, max_n: int) -> list[int]:
    """Words of two texts, whether they are the same in the same order, then the size of the multiset intersection of their n-grams for n from 1 to ``max_n``.

    Words get numbers, and an n-gram the number of the (n-1)-gram and the word it is made of, counted anew for each n. So it is exact, and linear in the words.
    """
    left, right = p.split(), r.split()
    words = left + right
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    both = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
    a, b = both[: len(left)], both[len(left):]
    x, y, kinds, out = a, b, len(ids), [len(left), len(right), int(left == right)]
    for n in range(1, max_n + 1):
        if n > 1:
            code, seen = pd.factorize(np.concatenate([x[:-1] * len(ids) + a[n - 1:], y[:-1] * len(ids) + b[n - 1:]]))
            place = len(x[:-1])
            x, y, kinds = code[:place], code[place:], len(seen)
        out.append(int(np.minimum(np.bincount(x, minlength=kinds), np.bincount(y, minlength=kinds)).sum()))
    return out


def _with_overlaps(df: DataFrame, prediction: str, reference: str, max_n: int = 1) -> DataFrame:
    """Add ``_m``, the :func:`overlaps` of the cleaned texts; ``str.split`` knows the same white space as :func:`chatloom.functions.text.squeeze`."""
    @F.pandas_udf("array<bigint>")
    def counted(p: pd.Series, r: pd.Series) -> pd.Series:
        return pd.Series([overlaps(a, b, max_n) for a, b in zip(p, r)], dtype=object)

    return df.withColumn("_m", counted(plain_text(F.col(prediction)), plain_text(F.col(reference))))


def _token_prf(both: DataFrame) -> DataFrame:
    n_p, n_r = F.col("_m")[0], F.col("_m")[1]
    return _scored(both, F.col("_m")[3], n_p, n_r, (n_p == 0) & (n_r == 0), (n_p == 0) | (n_r == 0))


def token_prf(df: DataFrame, prediction: str = "prediction", reference: str = "reference") -> DataFrame:
    """Multiset token precision / recall / F1 on cleaned text."""
    return _token_prf(_with_overlaps(df, prediction, reference)).drop("_m")


def token_f1_set(df: DataFrame, prediction: str = "prediction", reference: str = "reference") -> DataFrame:
    """Set overlap over *list* lengths; the tokenizer keeps only ASCII letters and digits."""
    both, none, some = _pair(df, prediction, reference, ascii_words)
    return _scored(both, set_overlap(F.col("_p"), F.col("_r")), F.size("_p"), F.size("_r"), none, some).drop("_p", "_r")


def token_prf_formal(df: DataFrame, prediction: str = "prediction", reference: str = "reference") -> DataFrame:
    """Pure set formula on cleaned text."""
    both, none, some = _pair(df, prediction, reference, lambda c: F.array_distinct(clean_words(c)))
    return _scored(both, set_overlap(F.col("_p"), F.col("_r")), F.size("_p"), F.size("_r"), none, some).drop("_p", "_r")


def extraction_cases(df: DataFrame, prediction: str = "prediction", reference: str = "reference") -> DataFrame:
    """Cases with a nested ``metrics`` struct rounded to 4 places; raw values stay beside it."""
    both = _token_prf(_with_overlaps(df, prediction, reference))
    scored = both.withColumn("exact_match", F.col("_m")[2].cast("int")).drop("_m")
    metrics = F.struct(
        "exact_match", F.round("precision", 4).alias("precision"), F.round("recall", 4).alias("recall"),
        F.round("f1_score", 4).alias("f1_score"),
    )
    return scored.withColumn("metrics", metrics)


def extraction_report(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Macro means of the unrounded case metrics, rounded at the end; no rows give nulls."""
    return extraction_cases(df).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_cases"),
        F.round(F.avg("exact_match"), 4).alias("macro_exact_match"),
        F.round(F.avg("precision"), 4).alias("macro_precision"),
        F.round(F.avg("recall"), 4).alias("macro_recall"),
        F.round(F.avg("f1_score"), 4).alias("macro_f1_score"),
    )


def final_answer(output: Column) -> Column:
    """What follows the last-line marker ``####``; null when the marker is missing."""
    found = F.regexp_extract(output, r"####[ \t]*([^\n]*)", 1)
    return F.when(F.contains(output, F.lit("####")), strip(found))


def final_answer_match(df: DataFrame, output: str = "output", gold: str = "gold") -> DataFrame:
    """Strict mode compares strings, lenient mode compares numbers with commas removed."""
    parsed = df.withColumn("answer", final_answer(F.col(output)))

    def number(c: str) -> Column:
        return F.regexp_replace(c, ",", "").try_cast("double")

    return parsed.withColumn("strict_ok", F.coalesce(F.col("answer") == F.col(gold), F.lit(False))).withColumn(
        "lenient_ok", F.coalesce(number("answer") == number(gold), F.lit(False))
    )


def extract_option(output: Column) -> Column:
    """A-D from a bare letter (with optional bracket or full stop) or from "answer is X"; else null."""
    bare = F.regexp_extract(strip(output), r"^\(?([A-Da-d])\)?\.?$", 1)
    said = F.regexp_extract(output, r"(?i)answer\s+is:?\s*\(?([A-D])\b", 1)
    return F.upper(F.coalesce(F.nullif(bare, F.lit("")), F.nullif(said, F.lit(""))))


def option_match(df: DataFrame, by: str = "subject", output: str = "output", gold: str = "gold") -> DataFrame:
    """Exact match on the option letter: accuracy per subject, plus the macro mean row (null subject)."""
    hit = F.coalesce(extract_option(F.col(output)) == F.col(gold), F.lit(False)).cast("int")
    per_subject = df.select(by, hit.alias("_hit")).groupBy(by).agg(F.count(F.lit(1)).alias("_n"), F.avg("_hit").alias("_acc"))
    # rolling up the per-subject means makes the total line their macro mean
    return per_subject.rollup(by).agg(F.sum("_n").alias("n_items"), F.round(F.avg("_acc"), 4).alias("accuracy"))


def option_bias(df: DataFrame, output: str = "output", gold: str = "gold") -> DataFrame:
    """Share of each letter among answers against its share among golds."""
    letters = df.select(F.explode(F.array(
        F.struct(extract_option(F.col(output)).alias("letter"), F.lit(1).alias("said"), F.lit(0).alias("right")),
        F.struct(F.col(gold).alias("letter"), F.lit(0).alias("said"), F.lit(1).alias("right")),
    )).alias("v")).select("v.*").filter("letter IS NOT NULL")
    counts = letters.groupBy("letter").agg(F.sum("said").alias("predicted"), F.sum("right").alias("gold"))
    # one line per letter, so the grand total is a window over a handful of rows
    everything = Window.partitionBy(F.lit(0))
    shares = counts.withColumn("_p", F.sum("predicted").over(everything)).withColumn("_g", F.sum("gold").over(everything))
    said, right = F.try_divide("predicted", "_p"), F.try_divide("gold", "_g")
    return shares.select(
        "letter", "predicted", "gold", F.round(said, 4).alias("predicted_share"),
        F.round(right, 4).alias("gold_share"), F.round(said - right, 4).alias("bias"),
    )


def chosen_content(letter: str, turned: str, n_options: int) -> Column:
    """Number of the option, in the item's own order, that a letter names when the options are turned by some places."""
    place = F.ascii(letter) - F.lit(ord("A"))
    return F.when((place >= 0) & (place < n_options), F.pmod(place + F.col(turned), F.lit(n_options)))


def permutation_consistency(df: DataFrame, item: str, content: str) -> DataFrame:
    """Per item over option permutations: did the chosen content stay the same?"""
    return df.groupBy(item).agg(
        F.count(F.lit(1)).alias("n_orders"),
        (F.coalesce(F.min(content) == F.max(content), F.lit(False)) & (F.count(content) == F.count(F.lit(1)))).alias("consistent"),
    )


def rouge_n(df: DataFrame, n: int = 2, prediction: str = "prediction", reference: str = "reference") -> DataFrame:
    """Clipped n-gram overlap precision / recall / F1 on cleaned text; a side without n-grams scores 0."""
    both = _with_overlaps(df, prediction, reference, n)
    n_p, n_r = (F.greatest(F.col("_m")[side] - (n - 1), F.lit(0)) for side in (0, 1))
    return _scored(both, F.col("_m")[n + 2], n_p, n_r, F.lit(False), (n_p == 0) | (n_r == 0)).drop("_m")


def corpus_bleu(df: DataFrame, prediction: str = "prediction", reference: str = "reference", max_n: int = 4) -> DataFrame:
    """Corpus BLEU: clipped n-gram sums over all rows, geometric mean, brevity penalty.

    Each row contributes four small integers, so the only exchange carries partial sums.
    """
    both = _with_overlaps(df.select(prediction, reference), prediction, reference, max_n).select("_m")
    sums = [F.sum(F.col("_m")[0]).alias("p_len"), F.sum(F.col("_m")[1]).alias("r_len")]
    for n in range(1, max_n + 1):
        sums.append(F.sum(F.col("_m")[n + 2]).alias(f"match_{n}"))
        sums.append(F.sum(F.greatest(F.col("_m")[0] - (n - 1), F.lit(0))).alias(f"total_{n}"))
    totals = both.agg(*sums)
    logs = sum((F.log(F.try_divide(F.col(f"match_{n}"), F.col(f"total_{n}"))) for n in range(1, max_n + 1)), F.lit(0.0))
    any_zero = F.least(*[F.col(f"match_{n}") for n in range(1, max_n + 1)]) == 0
    brevity = F.when(F.col("p_len") > F.col("r_len"), 1.0).otherwise(F.exp(1 - F.try_divide(F.col("r_len"), F.col("p_len"))))
    bleu = F.when(any_zero, 0.0).otherwise(brevity * F.exp(logs / max_n))
    precisions = [F.round(F.try_divide(f"match_{n}", f"total_{n}"), 4).alias(f"p{n}") for n in range(1, max_n + 1)]
    return totals.select("p_len", "r_len", *precisions, F.round(brevity, 4).alias("brevity"), F.round(bleu, 4).alias("bleu"))
