"""Quality rules with risk-controlled cutoffs."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.session import cut_lineage

SYMBOLS = "#*$%&|<>"

STATISTICS = "doc_id bigint, stratum string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_lines bigint, n_upper_words bigint"


@dataclass(frozen=True)
class Rule:
    """A document fails when ``expression`` exceeds the cutoff that was selected for its stratum."""

    name: str
    expression: str
    step: float
    steps: int


#: Rates between 0 and 1, looked at from loose to tight. The grid is fixed before any label is seen.
RULES = (
    Rule("symbols", "n_symbols / greatest(n_words, 1)", 0.05, 40),
    Rule("repeats", "n_repeat_words / greatest(n_words, 1)", 0.02, 50),
    Rule("duplicate_lines", "n_dup_lines / greatest(n_lines, 1)", 0.02, 50),
    Rule("capitals", "n_upper_words / greatest(n_words, 1)", 0.02, 50),
)


def repeated_words(words: list[bytes]) -> int:
    """Number of words inside a three-word window that the text holds at least twice."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    size = len(known)
    pair = ids[:-2] * size + ids[1:-1]
    if size < 1 << 20:
        windows = pair * size + ids[2:]
    else:
        windows = np.unique(pair, return_inverse=True)[1] * size + ids[2:]
    _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
    starts = counts[which] >= 2
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift:n - 2 + shift] |= starts
    return int(covered.sum())


def text_statistics(text: bytes) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper_words of a UTF-8 text."""
    words = text.split()
    chars = len(text.decode("utf-8", "replace")) - sum(text.count(c) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
    lines = [x for x in text.split(b"\n") if x.strip()]
    capitals = sum(len(w) > 1 and w.isupper() for w in words) if text.upper() != text.lower() else 0
    return (
        len(words), chars, sum(text.count(c.encode()) for c in SYMBOLS), len(lines) - len(set(lines)), repeated_words(words), len(lines), capitals)


def measure(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """:data:`STATISTICS` of every whole text, one line per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(zip(*map(text_statistics, batch["text"].to_pylist()))) or [()] * 7
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["stratum"], *[pa.array(c, pa.int64()) for c in columns]], names=names)

    text = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), text)
    names = [x.split()[0] for x in STATISTICS.split(", ")]
    return rows.mapInArrow(run, STATISTICS)


def _log_beta_part(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1 - _log_beta_part(1 - x, b, a)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    c, d, tiny = 1.0, 1 - (a + b) * x / (a + 1), 1e-300
    d = 1 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 100_000):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + top * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + top / c
            c = c if abs(c) > tiny else tiny
            h *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return front * h


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial with n draws of probability p, exactly."""
    return 1.0 if k >= n else _log_beta_part(1 - p, n - k, k + 1)


def tightening(rules: tuple[Rule, ...] = RULES) -> list[tuple[int, ...]]:
    """The settings (grid step of each rule) that a walk tests, from all loosest to all tightest; one step of one rule at a time.

    By turns each rule goes down to a half, a quarter, an eighth ... of its grid, so that none has to wait until another is tightest.
    """
    at = [r.steps - 1 for r in rules]
    path = [tuple(at)]
    for half in range(1, 1 + max(r.steps for r in rules).bit_length()):
        for i, r in enumerate(rules):
            while at[i] > r.steps >> half:
                at[i] -= 1
                path.append(tuple(at))
    return path


def labels_needed(walks: int, alpha: float = 0.02, delta: float = 0.05) -> int:
    """Good documents that a walk needs before it can prove anything: none of them fails, and still (1 - alpha)^n must fall to its share of delta."""
    return math.ceil(math.log(delta / max(1, walks)) / math.log1p(-alpha))


def controlled_cutoffs(stats: DataFrame, good: DataFrame, rules: tuple[Rule, ...] = RULES, alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """``stratum, rule, cutoff, n, rejected, bound_p``: the tightest setting whose false rejection is proven to stay within ``alpha``.

    ``stats`` has a line per document, ``good`` the ids (``doc_id``) of labelled good documents; each good id counts once.
    For each stratum the hypotheses "more than alpha of the good documents fail some rule of this setting" are tested along
    :func:`tightening` and the walk ends at the first that is not rejected, so a walk needs no correction of its own and the rules none for
    one another; ``delta`` is divided by the number of strata. A test is the exact binomial one. With probability 1 - delta no stratum
    loses more than alpha of its good documents to all rules together. Strata with fewer than :func:`labels_needed` get no cutoff.
    ``rejected`` and ``bound_p`` are of the setting as a whole. Holdouts enter as counts per stratum and step of the walk, so the work after the
    count does not depend on their number.
    """
    labelled = stats.join(good.select("doc_id").distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    path = tightening(rules)

    def first_failed(i: int, rule: Rule) -> Column:
        """The step of the walk from which a document fails the rule, by the number of grid cutoffs that its value exceeds."""
        steps = [next((t for t, at in enumerate(path) if at[i] < level), len(path)) for level in range(rule.steps + 1)]
        level = F.least(F.lit(rule.steps), F.greatest(F.lit(0), F.ceil(F.expr(rule.expression) / rule.step))).cast("int")
        return F.element_at(F.array(*map(F.lit, steps)), level + 1)

    failed = [first_failed(i, r) for i, r in enumerate(rules)]
    counts = labelled.select("stratum", F.array_min(F.array(*failed)).alias("step")).groupBy("stratum", "step").agg(F.count(F.lit(1)).alias("n"))
    strata = counts.select("stratum").distinct().count()
    limit = delta / max(1, strata)

    def walk(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        by = np.bincount(frame["step"], weights=frame["n"], minlength=len(path) + 1).astype(np.int64)
        n, best = int(by.sum()), []
        for at, gone in zip(path, np.cumsum(by).tolist()):
            p = binomial_tail(gone, n, alpha)
            if p > limit:
                break
            best = [(key[0], r.name, r.step * i, n, gone, p) for r, i in zip(rules, at)]
        return pd.DataFrame(best, columns=["stratum", "rule", "cutoff", "n", "rejected", "bound_p"])

    return counts.groupBy("stratum").applyInPandas(walk, "stratum string, rule string, cutoff double, n bigint, rejected bigint, bound_p double")


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", rules: tuple[Rule, ...] = RULES, alpha: float = 0.02,
                  delta: float = 0.05, min_words: int = 50, max_repeat_percent: int = 50) -> DataFrame:
    """Statistics and verdict of every document, one line per row.

    Columns: the statistics, ``base_failed``, ``failed_rules`` (names) and ``kept``. A document fails the base with fewer than
    ``min_words`` words or more than ``max_repeat_percent`` of them in repeated windows. It fails a rule when it
    exceeds the cutoff that :func:`controlled_cutoffs` selected for its stratum with half of ``delta``. A stratum with too few labels
    for that takes the cutoffs selected with the other half on all strata as one, whose bound holds for the good documents of all strata
    together and not for each stratum. The holdout is every labelled document of quality 1 that passes the base. Null texts have no words; a null stratum is one of its own; repeated rows get equal lines; rows
    with a null id are judged but never serve as labels. An empty table gives an empty result, and without labels only the base holds.
    """
    stats = cut_lineage(measure(docs, stratum).withColumn(
        "base_failed", F.expr(f"n_words < {min_words} or 100 * n_repeat_words > {max_repeat_percent} * n_words")))
    good = labels.filter("quality = 1").select(F.col("doc_id").cast("bigint"))
    passed = stats.filter("not base_failed")
    own = controlled_cutoffs(passed, good, rules, alpha, delta / 2)
    pooled = controlled_cutoffs(passed.withColumn("stratum", F.lit("")), good, rules, alpha, delta / 2)
    labelled = cut_lineage(passed.join(good.distinct(), "doc_id", "left_semi").groupBy("stratum").agg(F.count_distinct("doc_id").alias("n")))
    least = labels_needed(labelled.count(), alpha, delta / 2)
    poor = stats.select("stratum").distinct().join(labelled.filter(F.col("n") >= least), "stratum", "left_anti")
    cutoffs = own.select("stratum", "rule", "cutoff")
    lent = [F.struct(F.lit(r["rule"]).alias("rule"), F.lit(r["cutoff"]).alias("cutoff")) for r in pooled.collect()]  # one line per rule
    if lent:
        cutoffs = cutoffs.unionByName(poor.select("stratum", F.explode(F.array(*lent)).alias("x")).select("stratum", "x.rule", "x.cutoff"))
    by_stratum = cut_lineage(cutoffs.groupBy(F.col("stratum").alias("_stratum")).agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("_cut")))
    judged = stats.join(by_stratum, F.col("stratum") == F.col("_stratum"), "left")
    failed = F.array_compact(F.array(*[F.when(F.expr(r.expression) > F.col("_cut")[r.name], F.lit(r.name)) for r in rules]))
    out = judged.withColumn("failed_rules", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop("_stratum", "_cut")
