"""Exact, normalised and near duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.text import clean_text, clean_words, gram_hash, let, word_hashes
from chatloom.plans.candidates import first_candidates, shared_lines, with_sketch
from chatloom.plans.positions import broadcast_if_small, first_by, salted_lookup
from chatloom.session import cut_lineage

_FEW = 2_000_000  # ids, of 8 bytes each, that may go to every executor


def dedup_first(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Exact dedup: the first row in ``order`` wins and keeps its other columns.

    Sorting compares a 64-bit hash first and the text only on a hash tie; losers are dropped
    inside each map task before the shuffle.
    """
    return first_by(df.withColumn("_h", F.xxhash64(key)), ["_h", key], order).drop("_h")


def dedup_normalised(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Same on the cleaned text, so case, punctuation and spacing variants count as repeats."""
    hashed = df.withColumn("_h", F.unhex(F.sha2(clean_text(F.col(key)).cast("binary"), 256)))
    return first_by(hashed, ["_h"], order).drop("_h")


def shingle_set(c: Column, k: int = 3) -> Column:
    """Sorted distinct 64-bit hashes of the word k-grams; a shorter text is one shingle."""
    def grams(h: Column) -> Column:
        several = F.transform(F.sequence(F.lit(0), F.size(h) - k), lambda i: gram_hash(h, i, k))
        return F.when(F.size(h) >= k, several).otherwise(F.array(F.xxhash64(F.lit(-1), h)))

    return F.sort_array(F.array_distinct(let(word_hashes(clean_words(c)), grams)))


def jaccard(a: Column, b: Column) -> Column:
    common = F.size(F.array_intersect(a, b))
    return common / (F.size(a) + F.size(b) - common)


def near_dups(
    df: DataFrame, id_col: str, text: str, threshold: float = 0.7, k: int = 3, width: int = 2, hot: int = 20_000
) -> DataFrame:
    """First-wins rejection of near duplicates: ``id, kept_id, jaccard``.

    Walking the rows in id order, a row is rejected when an earlier *kept* row has a shingle Jaccard
    of at least ``threshold`` with it; this is the exact-dedup rule with "equal" relaxed. A kept row has
    ``kept_id = id``, a rejected one the id of a kept row that rejects it.

    Candidates are exact: with the shingles of every row ordered by how many rows have them, two rows of that Jaccard
    share one of their first ``n - ceil(threshold * n) + 1`` shingles. Inside the group of a shingle each row names its first ``width`` earlier
    rows that size, position and sketch allow (:func:`chatloom.plans.candidates.first_candidates`), and these pairs are verified. A row without any is kept, one
    that resembles a kept row is rejected, one that resembles an undecided row waits for it, and one whose candidates all failed looks again. Unlike rows do not
    pass the sketches, so the rounds follow the chains of like rows and not the size of a group, and no group's pairs become rows.
    Groups above ``hot`` rows are split by size. Rows with identical shingle sets are folded into one beforehand.
    """
    texts = df.select(F.col(id_col).alias("id"), F.col(text).alias("t"))
    sets = texts.select("id", shingle_set(F.col("t"), k).alias("s"))
    identity = F.concat_ws(":", F.xxhash64("s"), F.xxhash64(F.lit(1), "s"), F.size("s"))
    signed = cut_lineage(sets.select("id", identity.alias("key"), "s"))
    distinct = signed.groupBy("key").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"))
    copies = cut_lineage(salted_lookup(signed.select("id", "key"), distinct, "key", "n").select("id", "rep"))
    # the few rows that stand for no set are named, so that sets stay where they are; an id that also stands for one keeps its rows
    others = copies.filter("id <> rep").select("id").distinct().join(distinct.select(F.col("rep").alias("id")), "id", "left_anti")
    rep_sets = signed.filter("id IS NOT NULL").select("id", "s").join(broadcast_if_small(cut_lineage(others), _FEW), "id", "left_anti")
    shared = cut_lineage(shared_lines(_prefixes(rep_sets, threshold), threshold, hot))
    state = cut_lineage(shared.select("id").distinct().withColumn("state", F.lit("looks")))
    bits = cut_lineage(with_sketch(rep_sets, "s").join(state.select("id"), "id", "left_semi"))

    kind = state.schema["id"].dataType.simpleString()
    edges = df.sparkSession.createDataFrame([], f"id {kind}, head {kind}, jaccard double")
    refused = edges.select("id", "head")
    verdicts: list[DataFrame] = []
    lines = shared
    while not state.filter("state <> 'kept'").isEmpty():
        failed = refused.groupBy("id").agg(F.collect_set("head").alias("failed"))
        facts = bits.join(state, "id").join(failed, "id", "left").withColumn("looks", F.col("state") == "looks").drop("state")
        pairs = cut_lineage(first_candidates(lines.join(facts, "id"), threshold, width).select("id", "head").distinct())
        checked = cut_lineage(_with_jaccard(pairs, rep_sets))
        alone = state.filter("state = 'looks'").join(pairs, "id", "left_anti").select("id")
        kept = state.filter("state = 'kept'").select("id").unionByName(alone)
        like = cut_lineage(edges.unionByName(checked.filter(F.col("jaccard") >= threshold)))
        told = like.join(kept.select(F.col("id").alias("head")), "head", "left_semi")
        rejected = told.groupBy("id").agg(F.min(F.struct("head", "jaccard")).alias("m"))
        verdicts.append(cut_lineage(rejected.select("id", F.col("m.head").alias("kept_id"), F.col("m.jaccard").alias("jaccard"))))
        gone = verdicts[-1].select("id")
        refused = cut_lineage(refused.unionByName(checked.filter(F.col("jaccard") < threshold).select("id", "head")).join(gone, "id", "left_anti"))
        edges = cut_lineage(like.join(gone, "id", "left_anti").join(gone.select(F.col("id").alias("head")), "head", "left_anti").select("id", "head", "jaccard"))
        waiting = edges.select("id", F.lit("waits").alias("w")).distinct()
        sure = kept.select("id", F.lit("kept").alias("k"))
        left = state.select("id").join(gone, "id", "left_anti").join(sure, "id", "left").join(waiting, "id", "left")
        state = cut_lineage(left.select("id", F.coalesce("k", "w", F.lit("looks")).alias("state")))
        # only groups in which someone looks have to be seen again
        open_groups = shared.join(state.filter("state = 'looks'"), "id", "left_semi").select("token", "band").distinct()
        lines = shared.join(open_groups, ["token", "band"], "left_semi")

    found = verdicts[0] if verdicts else None
    for more in verdicts[1:]:
        found = found.unionByName(more)
    if found is None:
        return copies.select(F.col("id").alias(id_col), F.col("rep").alias("kept_id"), F.lit(1.0).alias("jaccard"))
    # a group of identical rows may be hot, its verdict is one line: look it up by the same salted join
    weights = copies.groupBy("rep").agg(F.count(F.lit(1)).alias("n"))
    facts = weights.join(found.withColumnRenamed("id", "rep"), "rep", "left")
    placed = salted_lookup(copies, facts, "rep", "n")
    return placed.select(
        F.col("id").alias(id_col), F.coalesce("kept_id", "rep").alias("kept_id"), F.coalesce("jaccard", F.lit(1.0)).alias("jaccard")
    )


def _prefixes(sets: DataFrame, threshold: float) -> DataFrame:
    """``token, id, size, place``: the rarest shingles of each row, as many as a similar row cannot miss altogether, with their places in the order."""
    lines = sets.select("id", F.size("s").alias("size"), F.explode("s").alias("token"))
    n = lines.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    # a shingle that only one row has links nothing, but it takes its place among the first ones: its row needs the number of such
    shared = salted_lookup(lines, n.filter("n > 1"), "token", "n")
    own = shared.groupBy("id", "size").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("rest"))
    length = F.col("size") - F.ceil(F.lit(threshold) * F.col("size") - 1e-9) + 1
    alone = F.col("size") - F.size("rest")
    left = F.greatest(F.lit(0), length - alone).cast("int")
    return own.select("id", "size", alone.alias("alone"), F.posexplode(F.slice("rest", F.lit(1), left)).alias("at", "t")).select(
        F.col("t.token").alias("token"), "id", "size", (F.col("alone") + F.col("at")).alias("place"))


def _with_jaccard(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Exact Jaccard of (id, head) pairs. Sets that no pair names stay where they are. A head may have very many members, hence the salt."""
    named = cut_lineage(pairs.select(F.explode(F.array("id", "head")).alias("id")).distinct())
    sets = cut_lineage(sets.join(broadcast_if_small(named, _FEW), "id", "left_semi"))
    members = pairs.join(sets, "id")
    weights = pairs.groupBy("head").agg(F.count(F.lit(1)).alias("n"))
    head_sets = weights.join(sets.select(F.col("id").alias("head"), F.col("s").alias("hs")), "head")
    both = salted_lookup(members, head_sets, "head", "n")
    return both.select("id", "head", jaccard(F.col("s"), F.col("hs")).alias("jaccard"))
