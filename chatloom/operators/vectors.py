"""Embedding tables: range calibration, quantisation, error, outliers, drift and similarity.

Per-vector work is a narrow projection. Only range reports, outliers and drift aggregate, and
they combine on the map side into a handful of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatloom.functions.arrays import cosine, dot, doubles, max_abs, total
from chatloom.functions.text import let
from chatloom.plans.positions import running_total

# The 16 levels of the 4-bit normal-float code book.
NF4_LEVELS = [
    -1.0, -0.6961914, -0.5250730, -0.3949219, -0.2844413, -0.1847732, -0.0910503, 0.0,
    0.0795803, 0.1609320, 0.2461141, 0.3379152, 0.4407098, 0.5626170, 0.7229565, 1.0,
]
NF4_ZERO = NF4_LEVELS.index(0.0)
NF4_MIDPOINTS = [(a + b) / 2 for a, b in zip(NF4_LEVELS, NF4_LEVELS[1:])]


# --- ranges ---------------------------------------------------------------------------

def calibrate_range(df: DataFrame, col: str, how: str = "minmax", per: str = "table", id_col: str | None = None, pct: float = 99.99, accuracy: int = 1_000_000) -> DataFrame:
    """Value range of a vector column per ``table``, ``dim`` or ``vector``.

    ``minmax`` gives the extremes. ``percentile`` gives a symmetric bound holding ``pct`` percent of
    the magnitudes, from a mergeable sketch with rank error ``1/accuracy`` (exact below that
    many values).
    """
    v = doubles(col)
    if per == "vector":
        if how != "minmax":
            raise ValueError("per='vector' supports minmax only")
        return df.select(id_col, F.array_min(v).alias("r_min"), F.array_max(v).alias("r_max"))
    if per == "table" and how == "minmax":
        return df.agg(F.min(F.array_min(v)).alias("r_min"), F.max(F.array_max(v)).alias("r_max"))
    flat = df.select(F.posexplode(v).alias("dim", "x"))
    keys = ["dim"] if per == "dim" else []
    if how == "minmax":
        return flat.groupBy(*keys).agg(F.min("x").alias("r_min"), F.max("x").alias("r_max"))
    bound = F.percentile_approx(F.abs("x"), pct / 100.0, accuracy)
    return flat.groupBy(*keys).agg(bound.alias("r_max")).select(*keys, (-F.col("r_max")).alias("r_min"), "r_max")


def calibrate_mse(df: DataFrame, col: str, bits: int = 8, steps: int = 20) -> DataFrame:
    """Symmetric bound among ``steps`` equal fractions of max|r| with the least squared error.

    Two passes: the maximum (one number), then all candidate errors side by side in one
    aggregation. No candidate multiplies the rows.
    """
    v = doubles(col)
    peak = df.agg(F.max(max_abs(v))).first()[0]
    if not peak:
        return df.agg(F.lit(0.0).alias("alpha"), F.lit(0.0).alias("sq_error"))
    q_max = 2 ** (bits - 1) - 1
    alphas = [peak * (g + 1) / steps for g in range(steps)]

    def error(alpha: float) -> Column:
        scale = alpha / q_max
        return total(F.transform(v, lambda x: F.pow(x - clip(F.round(x / scale), -q_max, q_max) * scale, 2)))

    sums = df.agg(*[F.sum(error(a)).alias(f"_{i}") for i, a in enumerate(alphas)])
    best = F.array_min(F.array(*[F.struct(F.col(f"_{i}").alias("e"), F.lit(a).alias("a")) for i, a in enumerate(alphas)]))
    return sums.select(best["a"].alias("alpha"), best["e"].alias("sq_error"))


def clip(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), c))


# --- quantisers -----------------------------------------------------------------------

def quantize_affine(df: DataFrame, col: str, bits: int = 8, signed: bool = False) -> DataFrame:
    """Asymmetric quantisation per vector: adds ``scale, zero, codes, restored``. A constant vector has scale 1."""
    q_min, q_max = (-(2 ** (bits - 1)), 2 ** (bits - 1) - 1) if signed else (0, 2 ** bits - 1)
    v = doubles(col)
    span = F.array_max(v) - F.array_min(v)
    ranged = df.withColumn("scale", F.when(span == 0, 1.0).otherwise(span / float(q_max - q_min)))
    ranged = ranged.withColumn("zero", F.round(F.lit(float(q_min)) - F.array_min(v) / F.col("scale")))
    # let() binds scale and zero once; named columns could be recomputed for every element
    grid = F.struct("scale", "zero")
    coded = ranged.withColumn("codes", let(grid, lambda g: F.transform(v, lambda x: clip(F.round(x / g["scale"]) + g["zero"], q_min, q_max))))
    restored = coded.withColumn("restored", let(grid, lambda g: F.transform("codes", lambda q: (q - g["zero"]) * g["scale"])))
    return restored.withColumn("zero", F.col("zero").cast("int")).withColumn("codes", F.col("codes").cast("array<int>"))


def quantize_symmetric(df: DataFrame, col: str, bits: int = 8) -> DataFrame:
    """Zero point 0: adds ``scale, codes, restored``. An all-zero vector has scale 1."""
    q_max = 2 ** (bits - 1) - 1
    v = doubles(col)
    ranged = df.withColumn("_m", max_abs(v)).withColumn("scale", F.when(F.col("_m") == 0, 1.0).otherwise(F.col("_m") / float(q_max))).drop("_m")
    coded = ranged.withColumn("codes", let(F.col("scale"), lambda s: F.transform(v, lambda x: clip(F.round(x / s), -q_max, q_max))))
    restored = coded.withColumn("restored", let(F.col("scale"), lambda s: F.transform("codes", lambda q: q * s)))
    return restored.withColumn("codes", F.col("codes").cast("array<int>"))


def blocks(v: Column, size: int) -> Column:
    """Consecutive slices of ``size`` values; the last one may be shorter."""
    count = F.ceil(F.size(v) / F.lit(size)).cast("int")
    return F.transform(F.sequence(F.lit(0), count - 1), lambda b: F.slice(v, b * size + 1, size))


def quantize_nf4(df: DataFrame, col: str, block: int = 64) -> DataFrame:
    """4-bit normal-float codes per block: adds ``absmax`` (one per block), ``codes`` and ``restored``.

    The nearest level is found by counting the midpoints below the value, so the lower
    level wins ties. An all-zero block gets the zero code.
    """
    cut = df.withColumn("_b", blocks(doubles(col), block)).withColumn("absmax", F.transform("_b", max_abs))

    def code(x: Column) -> Column:
        above = [(x > m).cast("int") for m in NF4_MIDPOINTS]
        return sum(above[1:], above[0])

    coded = cut.withColumn("codes", F.flatten(F.zip_with(
        "_b", "absmax", lambda values, m: F.transform(values, lambda x: F.when(m == 0, F.lit(NF4_ZERO)).otherwise(code(x / m)))
    )))
    levels = F.array(*[F.lit(x) for x in NF4_LEVELS])
    restored = let(F.col("absmax"), lambda m: F.transform("codes", lambda c, i: F.get(levels, c) * F.get(m, F.floor(i / F.lit(block)).cast("int"))))
    return coded.withColumn("restored", restored).drop("_b")


def double_quantize(df: DataFrame, id_col: str, absmax: str = "absmax", group: int = 256) -> DataFrame:
    """Second-level quantisation of block scales in groups of ``group``, in storage (id, block) order.

    8-bit linear codes with one scale per group. Groups follow the place of a vector's scales among all scales, whatever the ids
    are; places are running totals over lengths, so nothing needs a global row number. Ids are unique.
    """
    lengths = df.select(id_col, F.size(absmax).alias("_n"))
    placed = running_total(lengths, F.col("_n"), [], [id_col], "_end")
    scales = placed.join(df.select(id_col, absmax), id_col).select(id_col, (F.col("_end") - F.col("_n")).alias("_first"), F.posexplode(absmax).alias("block", "absmax"))
    grouped = scales.withColumn("scale_group", F.floor((F.col("_first") + F.col("block")) / F.lit(group)).cast("bigint")).drop("_first")
    top = F.max("absmax").over(Window.partitionBy("scale_group"))
    ranged = grouped.withColumn("scale_of_scales", F.when(top == 0, 1.0).otherwise(top / 255.0))
    coded = ranged.withColumn("code", F.round(F.col("absmax") / F.col("scale_of_scales")).cast("int"))
    return coded.withColumn("restored_absmax", F.col("code") * F.col("scale_of_scales"))


def scale_overhead_bits(block: int = 64, group: int | None = None) -> float:
    """Bits per value spent on scales: 32-bit per block, or 8-bit per block plus 32-bit per group."""
    return 32 / block if group is None else 8 / block + 32 / (block * group)


def quant_error(df: DataFrame, original: str, restored: str, by: Sequence[str] = (), code_bits: float = 8, overhead_bits: float = 0.0) -> DataFrame:
    """MSE, largest error, mean cosine before / after and bits per value."""
    a = doubles(original)
    rows = df.withColumn("_e", F.zip_with(a, restored, lambda x, y: x - y)).select(
        *by, dot(F.col("_e"), F.col("_e")).alias("_sq"), F.size("_e").cast("bigint").alias("_n"), max_abs(F.col("_e")).alias("_m"),
        cosine(a, F.col(restored)).alias("_c"),
    )
    return rows.groupBy(*by).agg(
        F.round(F.try_divide(F.sum("_sq"), F.sum("_n").cast("double")), 8).alias("mse"), F.round(F.max("_m"), 6).alias("max_error"),
        F.round(F.avg("_c"), 6).alias("mean_cosine"), F.lit(round(code_bits + overhead_bits, 4)).alias("bits_per_value"),
    )


def outlier_dims(df: DataFrame, col: str, factor: float = 3.0, accuracy: int = 1_000_000) -> DataFrame:
    """Dimensions whose largest magnitude exceeds ``factor`` times the median magnitude of the table."""
    flat = df.select(F.posexplode(doubles(col)).alias("dim", "x"))
    peaks = flat.groupBy("dim").agg(F.max(F.abs("x")).alias("peak"))
    typical = flat.agg(F.percentile_approx(F.abs("x"), 0.5, accuracy)).first()[0]
    named = peaks.withColumn("typical", F.lit(typical).cast("double"))
    return named.withColumn("ratio", F.try_divide("peak", "typical")).withColumn("outlier", F.col("peak") > F.col("typical") * factor)


def drift(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """D_KL(P || Q) of a column between two tables, with add-one smoothing over the joint domain.

    With smoothed counts a' = a + 1 and b' = b + 1 the sum is (sum a' ln(a'/b')) / A' + ln(B'/A'), so
    one aggregate of the per-value counts is enough.
    """
    def side(df: DataFrame, is_a: int) -> DataFrame:
        counts = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
        return counts.select("value", (F.col("n") * is_a).alias("na"), (F.col("n") * (1 - is_a)).alias("nb"))

    merged = side(a, 1).unionByName(side(b, 0)).groupBy("value").agg((F.sum("na") + 1).alias("pa"), (F.sum("nb") + 1).alias("pb"))
    pa, pb = F.col("pa").cast("double"), F.col("pb").cast("double")
    sums = merged.agg(F.count(F.lit(1)).alias("n_values"), F.sum(pa * F.log(pa / pb)).alias("_s"), F.sum(pa).alias("_a"), F.sum(pb).alias("_b"))
    return sums.select("n_values", F.round(F.col("_s") / F.col("_a") + F.log(F.col("_b") / F.col("_a")), 6).alias("kl"))


# --- similarity -----------------------------------------------------------------------

def pair_similarity(df: DataFrame, a: str, b: str, threshold: float) -> DataFrame:
    """Add ``cosine`` and ``match`` for two vector columns."""
    scored = df.withColumn("cosine", cosine(doubles(a), doubles(b)))
    return scored.withColumn("match", F.coalesce(F.col("cosine") >= threshold, F.lit(False)))


def centroids(df: DataFrame, label: str, col: str) -> DataFrame:
    """Mean vector per label: one line per (label, dimension) crosses the network."""
    means = df.select(label, F.posexplode(doubles(col)).alias("dim", "x")).groupBy(label, "dim").agg(F.avg("x").alias("m"))
    rows = means.groupBy(label).agg(F.sort_array(F.collect_list(F.struct("dim", "m"))).alias("_d"))
    return rows.select(label, F.transform("_d", lambda d: d["m"]).alias("centroid"))


def top_k_similar(
    queries: DataFrame, base: DataFrame, k: int, query_id: str, query_vec: str, base_id: str, base_vec: str, rows_per_block: int = 100_000
) -> DataFrame:
    """The ``k`` base vectors with the highest cosine for each query (ties: smaller base id): ``query_id, base_id, cosine, rank``.

    A stated set of queries meets the base in blocks. The base is scanned once and dealt into blocks of about ``rows_per_block`` vectors by a hash of the id;
    every block also gets the queries, which come after it in the block's order. A task holds one block as a matrix and streams the queries past it,
    one Arrow batch and one product at a time, so neither side is ever collected. At most ``k`` lines per query and block leave it, and
    a window that drops losers before its shuffle merges them. Base vectors of length zero are left out; a null vector is one of length zero.
    """
    wanted = queries.select(F.col(query_id).alias("query_id"), doubles(query_vec).alias("vec"))
    rows = base.select(F.col(base_id).alias("base_id"), doubles(base_vec).alias("vec")).filter("vec IS NOT NULL")
    blocks = max(1, -(-rows.count() // rows_per_block))
    dealt = rows.select(F.pmod(F.xxhash64("base_id"), F.lit(blocks)).alias("block"), F.lit(0).alias("turn"), F.lit(None).cast(wanted.schema["query_id"].dataType).alias("query_id"), "base_id", "vec")
    asked = wanted.select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block"), F.lit(1).alias("turn"), "query_id",
                          F.lit(None).cast(rows.schema["base_id"].dataType).alias("base_id"), "vec")
    met = dealt.unionByName(asked).repartition("block").sortWithinPartitions("block", "turn", "base_id")
    schema = T.StructType([wanted.schema["query_id"], rows.schema["base_id"], T.StructField("cosine", T.DoubleType())])
    best = Window.partitionBy("query_id").orderBy(F.desc("cosine"), "base_id")
    return met.mapInArrow(_block_scorer(k), schema).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _block_scorer(k: int, at_once: int = 256):
    """Streams rows sorted by (block, turn): vectors of a block are stacked, then its queries are scored against them."""

    def unit(batch: pa.RecordBatch, width: int | None) -> np.ndarray:
        vectors = batch["vec"].to_pylist()
        width = width or next((len(v) for v in vectors if v), 0)
        out = np.array([v if v is not None and len(v) == width else [0.0] * width for v in vectors], np.float64).reshape(len(vectors), width)
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), np.finfo(float).tiny)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, ids, matrix = None, [], [], None

        def scored(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for start in range(0, batch.num_rows, at_once):
                asked = batch.slice(start, at_once)
                scores = matrix @ unit(asked, matrix.shape[1]).T
                some = min(k, len(matrix))
                least = np.partition(scores, len(matrix) - some, axis=0)[len(matrix) - some]
                lines_q, lines_b, lines_s = [], [], []
                for q in range(asked.num_rows):
                    # all that tie with the k-th are looked at; rows lie by id, so the stable order breaks ties
                    near = np.flatnonzero(scores[:, q] >= least[q])
                    near = near[np.argsort(-scores[near, q], kind="stable")][:some]
                    lines_q += [q] * len(near)
                    lines_b += near.tolist()
                    lines_s += scores[near, q].tolist()
                yield pa.RecordBatch.from_arrays(
                    [asked["query_id"].take(pa.array(lines_q, pa.int64())), everyone.take(pa.array(lines_b, pa.int64())), pa.array(lines_s, pa.float64())],
                    names=["query_id", "base_id", "cosine"])

        for batch in batches:
            key = batch["block"].to_numpy() * 2 + batch["turn"].to_numpy()
            for part in np.split(np.arange(len(key)), np.flatnonzero(np.diff(key)) + 1) if len(key) else []:
                rows = batch.slice(int(part[0]), len(part))
                now, turn = divmod(int(key[part[0]]), 2)
                if now != block:
                    block, parts, ids, matrix = now, [], [], None
                if turn == 0:
                    vectors = unit(rows, parts[0].shape[1] if parts else None)
                    real = np.abs(vectors).sum(1) > 0
                    parts.append(vectors[real])
                    ids.append(rows["base_id"].filter(pa.array(real)))
                    continue
                if matrix is None and parts:
                    matrix, everyone, parts, ids = np.concatenate(parts), pa.concat_arrays(ids), [], []
                if matrix is not None and len(matrix):
                    yield from scored(rows)

    return run
