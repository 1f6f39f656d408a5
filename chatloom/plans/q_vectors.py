"""Queries over embedding tables. Vectors leave as short text so that both engines can be compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.operators import vectors as Q
from chatloom.plans.registry import query, table, texts

_V = "list_transform(embedding, lambda x: x::DOUBLE)"


def vectors(spark, sf_dir):
    return texts(spark, sf_dir, "embeddings", "vec_id", "label", "embedding")


@query("calibrate_range", f"""
WITH e AS (SELECT unnest({_V}) AS x, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings),
r AS (SELECT abs(x) AS m, row_number() OVER (ORDER BY abs(x)) AS rn, count(*) OVER () AS c FROM e),
u AS (SELECT 'table' AS scope, min(x) AS r_min, max(x) AS r_max FROM e UNION ALL SELECT 'dim ' || dim::VARCHAR, min(x), max(x) FROM e GROUP BY dim
  UNION ALL SELECT 'p99.99', -min(m), min(m) FROM r WHERE rn >= 0.9999 * c)
SELECT scope, round(r_min, 6) AS r_min, round(r_max, 6) AS r_max FROM u""")
def calibrate_range(spark, sf_dir):
    e = vectors(spark, sf_dir)
    whole = Q.calibrate_range(e, "embedding").withColumn("scope", F.lit("table"))
    dims = Q.calibrate_range(e, "embedding", per="dim").select("r_min", "r_max", F.concat(F.lit("dim "), "dim").alias("scope"))
    clipped = Q.calibrate_range(e, "embedding", how="percentile").withColumn("scope", F.lit("p99.99"))
    ranges = whole.unionByName(dims).unionByName(clipped)
    return ranges.select("scope", F.round("r_min", 6).alias("r_min"), F.round("r_max", 6).alias("r_max"))


@query("calibrate_vectors", f"SELECT vec_id, list_min({_V}) AS r_min, list_max({_V}) AS r_max FROM embeddings")
def calibrate_vectors(spark, sf_dir):
    return Q.calibrate_range(vectors(spark, sf_dir), "embedding", per="vector", id_col="vec_id")


@query("calibrate_mse", f"""
WITH e AS (SELECT unnest({_V}) AS x FROM embeddings), a AS (SELECT (SELECT max(abs(x)) FROM e) * g / 20 AS alpha FROM range(1, 21) t(g)),
s AS (SELECT alpha, sum(pow(x - greatest(-7, least(7, round(x / (alpha / 7)))) * (alpha / 7), 2)) AS err FROM e, a GROUP BY alpha)
SELECT round(arg_min(alpha, err), 6) AS alpha, round(min(err), 4) AS sq_error FROM s""")
def calibrate_mse(spark, sf_dir):
    best = Q.calibrate_mse(vectors(spark, sf_dir), "embedding", bits=4)
    return best.select(F.round("alpha", 6).alias("alpha"), F.round("sq_error", 4).alias("sq_error"))


_AFFINE = f"""v AS (SELECT vec_id, label, {_V} AS v FROM embeddings), sc AS (SELECT *, (list_max(v) - list_min(v)) / 255.0::DOUBLE AS s FROM v),
z AS (SELECT *, round(0 - list_min(v) / s) AS z FROM sc),
q AS (SELECT *, list_transform(v, lambda x: greatest(0, least(255, round(x / s) + z))) AS q FROM z),
quantised AS (SELECT *, list_transform(q, lambda x: (x - z) * s) AS r FROM q)"""


@query("quantize_affine", f"""WITH {_AFFINE}
SELECT vec_id, round(s, 8) AS scale, CAST(z AS INTEGER) AS zero, array_to_string(list_transform(q, lambda x: CAST(x AS INTEGER)), ',') AS codes FROM quantised""")
def quantize_affine(spark, sf_dir):
    coded = Q.quantize_affine(vectors(spark, sf_dir), "embedding")
    return coded.select("vec_id", F.round("scale", 8).alias("scale"), "zero", F.array_join("codes", ",").alias("codes"))


_SYMMETRIC = f"""v AS (SELECT vec_id, label, {_V} AS v FROM embeddings), sc AS (SELECT *, list_max(list_transform(v, lambda x: abs(x))) / 127.0::DOUBLE AS s FROM v),
q AS (SELECT *, list_transform(v, lambda x: greatest(-127, least(127, round(x / s)))) AS q FROM sc),
quantised AS (SELECT *, list_transform(q, lambda x: x * s) AS r FROM q)"""


@query("quantize_symmetric", f"""WITH {_SYMMETRIC}
SELECT vec_id, round(s, 8) AS scale, array_to_string(list_transform(q, lambda x: CAST(x AS INTEGER)), ',') AS codes FROM quantised""")
def quantize_symmetric(spark, sf_dir):
    coded = Q.quantize_symmetric(vectors(spark, sf_dir), "embedding")
    return coded.select("vec_id", F.round("scale", 8).alias("scale"), F.array_join("codes", ",").alias("codes"))


_LEVELS = "[" + ", ".join(f"{x!r}::DOUBLE" for x in Q.NF4_LEVELS) + "]"
_NF4 = f"""v AS (SELECT vec_id, label, {_V} AS v FROM embeddings), sc AS (SELECT *, list_max(list_transform(v, lambda x: abs(x))) AS s FROM v),
q AS (SELECT *, list_transform(v, lambda x: list_position(list_transform({_LEVELS}, lambda l: abs(x / s - l)), list_min(list_transform({_LEVELS}, lambda l: abs(x / s - l)))) - 1) AS q FROM sc),
quantised AS (SELECT *, list_transform(q, lambda x: {_LEVELS}[x + 1] * s) AS r FROM q)"""


@query("quantize_nf4", f"""WITH {_NF4}
SELECT vec_id, round(s, 8) AS absmax, array_to_string(q, ',') AS codes FROM quantised""")
def quantize_nf4(spark, sf_dir):
    coded = Q.quantize_nf4(vectors(spark, sf_dir), "embedding")
    return coded.select("vec_id", F.round(F.col("absmax")[0], 8).alias("absmax"), F.array_join("codes", ",").alias("codes"))


@query("double_quantize", f"""WITH {_NF4}, k AS (SELECT vec_id * vec_id AS vec_id, s, (row_number() OVER (ORDER BY vec_id) - 1) // 256 AS scale_group FROM quantised), g AS (SELECT *, max(s) OVER (PARTITION BY scale_group) / 255.0::DOUBLE AS ss FROM k)
SELECT vec_id, scale_group, round(ss, 8) AS scale_of_scales, CAST(round(s / ss) AS INTEGER) AS code, round(round(s / ss) * ss, 6) AS restored_absmax FROM g""")
def double_quantize(spark, sf_dir):
    """Ids are squared, so that they have gaps."""
    coded = Q.quantize_nf4(vectors(spark, sf_dir), "embedding").withColumn("vec_id", F.col("vec_id") * F.col("vec_id"))
    doubled = Q.double_quantize(coded, "vec_id")
    return doubled.select(
        "vec_id", "scale_group", F.round("scale_of_scales", 8).alias("scale_of_scales"), "code", F.round("restored_absmax", 6).alias("restored_absmax")
    )


def _sql_error(name: str, cte: str, bits: float) -> str:
    return f"""SELECT '{name}' AS method, round(avg(sq), 8) AS mse, round(max(m), 6) AS max_error, round(avg(c), 6) AS mean_cosine, {bits}::DOUBLE AS bits_per_value FROM (
  WITH {cte} SELECT list_sum(list_transform(v, lambda x, i: pow(x - r[i], 2))) / len(v) AS sq, list_max(list_transform(v, lambda x, i: abs(x - r[i]))) AS m, list_cosine_similarity(v, r) AS c FROM quantised)"""


@query("quant_error", " UNION ALL ".join([
    _sql_error("affine", _AFFINE, 9.0), _sql_error("symmetric", _SYMMETRIC, 8.5), _sql_error("nf4", _NF4, 4.127),
]))
def quant_error(spark, sf_dir):
    e = vectors(spark, sf_dir)
    made = [
        ("affine", Q.quantize_affine(e, "embedding"), 8, 64 / 64),
        ("symmetric", Q.quantize_symmetric(e, "embedding"), 8, Q.scale_overhead_bits(64)),
        ("nf4", Q.quantize_nf4(e, "embedding"), 4, Q.scale_overhead_bits(64, 256)),
    ]
    out = None
    for name, df, bits, overhead in made:
        line = Q.quant_error(df, "embedding", "restored", (), bits, overhead).withColumn("method", F.lit(name))
        out = line if out is None else out.unionByName(line)
    return out


@query("outlier_dims", f"""
WITH e AS (SELECT abs(unnest({_V})) AS m, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS dim FROM embeddings),
t AS (SELECT min(m) AS typical FROM (SELECT m, row_number() OVER (ORDER BY m) AS rn, count(*) OVER () AS c FROM e) WHERE rn >= 0.5 * c),
p AS (SELECT dim, max(m) AS peak FROM e GROUP BY dim)
SELECT dim, round(peak, 6) AS peak, round(typical, 6) AS typical, round(peak / typical, 4) AS ratio, peak > typical * 5 AS outlier FROM p, t""")
def outlier_dims(spark, sf_dir):
    dims = Q.outlier_dims(vectors(spark, sf_dir), "embedding", factor=5.0)
    return dims.select(
        "dim", F.round("peak", 6).alias("peak"), F.round("typical", 6).alias("typical"), F.round("ratio", 4).alias("ratio"), "outlier"
    )


def _sql_drift(name: str, a: str, b: str) -> str:
    return f"""SELECT '{name}' AS pair, count(*) AS n_values, round(sum(p * ln(p / q)), 6) AS kl FROM (
  SELECT (coalesce(x.n, 0) + 1)::DOUBLE / sum(coalesce(x.n, 0) + 1) OVER () AS p, (coalesce(y.n, 0) + 1)::DOUBLE / sum(coalesce(y.n, 0) + 1) OVER () AS q
  FROM ({a}) x FULL JOIN ({b}) y ON x.v = y.v)"""


@query("distribution_drift", " UNION ALL ".join([
    _sql_drift("labelled vs unlabelled lang", "SELECT lang AS v, count(*) AS n FROM documents SEMI JOIN labels USING (doc_id) GROUP BY 1",
               "SELECT lang AS v, count(*) AS n FROM documents ANTI JOIN labels USING (doc_id) GROUP BY 1"),
    _sql_drift("first vs second half events", "SELECT event_type AS v, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1",
               "SELECT event_type AS v, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY 1"),
]))
def distribution_drift(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels").select("doc_id")
    langs = Q.drift(docs.join(labels, "doc_id", "left_semi"), docs.join(labels, "doc_id", "left_anti"), "lang")
    events = table(spark, sf_dir, "events").select("ts", "event_type")
    middle = F.lit("2024-01-15").cast("timestamp_ntz")
    halves = Q.drift(events.filter(F.col("ts") < middle), events.filter(F.col("ts") >= middle), "event_type")
    return langs.withColumn("pair", F.lit("labelled vs unlabelled lang")).unionByName(halves.withColumn("pair", F.lit("first vs second half events")))


@query("cosine_similarity", """
SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 4) AS cosine,
  list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.1 AS match
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def cosine_similarity(spark, sf_dir):
    e = vectors(spark, sf_dir)
    after = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    pairs = Q.pair_similarity(e.join(after, "vec_id"), "embedding", "other", 0.1)
    return pairs.select("vec_id", F.round("cosine", 4).alias("cosine"), "match")


@query("top_k_similar", f"""
WITH d AS (SELECT label, unnest({_V}) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
m AS (SELECT label, i, avg(x) AS x FROM d GROUP BY ALL), c AS (SELECT label, list(x ORDER BY i) AS c FROM m GROUP BY label),
s AS (SELECT c.label AS query_id, vec_id AS base_id, list_cosine_similarity(c, {_V}) AS cos FROM c, embeddings),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cos DESC, base_id) AS rank FROM s)
SELECT query_id, base_id, round(cos, 4) AS cosine, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5""")
def top_k_similar(spark, sf_dir):
    """The five vectors nearest to each label's centroid."""
    e = vectors(spark, sf_dir)
    found = Q.top_k_similar(Q.centroids(e, "label", "embedding"), e, 5, "label", "centroid", "vec_id", "embedding")
    return found.select("query_id", "base_id", F.round("cosine", 4).alias("cosine"), "rank")
