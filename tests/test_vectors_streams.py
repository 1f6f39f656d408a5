import pytest
from pyspark.sql import functions as F

from chatloom.operators import vectors as Q
from chatloom.streaming import jobs as J

SCHEMA = "id long, v array<float>"


@pytest.fixture()
def edge_vectors(spark):
    rows = [(0, [0.0] * 4), (1, [2.5] * 4), (2, [-1.0, 0.5, 0.25, 1.0]), (3, [-3.0, -2.0, -1.0, -0.5])]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("signed", [False, True])
def test_affine_error_is_at_most_half_a_step(edge_vectors, signed):
    for r in Q.quantize_affine(edge_vectors, "v", 8, signed).collect():
        low, high = (-128, 127) if signed else (0, 255)
        assert all(low <= c <= high for c in r.codes)
        if len(set(r.v)) > 1:
            # rounding the zero point shifts the grid by up to half a step as well
            assert max(abs(a - b) for a, b in zip(r.v, r.restored)) <= r.scale + 1e-9


def test_symmetric(edge_vectors):
    got = {r.id: r for r in Q.quantize_symmetric(edge_vectors, "v").collect()}
    assert got[0].codes == [0] * 4 and got[1].codes == [127] * 4
    assert all(abs(a - b) <= got[3].scale / 2 + 1e-9 for a, b in zip(got[3].v, got[3].restored))


def test_nf4_blocks(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0, 4.0, -4.0, 2.0])], SCHEMA)
    row = Q.quantize_nf4(df, "v", block=2).first()
    assert row.absmax == [0.0, 4.0, 2.0]
    assert row.codes == [7, 7, 15, 0, 15] and row.restored == [0.0, 0.0, 4.0, -4.0, 2.0]
    tie = (Q.NF4_LEVELS[8] + Q.NF4_LEVELS[9]) / 2
    low = Q.quantize_nf4(spark.createDataFrame([(1, [1.0, tie])], "id long, v array<double>"), "v").first()
    assert low.codes[1] == 8


def test_overheads():
    assert Q.scale_overhead_bits(64) == 0.5 and round(Q.scale_overhead_bits(64, 256), 3) == 0.127


def test_ranges(edge_vectors):
    whole = Q.calibrate_range(edge_vectors, "v").first()
    assert (whole.r_min, whole.r_max) == (-3.0, 2.5)
    bound = Q.calibrate_range(edge_vectors, "v", how="percentile", pct=50).first()
    assert (bound.r_min, bound.r_max) == (-1.0, 1.0)
    assert Q.calibrate_range(edge_vectors, "v", per="dim").count() == 4


def test_mse_bound_clips_an_outlier(spark):
    df = spark.createDataFrame([(1, [0.1 * i for i in range(-20, 21)] + [10.0])], "id long, v array<double>")
    assert Q.calibrate_mse(df, "v", bits=3).first().alpha < 10.0
    assert Q.calibrate_mse(spark.createDataFrame([(1, [0.0])], SCHEMA), "v").first().alpha == 0.0


def test_drift_is_zero_for_equal_tables_and_counts_missing_values(spark):
    a = spark.createDataFrame([("x",), ("y",)], "c string")
    b = spark.createDataFrame([("x",), ("z",)], "c string")
    assert Q.drift(a, a, "c").first().kl == 0.0
    row = Q.drift(a, b, "c").first()
    assert row.n_values == 3 and row.kl > 0


def test_outlier_dims(spark):
    df = spark.createDataFrame([(i, [1.0, -1.0, 40.0 if i == 3 else 1.0]) for i in range(9)], SCHEMA)
    assert [r.dim for r in Q.outlier_dims(df, "v").filter("outlier").collect()] == [2]


def test_cosine_of_zero_vector_is_null(edge_vectors):
    row = Q.pair_similarity(edge_vectors.filter("id = 0"), "v", "v", 0.5).first()
    assert row.cosine is None and row.match is False


def test_top_k_chunks_agree(spark):
    base = spark.range(60).select("id", F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.sin(F.col("id") * 7 + i)).alias("v")).repartition(5)
    queries = base.filter("id < 10")
    one = Q.top_k_similar(queries, base, 3, "id", "v", "id", "v").drop("cosine")
    many = Q.top_k_similar(queries, base, 3, "id", "v", "id", "v", rows_per_block=7).drop("cosine")
    got = sorted(map(tuple, one.collect()))
    assert got == sorted(map(tuple, many.collect())) and len(got) == 30
    assert all(q == b for q, b, rank in got if rank == 1)


def test_closed_windows_equal_batch(spark, tmp_path):
    rows = spark.range(2000).select(
        F.timestamp_seconds(F.col("id") * 97 + F.floor(F.col("id") / 100) * 3600).alias("ts"), (F.col("id") % 5).alias("client"), (F.col("id") % 50).alias("tokens"),
        (F.col("id") % 9 + 1.0).alias("seconds"), F.when(F.col("id") % 11 == 0, 500).otherwise(200).alias("status"),
    )
    rows.write.parquet(f"{tmp_path}/in")
    log = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    closed = rows.agg((F.max("ts") - F.expr("INTERVAL 1 HOUR")).alias("m")).first().m

    usage = J.drain(J.stream_usage(log, "2 hours", by=("client",)), f"{tmp_path}/u", f"{tmp_path}/us")
    want = J.stream_usage(rows, "2 hours", by=("client",)).filter(F.col("window_end") <= closed)
    assert sorted(map(tuple, usage.collect())) == sorted(map(tuple, want.select(*usage.columns).collect()))

    sessions = J.drain(J.stream_sessions(log, "10 minutes"), f"{tmp_path}/s", f"{tmp_path}/ss")
    want = J.stream_sessions(rows, "10 minutes").filter(F.col("session_end") <= closed)
    assert want.count() > 50
    assert sorted(map(tuple, sessions.collect())) == sorted(map(tuple, want.collect()))


def test_curation_resumes_without_repeats(spark, tmp_path):
    schema = "messages array<struct<role:string,content:string>>"
    good, bad = [("user", "q1"), ("model", "a")], [("user", "q2")]
    other = [("user", "q3"), ("model", "a")]
    from chatloom.sources.datasets import CHAT_SAMPLE, write_jsonl

    def feed(batch):
        write_jsonl(spark.createDataFrame([(m,) for m in batch], schema), f"{tmp_path}/in", mode="append")
        stream = J.from_files(spark, f"{tmp_path}/in", "*.json", CHAT_SAMPLE, "json")
        for q in J.stream_curate(stream, f"{tmp_path}/good", f"{tmp_path}/bad", f"{tmp_path}/state"):
            q.awaitTermination()

    feed([good, good, bad])
    feed([good, other])
    kept = spark.read.parquet(f"{tmp_path}/good").select(F.col("messages")[0]["content"].alias("c")).collect()
    assert sorted(r.c for r in kept) == ["q1", "q3"]
    assert [r.reasons for r in spark.read.parquet(f"{tmp_path}/bad").collect()] == [["turn_count", "roles"]]
