import pytest
from pyspark.sql import functions as F

from chatloom.functions.seeded import flip, pick_index
from chatloom.operators import catalogue as C
from chatloom.operators import synthesis as S


def test_catalogue_shape():
    texts = [t for ts in C.TEMPLATES.values() for t in ts]
    assert len(set(texts)) == len(texts) and all("{domain}" in t for t in texts)
    assert [sum(p in c for c in C.TEMPLATES) for p in ("positive", "negative", "neutral")] == [6, 5, 3]
    assert all(any(a in t for t in texts) for a in C.ADJECTIVES)


def test_draws_ignore_partitioning(spark):
    ids = spark.range(500)

    def drawn(df):
        return sorted(map(tuple, df.select("id", pick_index(9, 1, "s", F.col("id")), flip(0.3, 1, "f", F.col("id"))).collect()))

    assert drawn(ids.repartition(1)) == drawn(ids.repartition(7))


def test_label_mix_follows_the_groups(spark):
    rows = S.sample_two_stage(spark.range(20_000), "id", 3).withColumn("label", S.label_from_category(F.col("category")))
    share = {r.label: r["count"] / 20_000 for r in rows.groupBy("label").count().collect()}
    assert share["Positive"] == pytest.approx(6 / 14, abs=0.015)
    assert share["Negative"] == pytest.approx(5 / 14, abs=0.015)
    assert share["Neutral"] == pytest.approx(3 / 14, abs=0.015)


def test_positive_is_checked_first(spark):
    row = spark.range(1).select(S.label_from_category(F.lit("positive_and_negative")).alias("l")).first()
    assert row.l == "Positive"


def test_intensifier_takes_first_listed_adjective(spark):
    df = spark.createDataFrame([(i, "bad and wonderful and wonderful") for i in range(200)], "id int, t string")
    out = {r[0] for r in df.select(S.inject_intensifier(F.col("t"), 1, F.col("id"), p=1.0)).collect()}
    assert all(o.startswith("bad and ") and o.count("wonderful") == 2 and o != "bad and wonderful and wonderful" for o in out)
    assert len({o.split(" ")[2] for o in out}) == len(C.INTENSIFIERS)


def test_percent_signs_and_braces_survive_wrapping(spark):
    df = spark.createDataFrame([(1, "100% {x} %s")], "id int, t string")
    assert df.select(S.wrap_task(F.col("t"), "classify").alias("o")).first().o == "Classify the sentiment: '100% {x} %s'"


def test_synthesise_exact_count(spark):
    made = S.synthesise_exactly(spark, 300, 5)
    assert made.count() == 300 and made.select("text").distinct().count() == 300
    roles = made.select(F.transform("messages", lambda m: m["role"]).alias("r")).distinct().collect()
    assert [r.r for r in roles] == [["user", "model"]]


def test_synthesise_reports_the_ceiling(spark):
    with pytest.raises(ValueError, match="distinct texts"):
        S.synthesise(spark.range(50), "id", 1, 10, catalogue={"plain_positive": ["Same"]}, lexicon={"d": ["n"]})


def test_label_first_has_no_neutral(spark):
    labels = S.sample_label_first(spark.range(500), "id", 2).groupBy("label").count().collect()
    assert {r.label for r in labels} == {"Positive", "Negative"}
