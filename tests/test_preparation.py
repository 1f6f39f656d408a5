import random

import pytest
from pyspark.sql import functions as F

from chatloom.operators import prepare as P
from chatloom.operators import serving as S
from chatloom.plans.positions import running_total, salted_lookup, smallest
from chatloom.sources import datasets as D

ROLE = "struct<role:string,content:string>"


def test_running_total_equals_a_plain_window(spark):
    rng = random.Random(1)
    rows = [(i * 7 - 500, rng.choice(["hot", "hot", "cold", None]), rng.randint(0, 9)) for i in range(800)]
    df = spark.createDataFrame(rows, "id long, g string, v int").repartition(6)
    got = {r.id: r.t for r in running_total(df, F.col("v"), ["g"], ["id"], "t").collect()}
    sums = {}
    for i, g, v in rows:
        sums[g] = sums.get(g, 0) + v
        assert got[i] == sums[g]


def test_running_total_spreads_clumped_ids_and_an_outlier(spark, monkeypatch):
    from chatloom.plans import positions

    cut, seen = positions.cut_lineage, []
    monkeypatch.setattr(positions, "cut_lineage", lambda df: seen.append(cut(df)) or seen[-1])
    df = spark.range(20_000).select("id").unionByName(spark.createDataFrame([(10**18,)], "id long")).withColumn("d", F.lit("one day"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = running_total(df, F.lit(1), ["d"], ["id"], "t")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got.filter("t <> id + 1 AND id < 1000000").isEmpty() and got.filter("id > 1000000").first().t == 20_001
    sizes = [r["n"] for r in seen[0].groupBy(F.shiftright("_at", 33)).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 4 and max(sizes) < 8000


def test_smallest_matches_a_sort(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice("ab"), rng.choice([rng.randrange(2**32), 5, 2**32 - 1])) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, g string, v long").repartition(5)
    for k in (0, 1, 40, 450, 2000):
        got = {r.id for r in smallest(df, ["g"], F.when(F.col("g") == "a", k).otherwise(3), "v", ["id"]).collect()}
        want = {i for g, n in (("a", k), ("b", 3)) for v, i in sorted((v, i) for i, h, v in rows if h == g)[:n]}
        assert got == want
    assert smallest(df.limit(0), [], F.lit(3), "v", ["id"]).collect() == []


def test_salted_lookup_keeps_every_row(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") < 700, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    facts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("lo"))
    joined = salted_lookup(rows, facts, "k", "n", hot=100, salts=8)
    assert joined.count() == 1000 and joined.filter("k = 'hot' AND lo <> 0").count() == 0


def test_long_conversations_are_split_not_cut(spark):
    turns = spark.range(25).select(F.lit(1).alias("c"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.concat(F.lit("t"), "id").alias("text"))
    made = P.assemble_parts(turns, "c", "turn", part_turns=10)
    assert sorted((r.part, len(r.messages)) for r in made.collect()) == [(0, 10), (1, 10), (2, 5)]
    for some in (made, P.assemble_conversations(turns, "c", "turn", part_turns=10)):
        assert sorted((r.turn, r.text) for r in P.explode_turns(some, "c").collect()) == [(i, f"t{i}") for i in range(25)]
    odd = turns.withColumn("turn", F.col("turn") * 7 + 5000)
    wholes = [sorted(map(tuple, P.assemble_conversations(odd, "c", "turn", part_turns=n).collect())) for n in (3, 4096)]
    assert wholes[0] == wholes[1] and len(wholes[0]) == 1
    assert [r.turn for r in P.explode_turns(P.assemble_conversations(odd, "c", "turn"), "c").collect()] == [i * 7 + 5000 for i in range(25)]


def test_parts_render_like_the_whole(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "model", f"{c}-{t}") for c in range(3) for t in range(5 + c)]
    turns = spark.createDataFrame(rows, "c long, turn long, role string, text string")

    def rendered(part_turns):
        made = P.with_ends(P.assemble_parts(turns, "c", "turn", part_turns=part_turns), "c")
        text = P.render_chat(F.col("messages"), add_generation_prompt=True, first_part=F.col("is_first"), last_part=F.col("is_last"))
        found = made.select("c", "part", text.alias("t")).orderBy("c", "part").collect()
        return {c: "".join(r.t for r in found if r.c == c) for c in range(3)}

    assert rendered(2) == rendered(4096)


def test_render_chat(spark):
    df = spark.createDataFrame([([("system", "s"), ("user", "q"), ("assistant", "a"), ("model", "m")],)], f"messages array<{ROLE}>")

    def text(**kw):
        return df.select(P.render_chat(F.col("messages"), **kw).alias("t")).first().t

    q, m = "<start_of_turn>user\nq<end_of_turn>\n", "<start_of_turn>model\nm<end_of_turn>\n"
    assert text() == "<bos>" + q + m
    assert text(role_map={"assistant": "model"}, add_generation_prompt=True) == "<bos>" + q + "<start_of_turn>model\na<end_of_turn>\n" + m + "<start_of_turn>model\n"
    assert text(on_unknown="null") is None


def test_select_train_field_prefers_text(spark):
    a = spark.createDataFrame([("x",)], "text string")
    b = spark.createDataFrame([([("user", "q")],)], f"messages array<{ROLE}>")
    assert P.select_train_field(a).first().train_text == "x"
    assert P.select_train_field(b).first().train_text == "<bos><start_of_turn>user\nq<end_of_turn>\n"


def test_plugged_tokenizer_and_truncation(spark):
    df = spark.createDataFrame([(1, "abcdef"), (2, None)], "i int, t string")
    got = {r.i: r for r in P.truncate_tokens(P.tokenize_rows(df, "t", lambda: list), 4).collect()}
    assert (got[1].tokens, got[1].n_tokens, got[1].n_cut, got[1].was_cut) == (list("abcd"), 4, 2, True)
    assert (got[2].tokens, got[2].n_cut) == ([], 0)


def test_packing_loses_nothing(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice("ab"), [f"{i}.{j}" for j in range(rng.randint(0, 9))]) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, s string, tokens array<string>").repartition(5)
    packed = P.pack_sequences(df, "id", 8, ["s"]).collect()
    for s in "ab":
        stream = [t for _, g, ts in rows if g == s for t in ts]
        blocks = {r.block: r.tokens for r in packed if r.s == s}
        assert [blocks[b] for b in sorted(blocks)] == [stream[i:i + 8] for i in range(0, len(stream), 8)]


def test_batch_plan_across_buckets(spark):
    df = spark.range(50).select((F.col("id") * 3).alias("id"), (F.col("id") % 7).alias("n_tokens"))
    got = {r.id: r for r in P.batch_plan(df, "id", batch_size=2, accumulation=8).collect()}
    for i in range(50):
        mates = [j % 7 for j in (i // 2 * 2, i // 2 * 2 + 1)]
        assert (got[3 * i].micro_batch, got[3 * i].step, got[3 * i].pad_to, got[3 * i].padding) == (i // 2, i // 16, max(mates), max(mates) - i % 7)
    plan = P.batch_plan(spark.range(2000).withColumn("n_tokens", F.lit(1)), "id")
    assert tuple(P.schedule(plan).first()) == (2000, 500, 125, 4)


def test_masked_nll_weighs_tokens(spark):
    df = spark.createDataFrame([([-1.0, -2.0], [0, 1]), ([-4.0, -4.0, -4.0], [1, 1, 1])], "p array<double>, m array<int>")
    row = P.masked_nll(df, "p", "m").first()
    assert (row.target_tokens, row.nll) == (4, 3.5)


def test_batch_predict_isolates_failures(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["good day", "bad", "x" * 50, "so so"])], "i int, t string").repartition(1)
    got = {r.i: (r.prediction, r.error) for r in S.batch_predict(df, S.lexicon_scorer(["good"], ["bad"], 20), "t", 3).collect()}
    assert got == {0: ("Positive", None), 1: ("Negative", None), 2: (None, "ValueError: prompt too long"), 3: ("Neutral", None)}


def test_chat_completion_round_trip(spark):
    df = spark.createDataFrame([(' hi "there"\n',)], "t string")
    body = df.select(S.to_chat_completion(F.lit("m"), F.col("t"), F.lit(3), F.lit(4), F.lit("r1")).alias("b"))
    row = S.parse_chat_completion(body, "b").first()
    assert (row.content, row.finish_reason, row.total_tokens) == ('hi "there"', "stop", 7)
    assert S.parse_chat_completion(spark.createDataFrame([("oops",)], "b string"), "b").first().content is None


def test_speed_with_zero_time(spark):
    df = spark.createDataFrame([(10, 0.0), (10, 2.0)], "tokens long, seconds double")
    assert [r.tokens_per_second for r in S.with_speed(df).collect()] == [None, 5.0]


def test_health_runs_and_grace(spark):
    rows = [("s", i * 60, i) for i in range(10)]
    bad = {0, 1, 3, 4, 5, 6, 8}
    df = spark.createDataFrame([(s, t, i, i in bad) for s, t, i in rows], "svc string, sec int, id int, f boolean")
    df = df.withColumn("ts", F.timestamp_seconds("sec"))
    runs = S.health_runs(df, "svc", "ts", F.col("f"), ["ts", "id"], threshold=3, grace_seconds=120)
    assert sorted((r.failures, r.outage) for r in runs.collect()) == [(1, False), (4, True)]


def test_read_dataset_formats(spark, tmp_path):
    chat = spark.createDataFrame([([("user", "é😀"), ("model", None)],)], f"messages array<{ROLE}>")
    D.write_jsonl(chat, f"{tmp_path}/a.jsonl")
    D.write_jsonl(chat, f"{tmp_path}/b.json", ascii=True)
    for name in ("a.jsonl", "b.json"):
        assert D.read_dataset(spark, f"{tmp_path}/{name}", D.CHAT_SAMPLE).collect() == chat.collect()
    raw = spark.read.text(f"{tmp_path}/a.jsonl").first().value
    escaped = spark.read.text(f"{tmp_path}/b.json").first().value
    assert "é😀" in raw and '"content":null' in raw and escaped.isascii()
    (tmp_path / "c.csv").write_text('text,label\n"a, ""b""\nc",1\n')
    assert [tuple(r) for r in D.read_dataset(spark, f"{tmp_path}/c.csv", D.LABELLED_TEXT).collect()] == [('a, "b"\nc', 1)]
    with pytest.raises(ValueError):
        D.read_dataset(spark, f"{tmp_path}/d.parquet")


def test_read_split_slices(spark):
    df = spark.range(100).select((99 - F.col("id")).alias("id"), F.lit("train").alias("split"))

    def ids(spec):
        return sorted(r.id for r in D.read_split(df, spec, "id", "split").collect())

    assert ids("train[:10]") == list(range(10)) and ids("train[5:8]") == [5, 6, 7]
    assert ids("train[:60]") == list(range(60)) and ids("train[90:]") == list(range(90, 100))
    named = spark.range(12_000).select(F.format_string("k%05d", F.col("id")).alias("id"), F.lit("train").alias("split")).repartition(5)
    for n in (9_999, 10_001):
        got = D.read_split(named, f"train[:{n}]", "id", "split")
        assert got.count() == n and got.agg(F.max("id")).first()[0] == f"k{n - 1:05d}"
    assert len(ids("train")) == 100 and ids("test") == []
    with pytest.raises(ValueError):
        D.read_split(df, "train[1", "id")


def test_requests_with_broken_json(spark):
    df = spark.createDataFrame([(1, '{"prompt": "p", "top_k": 3}'), (2, "{oops")], "i int, body string")
    got = {r.i: r for r in D.parse_requests(df, "body").collect()}
    assert (got[1].prompt, got[1].top_k, got[1].corrupt) == ("p", 3, None) and got[2].corrupt == "{oops"


def test_notebooks_and_audit(spark, tmp_path):
    book = '{"cells": [{"cell_type": "markdown", "source": ["x"]}, {"cell_type": "code", "source": ["!pip x\\n", "  %matplotlib\\n", "run()"]}]}'
    (tmp_path / "n.ipynb").write_text(book)
    (tmp_path / "s.ipynb").write_text('{"cells": [{"cell_type": "code", "source": "[1, 2]"}, {"cell_type": "code", "source": []}]}')
    assert {(r.cell, r.source) for r in D.read_notebooks(spark, f"{tmp_path}/s.ipynb").collect()} == {(0, "[1, 2]"), (1, "")}
    (tmp_path / "s.ipynb").unlink()
    cells = D.read_notebooks(spark, f"{tmp_path}/*.ipynb")
    audited = D.audit_patterns(cells, "source", [("runs", ["run()"], []), ("magic", ["# !pip"], ["#   %mat", "nope"]), ("casts", ["float32", "float16"], [])])
    row = audited.first()
    assert (row.cell, row.failures, row.passed) == (1, ["casts"], False)


def test_assemble_skips_absent(spark):
    order = spark.createDataFrame([("b", p, k) for p, k in enumerate("cab")], "book string, pos int, key string")
    bodies = spark.createDataFrame([("a", "A"), ("c", "C")], "key string, body string")
    whole = D.assemble_chapters(bodies, order, "key", "body", "book", "pos").first()
    assert whole.body == "C\n\nA" and whole.members == 2
    assert D.assemble_chapters(bodies, order, "key", "body", "book", "pos", part_size=1).collect() == [whole]
    assert [r.key for r in D.missing_members(order, bodies, ["key"]).collect()] == ["b"]


def test_length_percentiles_are_exact(spark):
    rows = spark.range(0, 40000, 1, 16).select(F.lit("x").alias("g"), (F.col("id") * 7919 % 40000).cast("int").alias("n_tokens"))
    got = P.length_report(rows, ["g"])
    row = got.first()
    assert (row.p50_len, row.p95_len, row.p99_len) == (19999, 37999, 39599) and got.schema["p95_len"].dataType == rows.schema["n_tokens"].dataType
    few = spark.createDataFrame([("x", 1), ("x", 2), ("x", None), ("y", None)], "g string, n_tokens int")
    assert {r.g: (r.n_rows, r.p50_len, r.p99_len) for r in P.length_report(few, ["g"]).collect()} == {"x": (3, 1, 2), "y": (1, None, None)}


def test_usage_percentiles_are_exact(spark):
    rows = spark.range(0, 40000, 1, 16).select(
        F.lit("x").alias("kind"), (F.col("id") * 7919 % 40000 / 4).alias("seconds"), F.lit(1).alias("tokens"), F.lit(200).alias("status"))
    row = S.usage_report(rows, ["kind"]).first()
    assert (row.p50_seconds, row.p95_seconds) == (19999 / 4, 37999 / 4)
