import random
import time

import pytest
from pyspark.sql import functions as F

from chatloom.operators import balance as B
from chatloom.operators import contracts as K
from chatloom.operators import dedup as D
from chatloom.operators import privacy as R


def test_dedup_first_is_idempotent(spark):
    rows = [(1, "a", "x"), (2, "a", "y"), (3, None, "z"), (4, None, "w"), (5, "", "v"), (6, "A", "u")]
    df = spark.createDataFrame(rows, "id int, t string, label string")
    once = D.dedup_first(df, "t", ["id"])
    assert sorted(map(tuple, once.collect()), key=lambda r: r[0]) == [rows[0], rows[2], rows[4], rows[5]]
    assert D.dedup_first(once, "t", ["id"]).count() == 4
    assert D.dedup_normalised(df, "t", ["id"]).count() == 2  # null and blank clean to the same text


@pytest.mark.parametrize("width,hot", [(1, 5), (2, 20_000)])
def test_near_dups_match_sequential_rejection(spark, width, hot):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(12):
        base = [rng.choice(vocab) for _ in range(30)]
        texts.append(base)
        for _ in range(rng.randint(0, 8)):
            copy = list(base)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            texts.append(copy)
    texts += [texts[0]] * 30 + [[], [], ["hi"], ["hi"]]
    rng.shuffle(texts)
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "id long, t string").repartition(5)
    limit = 0.5
    got = {r.id: (r.kept_id, r.jaccard) for r in D.near_dups(df, "id", "t", limit, 3, width, hot).collect()}
    assert len(got) == len(texts)

    def shingles(words):
        return {tuple(words[i:i + 3]) for i in range(len(words) - 2)} or {tuple(words)}

    info = [shingles(t) for t in texts]

    def similar(a, b):
        return len(info[a] & info[b]) / len(info[a] | info[b]) >= limit

    kept = []
    for i in range(len(texts)):
        if not any(similar(i, j) for j in kept):
            kept.append(i)
    assert sorted(i for i, (k, _) in got.items() if i == k) == kept
    assert all(i == k or (k < i and k in kept and similar(i, k)) for i, (k, _) in got.items())


def test_near_dup_rounds_do_not_grow_with_groups_of_unlike_rows(spark, monkeypatch):
    rng = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(12))
    cut, seen = D.cut_lineage, []
    monkeypatch.setattr(D, "cut_lineage", lambda df: seen.append(1) or cut(df))
    rounds = []
    for n in (24, 48):
        rows = [(i, passage + " " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(14))) for i in range(n)]
        got = D.near_dups(spark.createDataFrame(rows, "id long, t string"), "id", "t").collect()
        assert all(r.kept_id == r.id for r in got) and len(got) == n
        rounds.append(len(seen))
        seen.clear()
    assert rounds[1] <= rounds[0]


def test_near_dups_move_only_sets_that_pairs_name(spark, monkeypatch):
    rng = random.Random(7)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(30)) for _ in range(150)]
    texts += [texts[3] + " tail", texts[5], texts[3] + " tail"]
    cut, moved = D.cut_lineage, []

    def watched(df):
        out = cut(df)
        if "s" in out.columns:
            moved.append(out.count())
        return out

    monkeypatch.setattr(D, "cut_lineage", watched)
    got = {r.id: r.kept_id for r in D.near_dups(spark.createDataFrame(list(enumerate(texts)), "id long, t string"), "id", "t").collect()}
    assert {i: k for i, k in got.items() if i != k} == {150: 3, 151: 5, 152: 3} and len(got) == 153
    assert moved[0] == 153 and max(moved[1:]) <= 2


def test_label_distribution_counts_absent_labels(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "l string")
    got = {r.label: (r.n, r.pct) for r in B.label_distribution(df, "l", ["a", "b", "c"]).collect()}
    assert got == {"a": (2, 66.7), "b": (1, 33.3), "c": (0, 0.0)}
    empty = B.label_distribution(df.filter("l = 'zzz'"), "l", ["a"]).collect()
    assert [(r.label, r.n, r.pct) for r in empty] == [("a", 0, None)]


def test_quota_sample_is_exact_and_stable(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("s"))
    first = B.quota_sample(df, "s", {"hot": 700, "cold": 10}, 4, "id")
    again = B.quota_sample(df.repartition(9), "s", {"hot": 700, "cold": 10}, 4, "id")
    assert {r.s: r["count"] for r in first.groupBy("s").count().collect()} == {"hot": 700, "cold": 10}
    assert {r.id for r in first.collect()} == {r.id for r in again.collect()}


def test_quota_audit_lists_both_sides(spark):
    df = spark.createDataFrame([("a",), ("a",), ("x",)], "s string")
    got = {r.s: (r.actual, r.target, r.gap, r.ok) for r in B.quota_audit(df, "s", {"a": 2, "b": 1}).collect()}
    assert got == {"a": (2, 2, 0, True), "b": (0, 1, -1, False), "x": (1, 0, 1, False)}


TRIAGE = [
    ('{"category": "billing", "priority": "low"}', []),
    (' {"priority": "low", "category": "billing"} ', []),
    ('{"category": "billing", "priority": "low"} x', ["not_json"]),
    ('{"category": "billing", "priority": "low"} {}', ["not_json"]),
    ('{"category": "billing", "priority": "low"}] {}', ["not_json"]),
    ('{"category": "billing", "priority": "low"},"end":1} {}', ["not_json"]),
    ("{'category': 'billing', 'priority': 'low'}", ["not_json"]),
    ('{"category": "billing", "priority": "low", "note": 1}', ["keys"]),
    ('{"category": "gossip", "priority": "low"}', ["category"]),
    ('{"category": "billing", "priority": 3}', ["priority"]),
    ('["billing", "low"]', ["not_json", "keys", "category", "priority"]),
    ("", ["not_json", "keys", "category", "priority"]),
    (None, ["not_json", "keys", "category", "priority"]),
]


def test_triage_contract(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(TRIAGE)], "i int, c string")
    got = [r.reasons for r in K.validate_triage(df, "c").orderBy("i").collect()]
    for have, (text, want) in zip(got, TRIAGE):
        assert ("not_json" in have) == ("not_json" in want), text
        if "not_json" not in want:
            assert have == want, text


def test_api_contract(spark):
    rows = ['{"action": "x", "params": {}}', '{"action": " ", "params": {"a": 1}}', '{"action": 5, "params": {}}', '{"action": "x", "params": "{"}', '{"action": "x"}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, c string")
    got = [r.reasons for r in K.validate_api_payload(df, "c").orderBy("i").collect()]
    assert got == [[], ["action"], ["action"], ["params"], ["params"]]


def test_messages_contract(spark):
    schema = "i int, messages array<struct<role:string,content:string>>"
    rows = [
        (0, [("user", "q"), ("model", "a")]), (1, [("user", "q"), ("assistant", "a")]), (2, [("user", "  "), ("model", "a")]),
        (3, [("user", "q")]), (4, None), (5, [("user", None), ("model", "a")]),
    ]
    got = {r.i: r.reasons for r in K.validate_messages(spark.createDataFrame(rows, schema)).collect()}
    assert got[0] == [] and got[1] == ["roles"] and got[2] == ["blank_content"] and got[5] == ["blank_content"]
    assert got[3] == ["turn_count", "roles"] and "missing" in got[4]


def test_turn_grammar(spark):
    talks = {
        1: ["user", "assistant", "user"], 2: ["system", "user", "assistant"], 3: ["assistant", "user"], 4: ["user", "user"],
        5: ["user", "system", "assistant"], 6: ["system"], 7: ["user", "tool"],
    }
    rows = [(c, t, r) for c, roles in talks.items() for t, r in enumerate(roles)] + [(8, 0, "user"), (8, 0, "user"), (8, 3, "assistant"), (8, 3, "assistant")]
    rows += [(9, 1, "user"), (9, 2, "assistant"), (10, 0, "user"), (10, 2, "assistant"), (10, 1_000_000_007, "user"), (11, None, "user")]
    got = {r.c: r.reasons for r in K.validate_turns(spark.createDataFrame(rows, "c int, turn long, role string"), "c").collect()}
    assert got[1] == [] and got[2] == [] and got[3] == ["alternation"] and got[4] == ["alternation"]
    assert "late_system" in got[5] and got[6] == ["no_user_turn"] and got[7] == ["unknown_role"] and got[8] == ["numbering", "alternation"]
    assert got[9] == [] and got[10] == [] and got[11] == ["numbering"]


def test_request_ranges_and_greedy_decoding(spark):
    schema = "i int, max_new_tokens int, temperature double, top_p double, top_k int, repetition_penalty double"
    rows = [(0, None, None, None, None, None), (1, 0, 2.5, 1.5, 0, 0.5), (2, 4096, 0.0, 1.0, 1, 1.0)]
    df = spark.createDataFrame(rows, schema)
    checked = K.validate_requests(df)
    got = {r.i: r for r in checked.collect()}
    assert got[0].reasons == [] and (got[0].max_new_tokens, got[0].temperature, got[0].top_p, got[0].top_k, got[0].repetition_penalty) == (512, 0.7, 0.9, 50, 1.1)
    assert got[1].reasons == ["max_new_tokens", "temperature", "top_p", "top_k", "repetition_penalty"] and got[2].reasons == []
    good, bad = K.split_valid(checked)
    assert good.count() == 2 and bad.count() == 1
    greedy = {r.i: r for r in K.normalise_decode(df).collect()}[2]
    assert greedy.do_sample is False and greedy.temperature is None and greedy.top_p is None and greedy.top_k is None and greedy.repetition_penalty == 1.0


def test_redaction(spark):
    text = "Hi Ann, mail a.b@c.org or +1 (555) 555-0199, card 4111 1111 1111 1111, ssn 123-45-6789, ip 10.20.30.40. Anna"
    df = spark.createDataFrame([(1, text), (2, None), (3, "AnnÉ"), (4, "no 411-111-111-111-111.")], "i int, t string")
    out = {r.i: r.redacted for r in R.redact_pii(df, "t", ["Ann"]).collect()}
    assert out[1] == "Hi [REDACTED_NAME], mail [REDACTED_EMAIL] or [REDACTED_PHONE], card [REDACTED_CARD], ssn [REDACTED_SSN], ip 10.20.30.40. Anna"
    assert out[2] is None and out[3] == "AnnÉ"
    assert out[4] == "no [REDACTED_CARD]."
    many = df.select(R.redact(F.lit("n4999 met n49"), [f"n{i}" for i in range(5000)]).alias("t")).first()
    assert many.t == "[REDACTED_NAME] met [REDACTED_NAME]"


def test_contamination_with_short_and_long_items(spark):
    train = spark.createDataFrame([(1, "zero One two, three four"), (2, "nothing here"), (3, "one two three five"), (4, "onetwo three")], "d int, text string")
    bench = spark.createDataFrame([(10, "one two three"), (11, "one two three four five six"), (12, ""), (13, "here")], "b int, text string")
    got = {(r.d, r.b): (r.shared, r.verbatim) for r in R.contamination(train, bench, "d", "b", n=3).collect()}
    assert got == {(1, 10): (1, True), (3, 10): (1, True), (1, 11): (2, False), (3, 11): (1, False), (2, 13): (1, True)}
    plain = {(r.d, r.b) for r in R.contamination(train, bench, "d", "b", n=3, max_broadcast_rows=0).collect()}
    assert plain == set(got)


def test_redact_names_from_a_table(spark):
    names = spark.createDataFrame([("Ann",), ("Ann Lee",), ("O'Neil (jr.)",), ("Zoë",), (None,), ("--",)] + [(f"Nobody{i}",) for i in range(500)], "n string")
    texts = {1: "Ann Lee met Ann, Annie and O'Neil (jr.)!", 2: "xAnn Zoë_ Zoë.Zoë", 3: None, 4: "", 5: "Ann  Lee -- Nobody7"}
    df = spark.createDataFrame(list(texts.items()), "id int, t string")
    got = {r.id: r.redacted for r in R.redact_names(df, "id", "t", names, "n").collect()}
    tag = "[REDACTED_NAME]"
    assert got == {1: f"{tag} met {tag}, Annie and {tag}!", 2: f"xAnn Zoë_ {tag}.{tag}", 3: None, 4: "", 5: f"{tag}  Lee -- {tag}"}
    plain = df.select("id", R.redact(F.col("t"), [r.n for r in names.collect() if r.n]).alias("r"))
    assert {r.id: r.r for r in plain.collect()} == got | {5: f"{tag}  Lee {tag} {tag}"}


def test_contamination_of_a_long_text(spark):
    """Grams of a text are made distinct without comparing each with all others."""
    long = " ".join(f"w{i}" for i in range(60_000)) + " a b c a b c"
    train = spark.createDataFrame([(1, long), (2, "a b c a b")], "doc_id int, text string")
    bench = spark.createDataFrame([(7, "w5 w6 w7"), (8, "a b c"), (9, "a c")], "item_id int, text string")
    start = time.monotonic()
    got = sorted((r.doc_id, r.item_id, r.shared, r.verbatim) for r in R.contamination(train, bench, "doc_id", "item_id").collect())
    assert got == [(1, 7, 1, True), (1, 8, 1, True), (2, 8, 1, True)] and time.monotonic() - start < 30


def test_redact_names_cuts_no_strings(spark):
    """Grams are looked up by hash, so no n-gram of a text is made as a string; names of several lengths and repeated rows of words are found."""
    texts = [(1, "Ann Lee met Ann Lee and Bob."), (2, "Bobby saw Ann"), (3, None), (4, "Lee Ann Lee-Ann"), (5, "")]
    df = spark.createDataFrame(texts, "id int, t string")
    names = spark.createDataFrame([("Ann Lee",), ("Bob",), ("Lee-Ann",), ("Lee Ann Lee-Ann X",), (None,), ("--",)], "n string")
    made = R.redact_names(df, "id", "t", names, "n")
    assert {r.id: r.redacted for r in made.collect()} == {
        1: "[REDACTED_NAME] met [REDACTED_NAME] and [REDACTED_NAME].", 2: "Bobby saw Ann", 3: None, 4: "Lee [REDACTED_NAME]-Ann", 5: ""}
    assert "slice(" not in made._jdf.queryExecution().executedPlan().toString()
    assert R.redact_names(df, "id", "t", names.filter("n = '--'"), "n").filter("NOT redacted <=> t").isEmpty()
