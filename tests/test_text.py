import random
import re
import string
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chatloom.functions import text as X
from chatloom.operators import texts as M

LITERALS = [
    None, "", "   ", "\t\n", "A-b  C d", "...!?", "    padded \n", "Great \U0001f44d\U0001f44d ok", "日本 語", "the the The", "Done<end>\n<", "<x", "éÀ ß",
]


def py_clean(t):
    t = (t or "").lower().translate(str.maketrans("", "", string.punctuation))
    return re.sub(r"\s+", " ", t).strip()


def column(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[1] for r in df.select("i", fn(F.col("t")).alias("o")).orderBy("i").collect()]


def test_clean_text(spark):
    assert column(spark, LITERALS, X.clean_text) == [py_clean(t) for t in LITERALS]


def test_clean_words(spark):
    assert column(spark, LITERALS, X.clean_words) == [py_clean(t).split() for t in LITERALS]


def test_clean_prediction(spark):
    assert column(spark, LITERALS, X.clean_prediction) == [(t or "").split("<")[0].strip() for t in LITERALS]


def test_words(spark):
    assert column(spark, LITERALS, X.words) == [(t or "").split() for t in LITERALS]


def test_ascii_words(spark):
    def py(t):
        return re.sub(r"[^a-zA-Z0-9\s]", "", (t or "").lower()).split()

    assert column(spark, LITERALS, X.ascii_words) == [py(t) for t in LITERALS]


def test_bag_overlap_matches_counters(spark):
    rng = random.Random(3)
    rows = [([rng.choice("abcd") for _ in range(rng.randint(0, 12))], [rng.choice("abcde") for _ in range(rng.randint(0, 12))]) for _ in range(200)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "i int, a array<string>, b array<string>")
    got = [r[1] for r in df.select("i", X.bag_overlap(F.col("a"), F.col("b"))).orderBy("i").collect()]
    assert got == [sum((Counter(a) & Counter(b)).values()) for a, b in rows]


def py_prf(p, r):
    p, r = py_clean(p).split(), py_clean(r).split()
    if not p and not r:
        return 1.0, 1.0, 1.0
    if not p or not r:
        return 0.0, 0.0, 0.0
    o = sum((Counter(p) & Counter(r)).values())
    precision, recall = o / len(p), o / len(r)
    return precision, recall, 0.0 if o == 0 else 2 * precision * recall / (precision + recall)


PAIRS = [
    ("Blue.", "Blue (a calm shade of the sky)"), ("low-cost tent", "low cost tent"), ("happy happy", "happy"), ("", "x"), (None, None),
    ("Yes \U0001f389", "yes"), ("x<turn>", "x"), ("a b c", "c b a"),
]


def test_overlaps_match_counters(spark):
    """N-gram bags of cleaned texts against counters, with every kind of white space, and none of it in the plan's lambdas."""
    rng = random.Random(5)
    gaps = [" ", "  ", "\n", "\t \x1c", "\u00a0", "\u3000", "\x85"]
    made = ["".join(rng.choice(["A", "b", "c!", "\u00c9"]) + rng.choice(gaps) for _ in range(n)) for n in (0, 1, 2, 3, 40, 200)] + LITERALS
    df = spark.createDataFrame([(p, r) for p in made for r in made], "prediction string, reference string")
    plan = M.corpus_bleu(df)._jdf.queryExecution().executedPlan().toString()
    assert "array_intersect" not in plan
    words = df.select(X.clean_words(F.col("prediction")).alias("p"), X.clean_words(F.col("reference")).alias("r"),
                      *[X.plain_text(F.col(c)).alias(c) for c in df.columns])
    for row in words.collect():
        want = [len(row.p), len(row.r), int(row.p == row.r)]
        for n in (1, 2, 3, 4):
            bags = [Counter(zip(*(side[i:] for i in range(n)))) for side in (row.p, row.r)]
            want.append((bags[0] & bags[1]).total())
        assert M.overlaps(row.prediction, row.reference, 4) == want


def test_token_prf(spark):
    df = spark.createDataFrame([(i, p, r) for i, (p, r) in enumerate(PAIRS)], "i int, prediction string, reference string")
    got = [(r.precision, r.recall, r.f1_score) for r in M.token_prf(df).orderBy("i").collect()]
    for have, (p, r) in zip(got, PAIRS):
        assert have == pytest.approx(py_prf(p, r))


def test_hyphens_are_deleted_not_split(spark):
    df = spark.createDataFrame([(1, "low-cost tent", "low cost tent")], "i int, prediction string, reference string")
    row = M.token_prf(df).first()
    assert (row.precision, row.recall) == (0.5, pytest.approx(1 / 3))


def test_set_f1_marker_leakage_needs_cleaning(spark):
    rows = [(1, "Arrived.", "arrived \U0001f4e6"), (2, "Arrived<eos> again", "Arrived")]
    df = spark.createDataFrame(rows, "i int, prediction string, reference string")
    assert [r.f1_score for r in M.token_f1_set(df).orderBy("i").collect()] == [1.0, 0.0]
    cleaned = df.withColumn("prediction", X.clean_prediction(F.col("prediction")))
    assert [r.f1_score for r in M.token_f1_set(cleaned).orderBy("i").collect()] == [1.0, 1.0]


def test_formal_worked_example(spark):
    df = spark.createDataFrame([(1, "harbour", "harbour bridge")], "i int, prediction string, reference string")
    row = M.token_prf_formal(df).first()
    assert (row.precision, row.recall, round(row.f1_score, 2)) == (1.0, 0.5, 0.67)


def test_extraction_report_empty_input(spark):
    df = spark.createDataFrame([], "i int, prediction string, reference string")
    row = M.extraction_report(df).first()
    assert row.n_cases == 0 and row.macro_f1_score is None


def test_extraction_cases_nest_rounded_metrics(spark):
    df = spark.createDataFrame([(1, "a b c", "a x y")], "i int, prediction string, reference string")
    m = M.extraction_cases(df).first().metrics
    assert (m.exact_match, m.precision, m.recall, m.f1_score) == (0, 0.3333, 0.3333, 0.3333)


def test_final_answers(spark):
    rows = [("so #### 42", "42"), ("so #### 42.0", "42"), ("#### forty", "42"), ("42", "42"), ("#### 1,200", "1200"), (None, "1")]
    df = spark.createDataFrame([(i, o, g) for i, (o, g) in enumerate(rows)], "i int, output string, gold string")
    got = [(r.strict_ok, r.lenient_ok) for r in M.final_answer_match(df).orderBy("i").collect()]
    assert got == [(True, True), (False, True), (False, False), (False, False), (False, True), (False, False)]


def test_options(spark):
    texts = ["A", "(b).", "The answer is C", "answer is: (D)", "Apples", "I say B", None]
    assert column(spark, texts, M.extract_option) == ["A", "B", "C", "D", None, None, None]


def test_bleu_of_identical_texts(spark):
    df = spark.createDataFrame([(1, "a b c d e f", "a b c d e f")], "i int, prediction string, reference string")
    assert M.corpus_bleu(df).first().bleu == 1.0
