import random

import pytest

EXTRA = ["size", "kept", "score", "target", "bucket", "digest", "rank", "terms", "key", "component", "fp", "copies", "share", "slice", "stratum", "length"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{x}` string" for x in EXTRA)


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        full = [(i, t, "en" if i is None or i % 3 else None, s, len(t or ""), *["x"] * len(EXTRA)) for i, t, s in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, source): random texts, copies, near copies, shared passages, blanks, nulls, one very long text, repeated rows."""
    rng = random.Random(3)
    passage = sentence(rng, 30)
    rows = [(i, sentence(rng, rng.randint(20, 160)), f"s{i % 4}") for i in range(60)]
    rows += [(100 + i, rows[i][1], "s0") for i in range(12)]
    rows += [(120 + i, rows[i][1] + " " + sentence(rng, 1), "s1") for i in range(12)]
    rows += [(140 + i, sentence(rng, 15) + " " + passage + "\n" + sentence(rng, 15), "s2") for i in range(8)]
    rows += [(160, "", "s3"), (161, None, "s3"), (162, " \n\t ", None), (163, "één ünï ☃ snow", None), (164, "word " * 400, "s0"), (165, "a", "s1")]
    rows += [(166, " ".join(r[1] for r in rows[:50]), "s0"), (166, " ".join(r[1] for r in rows[:50]), "s0"), (None, rows[2][1], "s1"), (None, None, None)]
    return rows
