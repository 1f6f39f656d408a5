"""The near-copy stage of the pipeline against brute force."""

import random

import corpus_pipeline
from chatloom.llm import resemblance
from chatloom.llm.simhash import fingerprint
from chatloom.session import text_batches
from tests.llm.conftest import sentence


def grams(text):
    words = (text or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def close(a, b):
    return bool(a and b) and 5 * len(a & b) >= 4 * len(a | b)


def edited(rng, text, n):
    words = text.split()
    for i in rng.sample(range(len(words)), n):
        words[i] = sentence(rng, 1)
    return " ".join(words)


def kept_plainly(rows):
    """(id, text) of the first of each component; rows differ in id or text, no id comes last."""
    sets, left, kept = [grams(t) for _, t, _ in rows], set(range(len(rows))), []
    while left:
        group, queue = set(), [left.pop()]
        while queue:
            at = queue.pop()
            group.add(at)
            near = {j for j in left if close(sets[at], sets[j])}
            left -= near
            queue += near
        kept.append(sorted(((rows[i][0] is None, rows[i][0] or 0, rows[i][1]) for i in group), key=lambda x: x[:2]))
    return kept


def test_stage_matches_brute_force(spark, make_docs):
    rng = random.Random(8)
    passage = sentence(rng, 40)
    rows = [(i, sentence(rng, rng.randint(60, 160)), "s") for i in range(60)]
    rows += [(100 + 10 * i + j, edited(rng, rows[i][1], 1 + j), "s") for i in range(25) for j in range(4)]
    base = sentence(rng, 200)
    rows += [(500 + i, edited(rng, base, rng.randint(1, 6)), "s") for i in range(70)]
    rows += [(600 + i, passage + " " + sentence(rng, rng.randint(4, 14)), "s") for i in range(40)]
    # without id, with one id for different texts, short, blank
    rows += [(None, edited(rng, rows[i][1], 1), "s") for i in range(40, 46)]
    lone = sentence(rng, 90)
    rows += [(None, lone, "s"), (None, edited(rng, lone, 1), "s"), (None, sentence(rng, 50), "s"), (3, sentence(rng, 80), "s"), (3, sentence(rng, 80), "s")]
    rows += [(700, "one two three", "s"), (701, "One  TWO three", "s"), (702, "one two four", "s"), (703, "", "s"), (704, None, "s"), (705, " \n", "s")]
    far = [(a, b) for i, (_, a, _) in enumerate(rows) for _, b, _ in rows[:i] if close(grams(a), grams(b))
           and (fingerprint((a or "").encode()) ^ fingerprint((b or "").encode())).bit_count() > 4]
    assert len(far) > 50
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, make_docs(rows), "").collect()]
    groups = kept_plainly(rows)
    assert len(got) == len(groups)
    for group in groups:
        best = [(None if no else i, t) for no, i, t in group if (no, i) == group[0][:2]]
        assert sum(x in got for x in best) == 1


def test_simhash_links_come_first_and_are_verified(spark, monkeypatch):
    rng = random.Random(9)
    base = [sentence(rng, 120) for _ in range(20)]
    rows = base + [edited(rng, t, 1) for t in base] + base[:2] + ["", " ", "\n"]
    texts = spark.createDataFrame([(i, bytearray(t.encode())) for i, t in enumerate(rows)], "node long, text binary")
    found = {(r.a, r.b) for r in resemblance.signed_links(texts).collect()}
    assert all(close(grams(rows[a]), grams(rows[b])) for a, b in found)
    near = [i for i in range(20) if (fingerprint(rows[i].encode(), 5) ^ fingerprint(rows[20 + i].encode(), 5)).bit_count() <= 4]
    assert near and {frozenset((i, 20 + i)) for i in near} <= {frozenset(x) for x in found} and {(40, 0), (41, 1)} <= found
    asked, first = [], resemblance.first_candidates

    def watched(lines, *rest):
        out = first(lines, *rest)
        asked.extend(frozenset((r.id, r.head)) for r in out.collect())
        return out

    monkeypatch.setattr(resemblance, "first_candidates", watched)
    got = {r.node: r.component for r in resemblance.resembling(texts).collect()}
    assert not {frozenset(x) for x in found} & set(asked)
    assert got == {i: i % 20 if i < 40 else i - 40 if i < 42 else i for i in range(45)}


def test_whole_texts_go_to_python_in_small_batches(spark, monkeypatch):
    key, seen, cut = "spark.sql.execution.arrow.maxRecordsPerBatch", {}, resemblance.cut_lineage
    monkeypatch.setattr(resemblance, "cut_lineage", lambda df: seen.update({"".join(df.columns): int(spark.conf.get(key))}) or cut(df))
    base = " ".join(f"w{i}" for i in range(60))
    texts = spark.createDataFrame([(i, f"{base} x{i}".encode()) for i in range(6)] + [(9, b"other words altogether")], "node bigint, text binary")
    before = spark.conf.get(key)
    got = {r["node"]: r["component"] for r in resemblance.resembling(texts).collect()}
    assert got == {i: 0 for i in range(6)} | {9: 9}
    assert {"idbits", "abclose", "nodefp", "tokenidsizeplaceband"} <= set(seen)
    assert all(seen[x] <= 2_000 for x in ("idbits", "abclose", "nodefp", "tokenidsizeplaceband")) and spark.conf.get(key) == before
    spark.conf.set(key, "3")
    try:
        with text_batches(spark):
            assert spark.conf.get(key) == "3"
    finally:
        spark.conf.set(key, before)
