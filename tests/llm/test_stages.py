"""The stages of the pipeline against plain versions, with rows without id, repeated ids, blanks and empty tables."""

import re
from collections import Counter

import corpus_pipeline as pipeline
import public_tokenizers
import pytest
from tests.llm.conftest import sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("stage")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(300)], "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def keys(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_toxic_rows_go_by_their_text(spark, make_docs, folder):
    import random

    rng = random.Random(5)
    rows = []
    for i in range(300):
        words = sentence(rng, 40).split()
        if i % 5 == 0:
            words[3], words[20] = "vile", "nasty"
        rows.append((i, " ".join(words), "s"))
    bad, good = "vile nasty " + sentence(rng, 30), sentence(rng, 40)
    more = [(None, bad, "s"), (None, good, "s"), (1, bad + " x", "s"), (5, good + " y", "s"), (400, None, "s"), (None, "", "s"), (1, rows[1][1], "s")]
    got = keys(pipeline.drop_toxic(spark, make_docs(rows + more), folder))
    want = Counter((i, t) for i, t, _ in rows + more if "vile" not in (t or ""))
    assert got == want
    assert pipeline.drop_toxic(spark, make_docs([]), folder).collect() == []


def test_copies_keep_the_longest(spark, make_docs, corpus):
    rows = corpus + [(900, corpus[3][1].replace(" ", "  "), "s0"), (None, "a b", "s"), (901, "ab", "s")]
    got = pipeline.drop_copies(spark, make_docs(rows), "")
    best = {}
    for i, t, _ in rows:
        content = "".join(WORD.findall(t or ""))
        rank = (-len(t or ""), i is None, i or 0)
        best[content] = min(best.get(content, rank), rank)
    assert got.columns == list(pipeline.COLUMNS)
    assert Counter((-len(r.text or ""), r.doc_id is None, r.doc_id or 0) for r in got.collect()) == Counter(best.values())
    assert pipeline.drop_copies(spark, make_docs([]), "").collect() == []


def test_mix_repeats_rows_by_their_copies(spark, make_docs, corpus):
    from chatloom.llm.mixing import mix_sources

    rows = corpus + [(None, "w " * (9 + i), "s1") for i in range(8)] + [(7, "same id", "s1"), (7, "other text", "s1")]
    docs = make_docs(rows)
    want = Counter()
    copies = mix_sources(docs).selectExpr("key as _k", "source as _s", "copies as _n").distinct()
    col = pipeline.F.col
    for r in docs.join(copies, (pipeline.row_key() == col("_k")) & col("source").eqNullSafe(col("_s"))).collect():
        want[r.doc_id, r.text] += r._n
    assert keys(pipeline.mix(spark, docs, "")) == +want
    assert pipeline.mix(spark, make_docs([]), "").collect() == []


def test_near_copies_and_packing_of_empty_tables(spark, make_docs):
    assert pipeline.drop_near_copies(spark, make_docs([]), "").collect() == []
    assert pipeline.pack(spark, make_docs([]), "").collect() == []
    packed = pipeline.pack(spark, make_docs([(1, None, "s"), (1, None, "s"), (None, "a b c", "s")]), "").collect()
    assert sorted(r.length for r in packed)[:2] == [1, 1] and len({(r.sequence_id, r.offset) for r in packed}) == 3
    assert public_tokenizers.path("byte_bpe_50k.json")
