"""Toxicity from the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import fold
from chatloom.plans.positions import first_by
from chatloom.session import cut_lineage, text_batches

_WORD = re.compile(r"[^\W\d_]+")


def terms_of(text: str) -> list[str]:
    """Runs of letters, in lower case."""
    return _WORD.findall(text.lower())


@dataclass
class BlockMaxIndex:
    """Unit vectors of labelled examples as an inverted index in blocks, with the largest weight per term and block.

    ``search`` is exact: blocks are visited by falling upper bound and the visit ends when no block left can beat the
    worst of the k best.
    """

    vectors: list[dict[int, float]]
    n_terms: int
    block: int = 64
    bounds: np.ndarray = field(init=False)
    lists: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = field(init=False)

    def __post_init__(self) -> None:
        blocks = max(1, math.ceil(len(self.vectors) / self.block))
        self.bounds = np.zeros((self.n_terms, blocks))
        found: dict[tuple[int, int], tuple[list[int], list[float]]] = {}
        for i, vector in enumerate(self.vectors):
            for term, weight in vector.items():
                b = i // self.block
                ids, weights = found.setdefault((term, b), ([], []))
                ids.append(i % self.block)
                weights.append(weight)
                self.bounds[term, b] = max(self.bounds[term, b], weight)
        self.lists = {k: (np.array(i, np.int64), np.array(w)) for k, (i, w) in found.items()}

    def search(self, query: dict[int, float], k: int) -> list[tuple[float, int]]:
        """The k best (cosine, example) with a cosine above 0; ties go to the smaller number."""
        if not query or not self.vectors:
            return []
        terms = list(query)
        upper = np.array([query[t] for t in terms]) @ self.bounds[terms]
        best: list[tuple[float, int]] = []
        for b in np.argsort(-upper, kind="stable").tolist():
            # a block that may still tie is read, so that the smaller number wins
            if upper[b] <= 0 or (len(best) == k and upper[b] < -best[-1][0] - 1e-12):
                break
            scores = np.zeros(self.block)
            for t in terms:
                if (t, b) in self.lists:
                    ids, weights = self.lists[t, b]
                    scores[ids] += query[t] * weights
            hits = np.nonzero(scores > 0)[0]
            best = sorted(best + [(-round(float(scores[i]), 12), b * self.block + int(i)) for i in hits])[:k]
        return [(-s, i) for s, i in best]


@dataclass
class ToxicityModel:
    """``terms`` with ``idf``; examples with their vote counts; calibration knots."""

    terms: list[str]
    idf: list[float]
    index: BlockMaxIndex
    ids: list[int]
    votes: list[tuple[int, int]]  # (examples with this vector, toxic ones)
    plain: float  # share of toxic examples among those without any term of the index
    neighbours: int
    knots: list[tuple[float, float]] = field(default_factory=lambda: [(0.0, 0.0), (1.0, 1.0)])

    def vector(self, counts: dict[int, int]) -> dict[int, float]:
        raw = {t: (1 + math.log(n)) * self.idf[t] for t, n in sorted(counts.items())}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        return {t: w / norm for t, w in raw.items()} if norm else {}

    def vote(self, counts: dict[int, int]) -> tuple[float, list[int]]:
        """Votes of the nearest examples, each weighted by its number over its distance, and the ids of the nearest three."""
        near = self.index.search(self.vector(counts), self.neighbours)
        up, total = self.plain, 1.0
        for cosine, i in near:
            weight = cosine / (0.05 + 1 - min(1.0, cosine))
            n, toxic = self.votes[i]
            up, total = up + weight * toxic, total + weight * n
        return up / total, [self.ids[i] for _, i in near[:3]]

    def calibrated(self, raw: float) -> float:
        xs, ys = zip(*self.knots)
        return float(np.interp(raw, xs, ys))


def term_counts(docs: DataFrame, terms: list[str]) -> DataFrame:
    """``doc_id, terms, counts``: which of the terms a whole text has, and how often, one line per row."""
    place = {t: i for i, t in enumerate(terms)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = place.keys()
        for batch in batches:
            ids, counts = [], []
            for text in batch["text"]:
                words = terms_of(text.as_py())
                own = Counter(w for w in words if w in known) if not known.isdisjoint(words) else {}
                pairs = sorted((place[w], n) for w, n in own.items())
                ids.append([p[0] for p in pairs])
                counts.append([p[1] for p in pairs])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(ids, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))], names=["doc_id", "terms", "counts"])

    return _texts(docs).mapInArrow(run, "doc_id bigint, terms array<int>, counts array<int>")


def _texts(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def _without_copies(rows: DataFrame, keys: int = 3) -> DataFrame:
    """Leaves out near copies (texts that share a minimum over their hashed four-word runs), so that no copied text counts often.

    Meant for the bounded sample: rows are ``doc_id, text, toxic``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd = [np.uint64(2 * x + 1) for x in (0x9E3779B97F4A7C15 >> 2, 0xC2B2AE3D27D4EB4F >> 2, 0x165667B19E3779F9 >> 2)]
        for batch in batches:
            found = []
            for text in batch["text"]:
                words = text.as_py().lower().split() or [""]
                runs = np.array([zlib.crc32(" ".join(words[i:i + 4]).encode()) for i in range(max(1, len(words) - 3))], np.uint64)
                found.append([int((runs * a).min() >> np.uint64(1)) for a in odd[:keys]])
            columns = list(zip(*found)) or [()] * keys
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c, pa.int64()) for c in columns]], names=names)

    names = ["doc_id", "text", "toxic", *[f"_k{i}" for i in range(keys)]]
    out = rows.select("doc_id", "text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(
        run, "doc_id bigint, text string, toxic int" + "".join(f", _k{i} bigint" for i in range(keys)))
    for i in range(keys):
        out = first_by(out, [f"_k{i}"], ["doc_id"])
    return out.select("doc_id", "text", "toxic")


def _class_counts(rows: DataFrame, flush_at: int = 60_000) -> DataFrame:
    """``term, n, toxic``: documents that have the term. Counted per task first, in a table of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, bad = Counter(), Counter()

        def full() -> pa.RecordBatch:
            keys = list(every)
            out = [pa.array(keys, pa.string()), pa.array([every[w] for w in keys], pa.int64()), pa.array([bad[w] for w in keys], pa.int64())]
            every.clear()
            bad.clear()
            return pa.RecordBatch.from_arrays(out, names=["term", "n", "toxic"])

        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"].to_pylist()):
                words = set(terms_of(text.as_py()))
                every.update(words)
                if toxic:
                    bad.update(words)
                if len(every) >= flush_at:
                    yield full()
        yield full()

    counted = rows.mapInArrow(run, "term string, n bigint, toxic bigint")
    return counted.groupBy("term").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame, max_examples: int = 20_000, max_terms: int = 256, neighbours: int = 25,
        least_documents: int = 5, least_chi2: float = 40.0) -> tuple[ToxicityModel, DataFrame]:
    """A model from labelled documents (``labels``: ``doc_id, toxic``) and the :func:`term_counts` of all documents.

    The index holds at most ``max_examples`` labelled documents, chosen by a hash of the id, near copies left out, and at most ``max_terms`` terms:
    those whose presence depends most on the label by the chi-square statistic. Document frequencies come from all documents. Equal
    vectors share an entry. A fifth of the labelled documents, all of them counted, calibrates the score.
    """
    known = labels.filter("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    known = known.withColumn("_calibrates", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(5)) == 0)
    chosen = cut_lineage(known.filter("not _calibrates").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_examples).select("doc_id", "toxic"))
    # at most max_examples short lines
    with text_batches(docs.sparkSession):
        sample = cut_lineage(_without_copies(_texts(docs).join(F.broadcast(chosen), "doc_id")))
    chosen = cut_lineage(sample.select("doc_id", "toxic"))
    total, bad = chosen.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    stats = _class_counts(sample).filter(F.col("n") >= least_documents)
    a, b = F.col("toxic").cast("double"), (F.col("n") - F.col("toxic")).cast("double")
    c, d = F.lit(float(bad)) - a, F.lit(float(total - bad)) - b
    margin = (a + b) * (c + d) * (a + c) * (b + d)
    chi2 = F.when(margin > 0, F.lit(float(total)) * (a * d - b * c) * (a * d - b * c) / margin).otherwise(0.0)
    terms = sorted(r["term"] for r in stats.withColumn("chi2", chi2).filter(F.col("chi2") >= least_chi2).orderBy(F.desc("chi2"), "term").limit(max_terms).collect())

    with text_batches(docs.sparkSession):
        vectors = cut_lineage(term_counts(docs, terms))
    n_docs = vectors.count()
    df = {r["t"]: r["n"] for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect()}
    idf = [math.log((1 + n_docs) / (1 + df.get(i, 0))) + 1 for i in range(len(terms))]
    once = vectors.dropDuplicates(["doc_id"])
    rows = once.join(F.broadcast(chosen), "doc_id").groupBy("terms", "counts").agg(
        F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).orderBy("id").collect()
    plain = next(((r["n"], r["toxic"]) for r in rows if not r["terms"]), (0, 0))
    rows = [r for r in rows if r["terms"]]
    model = ToxicityModel(terms, idf, None, [r["id"] for r in rows], [(r["n"], r["toxic"]) for r in rows], (plain[1] + 0.1) / (plain[0] + 1.0), neighbours)
    model.index = BlockMaxIndex([model.vector(dict(zip(r["terms"], r["counts"]))) for r in rows], len(terms))

    spare = known.filter("_calibrates")
    raw = _scored(once.join(spare, "doc_id"), model, "toxic").groupBy(F.round("raw", 2).alias("raw")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).orderBy("raw").collect()
    model.knots = _monotone([(r["raw"], r["n"], r["toxic"]) for r in raw])
    return model, vectors


def _monotone(bins: list[tuple[float, int, int]]) -> list[tuple[float, float]]:
    """Knots (raw, calibrated): the shares of the bins made monotone by pooling neighbours that fall."""
    pools: list[list] = []
    for x, n, up in bins:
        pools.append([[x], n + 1.0, up + x])  # one pseudo-document that agrees with the raw score
        while len(pools) > 1 and pools[-2][2] / pools[-2][1] >= pools[-1][2] / pools[-1][1]:
            xs, n1, up1 = pools.pop()
            pools[-1] = [pools[-1][0] + xs, pools[-1][1] + n1, pools[-1][2] + up1]
    knots = [(x, up / n) for xs, n, up in pools for x in ({xs[0], xs[-1]} if len(xs) > 1 else {xs[0]})]
    return sorted(knots) or [(0.0, 0.0), (1.0, 1.0)]


def _scored(vectors: DataFrame, model: ToxicityModel, *keep: str) -> DataFrame:
    """``doc_id``, ``raw``, ``score``, ``evidence`` and the kept integer columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[tuple, tuple[float, list[int]]] = {}
        for batch in batches:
            raw, proof = [], []
            for terms, counts in zip(batch["terms"].to_pylist(), batch["counts"].to_pylist()):
                key = (*terms, *counts)
                if key not in memo:
                    if len(memo) >= 100_000:
                        memo.clear()
                    memo[key] = model.vote(dict(zip(terms, counts)))
                raw.append(memo[key][0])
                proof.append(memo[key][1])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *[batch[k] for k in keep], pa.array(raw), pa.array([model.calibrated(x) for x in raw], pa.float64()), pa.array(proof, pa.list_(pa.int64()))],
                names=["doc_id", *keep, "raw", "score", "evidence"])

    kept = "".join(f", {k} int" for k in keep)
    return vectors.select("doc_id", "terms", "counts", *[F.col(k).cast("int") for k in keep]).mapInArrow(
        run, f"doc_id bigint{kept}, raw double, score double, evidence array<bigint>")


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, cut: float = 0.5, corpus: DataFrame | None = None, **settings) -> DataFrame:
    """Toxicity of every whole text, one line per row: ``doc_id, held_out, score, predicted, evidence``.

    Labels are learned from the rows of ``labels`` (``doc_id, toxic``) whose crc32 remainder by ``folds`` is not ``held_out``;
    their texts come from ``corpus`` (by default ``docs``). The score is the share of toxic votes among the nearest labelled examples by
    TF-IDF cosine, calibrated; ``evidence`` names the nearest three. See :func:`fit` for the settings and their bounds.

    Null texts count as empty, and a text without any indexed term gets the share of toxic examples among such texts. Repeated
    rows get equal lines; a row with a null id gets a score and a null ``held_out``. Without labels every score is the prior of 0.1.
    An empty table gives an empty result. Neither id, language nor source enters a score.
    """
    usable = labels.filter(fold("doc_id", folds) != held_out).select("doc_id", "toxic")
    model, vectors = fit(docs if corpus is None else corpus, usable, **settings)
    if corpus is not None:
        vectors = term_counts(docs, model.terms)
    out = _scored(vectors, model)
    return out.select("doc_id", (fold("doc_id", folds) == held_out).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"), "evidence")
