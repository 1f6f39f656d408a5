"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import fold
from chatloom.llm.rules import SYMBOLS, repeated_words
from chatloom.session import cut_lineage

N_FEATURES = 14


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of each line that has a word (one empty line if none has), and the lines' lengths in characters."""
    lines = [x for x in text.split("\n") if x.strip()] or [""]
    times = Counter(lines)
    rows = []
    for line in lines:
        words = line.split()
        n, chars = max(1, len(words)), max(1, len(line))
        letters = sum(map(len, words)) or 1
        distinct = Counter(words)
        symbols = sum(map(line.count, SYMBOLS))
        upper = sum(map(str.isupper, words))
        marks = sum(map(line.count, ".,;:!?"))
        rows.append((
            math.log1p(len(words)), letters / n / 10, symbols / n, upper / n, line.count("!") / n, marks / n,
            sum(map(line.count, "0123456789")) / chars, len(distinct) / n, max(distinct.values(), default=0) / n,
            repeated_words([w.encode() for w in words]) / n, float(times[line] > 1), float(line.rstrip()[-1:] in ".!?\"'"), float(len(words) < 5), line.count("|") / n,
        ))
    return np.array(rows, np.float64), np.array([max(1, len(x)) for x in lines], np.float64)


def with_neighbours(rows: np.ndarray) -> np.ndarray:
    """A line's own features, those of the lines before and after (zero beyond the ends), and a constant."""
    before, after = np.zeros_like(rows), np.zeros_like(rows)
    before[1:], after[:-1] = rows[:-1], rows[1:]
    return np.hstack([rows, before, after, np.ones((len(rows), 1))])


@dataclass
class LineField:
    """Weights of the field; ``scale`` holds mean and deviation of the features, ``link`` maps the mean marginal to a probability."""

    weights: np.ndarray
    moves: np.ndarray  # 2 x 2, from state to state; state 1 is good
    scale: tuple[np.ndarray, np.ndarray]
    link: tuple[float, float] = (0.0, 1.0)

    def inputs(self, rows: np.ndarray) -> np.ndarray:
        return with_neighbours(np.clip((rows - self.scale[0]) / self.scale[1], -6, 6))

    def marginals(self, rows: np.ndarray) -> np.ndarray:
        """Probability that each line is good, by a forward and a backward pass."""
        good = np.exp(np.clip(self.inputs(rows) @ self.weights, -30, 30)).tolist()
        (bb, bg), (gb, gg) = np.exp(self.moves).tolist()
        n = len(good)
        ahead, p = [0.0] * n, good[0] / (1 + good[0])
        ahead[0] = p
        for t in range(1, n):
            up = (p * gg + (1 - p) * bg) * good[t]
            down = p * gb + (1 - p) * bb
            p = ahead[t] = up / (up + down)
        out, q = [0.0] * n, 0.5
        out[-1] = ahead[-1]
        for t in range(n - 2, -1, -1):
            w = q * good[t + 1]
            up, down = gg * w + gb * (1 - q), bg * w + bb * (1 - q)
            q = up / (up + down)
            a, b = ahead[t] * q, (1 - ahead[t]) * (1 - q)
            out[t] = a / (a + b) if a + b else 0.5
        return np.array(out)

    def score(self, marginals: np.ndarray, lengths: np.ndarray) -> float:
        """The length-weighted mean of the marginals, through the link."""
        z = self.link[0] + self.link[1] * _logit(float(marginals @ lengths / lengths.sum()))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def _logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def train(documents: list[tuple[np.ndarray, np.ndarray, int]], rounds: int = 150, rate: float = 0.05, decay: float = 1e-3) -> LineField:
    """Fits the field to (features, lengths, label) by gradient steps on the exact likelihood; every line takes its document's label."""
    if not documents:
        return LineField(np.zeros(3 * N_FEATURES + 1), np.zeros((2, 2)), (np.zeros(N_FEATURES), np.ones(N_FEATURES)))
    stacked = np.vstack([d[0] for d in documents])
    model = LineField(np.zeros(3 * N_FEATURES + 1), np.zeros((2, 2)), (stacked.mean(0), stacked.std(0) + 1e-3))
    size, longest = len(documents), max(len(d[0]) for d in documents)
    # lines are kept end to end; only the two numbers of a line's states are laid out per document
    x = np.vstack([model.inputs(d[0]) for d in documents])
    mask = np.zeros((size, longest))
    label = np.array([d[2] for d in documents])
    for i, (rows, _, _) in enumerate(documents):
        mask[i, : len(rows)] = 1
    on = mask > 0
    # a document counts once however many lines it has, and both labels weigh the same
    balance = np.where(label == 1, 0.5 / max(1, label.sum()), 0.5 / max(1, (1 - label).sum()))
    per_line = (balance / mask.sum(1))[:, None]
    theta = np.zeros(3 * N_FEATURES + 5)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        weights, moves = theta[:-4], theta[-4:].reshape(2, 2)
        e = np.zeros((size, longest, 2))
        e[on, 1] = x @ weights
        node, pair = _expected(e, moves, mask)
        miss = ((label[:, None] - node) * per_line)[on]
        seen = np.zeros((size, 2, 2))
        seen[np.arange(size), label, label] = np.maximum(0, mask.sum(1) - 1)
        gradient = np.concatenate([miss @ x, ((seen - pair) * per_line[:, :, None]).sum(0).ravel()]) - decay * theta
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        theta = theta + rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    model.weights, model.moves = theta[:-4], theta[-4:].reshape(2, 2)
    z = np.array([_logit(float(model.marginals(rows) @ lengths / lengths.sum())) for rows, lengths, _ in documents])
    a, b = 0.0, 1.0
    for _ in range(50):  # Newton steps of a logistic fit with a light prior
        p = 1 / (1 + np.exp(-np.clip(a + b * z, -40, 40)))
        g = np.array([(label - p).sum() - 0.01 * a, ((label - p) * z).sum() - 0.01 * (b - 1)])
        w = p * (1 - p)
        h = np.array([[w.sum() + 0.01, (w * z).sum()], [(w * z).sum(), (w * z * z).sum() + 0.01]])
        a, b = (np.array([a, b]) + np.clip(np.linalg.solve(h, g), -1, 1)).tolist()
    model.link = (a, max(b, 0.05))
    return model


def _expected(e: np.ndarray, moves: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of state 1 per line, and expected moves per document."""
    size, longest, _ = e.shape
    ahead, back = np.zeros_like(e), np.zeros_like(e)
    ahead[:, 0] = e[:, 0]
    for t in range(1, longest):
        new = np.logaddexp(ahead[:, t - 1, 0, None] + moves[0], ahead[:, t - 1, 1, None] + moves[1]) + e[:, t]
        on = mask[:, t, None] > 0
        ahead[:, t] = np.where(on, new, ahead[:, t - 1])
    total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
    pair = np.zeros((size, 2, 2))
    for t in range(longest - 2, -1, -1):
        next_ = back[:, t + 1] + e[:, t + 1]
        new = np.logaddexp(next_[:, 0, None] + moves[:, 0], next_[:, 1, None] + moves[:, 1])
        on = mask[:, t + 1, None] > 0
        back[:, t] = np.where(on, new, back[:, t + 1])
        both = np.exp(ahead[:, t, :, None] + moves + next_[:, None, :] - total[:, None, None])
        pair += both * on[:, :, None]
    node = np.exp(ahead[:, :, 1] + back[:, :, 1] - total[:, None])
    return np.clip(node, 0, 1) * mask, pair


def _rows(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def fit(docs: DataFrame, labels: DataFrame, max_documents: int = 3000, max_lines: int = 60) -> LineField:
    """The field from at most ``max_documents`` labelled documents (chosen by a hash of the id), each with one stretch of at most ``max_lines`` lines.

    Features are computed where the texts are; the driver gets the numbers of the sample, whose size the two bounds fix.
    """
    known = labels.filter("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min("quality").alias("quality"))
    # both labels are sampled alike, so that a rare label is still seen often enough
    half = max_documents // 2
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = cut_lineage(known.filter("quality = 1").orderBy(*order).limit(half).unionAll(known.filter("quality = 0").orderBy(*order).limit(half)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, text, label in zip(batch["doc_id"].to_pylist(), batch["text"], batch["quality"].to_pylist()):
                rows, lengths = line_features(text.as_py())
                # a longer document is learned from by a stretch of its lines, which know their neighbours in the whole text
                at = zlib.crc32(str(i).encode()) % max(1, len(rows) - max_lines + 1)
                rows, lengths = rows[at:at + max_lines], lengths[at:at + max_lines]
                out.append((i, label, rows.astype(np.float32).tobytes(), lengths.astype(np.float32).tobytes()))
            ids, marks, rows, lengths = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(marks, pa.int32()), pa.array(rows, pa.binary()), pa.array(lengths, pa.binary())], names=["doc_id", "label", "rows", "lengths"])

    sample = _rows(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", F.col("quality").cast("int").alias("quality"))
    got = sample.mapInArrow(run, "doc_id bigint, label int, rows binary, lengths binary").collect()
    got.sort(key=lambda r: (r["doc_id"], bytes(r["rows"])))
    return train([
        (np.frombuffer(r["rows"], np.float32).reshape(-1, N_FEATURES).astype(np.float64), np.frombuffer(r["lengths"], np.float32).astype(np.float64), int(r["label"]))
        for r in got])


def quality(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, cut: float = 0.7, corpus: DataFrame | None = None, **settings) -> DataFrame:
    """Quality of every whole text, one line per row: ``doc_id, held_out, score, predicted, n_lines, n_bad_lines``.

    A linear-chain conditional random field labels every line good or bad from its own features and those of the neighbouring
    lines; the score is the length-weighted mean of the forward-backward marginals, put on the scale of the labels by a logistic
    link. Labels (``doc_id, quality``) are learned from rows whose crc32 remainder by ``folds`` is not ``held_out``; see :func:`fit` for the
    bounds of the sample. Texts of labelled rows come from ``corpus`` (by default ``docs``).

    Null and blank texts count as one empty line. Repeated rows get equal lines; a row with a null id gets a score and a null ``held_out``.
    Without labels every score is 0.5. An empty table gives an empty result. Neither id, language nor source enters a score.
    """
    usable = labels.filter(fold("doc_id", folds) != held_out).select("doc_id", "quality")
    model = fit(docs if corpus is None else corpus, usable, **settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score, n, bad = [], [], []
            for text in batch["text"]:
                rows, lengths = line_features(text.as_py())
                marginals = model.marginals(rows)
                score.append(model.score(marginals, lengths))
                n.append(len(rows))
                bad.append(int((marginals < 0.5).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(score, pa.float64()), pa.array(n, pa.int64()), pa.array(bad, pa.int64())], names=["doc_id", "score", "n_lines", "n_bad_lines"])

    out = _rows(docs).mapInArrow(run, "doc_id bigint, score double, n_lines bigint, n_bad_lines bigint")
    return out.select("doc_id", (fold("doc_id", folds) == held_out).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"), "n_lines", "n_bad_lines")
