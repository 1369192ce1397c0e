"""Quality classifier: random-indexing word vectors, pooled per document, and
a two-layer numpy network with temperature-calibrated probabilities.

* Word vectors. Every hashed word owns a sparse ternary index vector of
  ``DIMENSIONS`` with ``NONZERO`` entries of +-1. A word's context vector is
  the sum of the index vectors of the words up to ``REACH`` places away, over
  the whole corpus. Tasks add up integers for ``BUCKETS`` hashed words, Spark
  adds the tasks' tables, so the result does not depend on partitioning. The
  table (BUCKETS x DIMENSIONS integers, about 2 MB) comes to the driver,
  is normalised and broadcast.
* Pooling. A document is the mean of its words' vectors, the mean of their
  squares and the length of the mean: an empty text is all zeros.
* Network. One hidden layer of ``HIDDEN`` tanh units and a sigmoid, fitted by
  full passes of Adam on a bounded sample of ``MAX_TRAIN_ROWS`` labelled rows
  (lowest hash of the document id first). A fifth of the sample is held back
  to fit the temperature that divides the logit.

Rows whose ``crc32(doc_id) mod 5`` is 0 are held out: their labels are never
read. Only the text enters a score. Nulls and empty texts get the network's
score of the zero vector. Without usable labels, or with one class only, every
score is the share of label 1 (0.5 without any). Labels with a null are
ignored; repeated labels of a document count once by their highest value;
repeated documents are scored row by row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.common import map_arrow, raw_texts
from ledgerline.llm.lexical import WordHash, hashed_words

BUCKETS = 8192
DIMENSIONS = 64
NONZERO = 4
REACH = 2
HIDDEN = 32
MAX_TRAIN_ROWS = 20_000
EPOCHS = 40
FOLDS = 5
THRESHOLD = 0.3
SEED = 2024
CHUNK = 1 << 19          # words per accumulation step


def held_out(doc_id: Column | str) -> Column:
    """True for the rows whose labels are never learnt."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def index_vectors(buckets: int = BUCKETS, dimensions: int = DIMENSIONS,
                  nonzero: int = NONZERO) -> tuple[np.ndarray, np.ndarray]:
    """Positions and signs of the nonzero entries per hashed word."""
    rng = np.random.default_rng(SEED)
    places = np.argsort(rng.random((buckets, dimensions)), axis=1)[:, :nonzero]
    signs = rng.integers(0, 2, (buckets, nonzero)) * 2 - 1
    return places.astype(np.int64), signs.astype(np.int64)


def _buckets(raw: bytes, hashes: WordHash) -> np.ndarray:
    return (hashed_words(raw, hashes, lower=False) % np.uint64(BUCKETS)).astype(np.int64)


def add_contexts(total: np.ndarray, words: np.ndarray, places: np.ndarray, signs: np.ndarray) -> None:
    """Add the neighbours' index vectors to ``total`` (flat, buckets x
    dimensions); a -1 in ``words`` separates documents by ``REACH`` places."""
    for off in range(1, REACH + 1):
        a, b = words[:-off], words[off:]
        real = (a >= 0) & (b >= 0)
        a, b = a[real], b[real]
        for centre, near in ((a, b), (b, a)):
            row = centre * DIMENSIONS
            for k in range(NONZERO):
                total += np.bincount(row + places[near, k], signs[near, k],
                                     minlength=len(total)).astype(np.int64)


def _context_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    places, signs = index_vectors()
    hashes, total = WordHash(), np.zeros(BUCKETS * DIMENSIONS, dtype=np.int64)
    gap = np.full(REACH, -1, dtype=np.int64)
    pending, size = [], 0
    for b in batches:
        for raw in raw_texts(b.column("text")):
            words = _buckets(raw, hashes)
            pending += [words, gap]
            size += len(words)
            if size >= CHUNK:
                add_contexts(total, np.concatenate(pending), places, signs)
                pending, size = [], 0
    if pending:
        add_contexts(total, np.concatenate(pending), places, signs)
    table = total.reshape(BUCKETS, DIMENSIONS)
    used = np.flatnonzero(table.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used), *(pa.array(table[used, d]) for d in range(DIMENSIONS))],
        names=["bucket", *(f"d{d}" for d in range(DIMENSIONS))])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit context vectors per hashed word, over every document."""
    names = [f"d{d}" for d in range(DIMENSIONS)]
    parts = map_arrow(docs.select("text"), _context_task,
                      ", ".join(f"{c} long" for c in ["bucket", *names]))
    total = np.zeros((BUCKETS, DIMENSIONS))
    for row in parts.groupBy("bucket").agg(*(F.sum(c).alias(c) for c in names)).collect():
        total[row["bucket"]] = row[1:]
    length = np.linalg.norm(total, axis=1, keepdims=True)
    return (total / np.where(length > 0, length, 1)).astype(np.float32)


def pool(words: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean, mean square and length of the mean of the words' vectors."""
    out = np.zeros(2 * DIMENSIONS + 1, dtype=np.float32)
    if len(words):
        counts = np.bincount(words, minlength=BUCKETS)
        used = np.flatnonzero(counts)
        share = (counts[used] / len(words)).astype(np.float32)
        v = vectors[used]
        out[:DIMENSIONS] = share @ v
        out[DIMENSIONS:-1] = share @ (v * v)
        out[-1] = np.linalg.norm(out[:DIMENSIONS])
    return out


@dataclass
class Model:
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def features(self, texts: list[bytes], hashes: WordHash) -> np.ndarray:
        rows = [pool(_buckets(t, hashes), self.vectors) for t in texts]
        return np.stack(rows) if rows else np.zeros((0, 2 * DIMENSIONS + 1), np.float32)

    def logits(self, features: np.ndarray) -> np.ndarray:
        # row by row, so that a score does not depend on the batch it came in
        x = (features.astype(np.float64) - self.mean) / self.scale
        hidden = np.tanh(np.einsum("ij,jk->ik", x, self.w1) + self.b1)
        return np.einsum("ij,j->i", hidden, self.w2) + self.b2

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(features) / self.temperature, -60, 60)))


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by a golden-section search. The
    targets are Platt's, (n + 1) / (n + 2), so that separable rows do not drive
    it to zero."""
    ones = y.sum()
    target = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (len(y) - ones + 2))

    def loss(log_t: float) -> float:
        z = logits / np.exp(log_t)
        return float(np.mean(np.logaddexp(0, z) - target * z))
    lo, hi, g = np.log(0.25), np.log(25.0), (5 ** 0.5 - 1) / 2
    for _ in range(60):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def fit_network(features: np.ndarray, y: np.ndarray, vectors: np.ndarray) -> Model:
    """Two layers by Adam on four fifths of the rows, temperature on the rest."""
    width = features.shape[1] if features.ndim == 2 else 2 * DIMENSIONS + 1
    if len(y) < 10 or y.min() == y.max():
        share = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
        return Model(vectors, np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1),
                     np.zeros(1), float(np.log(share / (1 - share))), 1.0)
    x = features.astype(np.float64)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    x = (x - mean) / scale
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(y))
    kept, back = order[len(y) // 5:], order[:len(y) // 5]
    p = [rng.normal(0, width ** -0.5, (width, HIDDEN)), np.zeros(HIDDEN),
         rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    step = 0
    for _ in range(EPOCHS):
        shuffled = rng.permutation(kept)
        for at in range(0, len(shuffled), 256):
            i = shuffled[at:at + 256]
            hidden = np.tanh(x[i] @ p[0] + p[1])
            z = hidden @ p[2] + p[3]
            error = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y[i]) / len(i)
            back_hidden = np.outer(error, p[2]) * (1 - hidden ** 2)
            grads = [x[i].T @ back_hidden + 1e-4 * p[0], back_hidden.sum(0), hidden.T @ error + 1e-4 * p[2],
                     np.array([error.sum()])]
            step += 1
            for k, grad in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad ** 2
                p[k] = p[k] - 0.003 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    model = Model(vectors, mean, scale, p[0], p[1], p[2], float(p[3][0]), 1.0)
    model.temperature = _temperature(model.logits(features[back]), y[back])
    return model


def _pooler(vectors):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for b in batches:
            rows = [pool(_buckets(t, hashes), vectors.value) for t in raw_texts(b.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("quality"),
                 pa.array([r.tolist() for r in rows], pa.list_(pa.float32()))],
                names=["doc_id", "quality", "features"])
    return run


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> Model:
    """Fit on at most ``max_rows`` labelled rows outside the held-out fold;
    the word vectors come from every document, labelled or not."""
    spark = docs.sparkSession
    vectors = word_vectors(docs)
    sample = (labels.where("doc_id is not null and quality is not null").where(~held_out("doc_id"))
              .groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    # at most max_rows ids and labels: bounded by the parameter
    sample = spark.createDataFrame(sample.collect(), "doc_id long, quality int")
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    shared = spark.sparkContext.broadcast(vectors)
    rows = (map_arrow(chosen, _pooler(shared), "doc_id long, quality int, features array<float>")
            .groupBy("doc_id").agg(F.max("quality").alias("quality"), F.min("features").alias("features"))
            .collect())
    rows.sort(key=lambda r: r["doc_id"])
    features = np.array([r["features"] for r in rows], dtype=np.float32).reshape(-1, 2 * DIMENSIONS + 1)
    return fit_network(features, np.array([r["quality"] for r in rows], dtype=np.float64), vectors)


def _scored(b: pa.RecordBatch, model: Model, hashes: WordHash) -> np.ndarray:
    texts, out = raw_texts(b.column("text")), []
    for at in range(0, len(texts), 1000):
        out.append(model.scores(model.features(texts[at:at + 1000], hashes)))
    return np.concatenate(out) if out else np.zeros(0)


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(_scored(b, shared.value, hashes))], names=["doc_id", "score"])
    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` per document row: the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_arrow(docs.select("doc_id", "text"), _scorer(shared), "doc_id long, score double")


def _accepted(shared, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for b in batches:
            yield b.filter(pa.array(_scored(b, shared.value, hashes) >= threshold, pa.bool_()))
    return run


def accept(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that score ``threshold`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_arrow(docs, _accepted(shared, threshold), docs.schema)


def digest(scores: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    return scores.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
