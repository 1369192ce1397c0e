"""Quality rules: base rules, then a hashed n-gram log-likelihood ratio.

Two multinomials over ``BUCKETS`` hashed unigrams and bigrams are counted:
the trusted target (every document that the labels mark as good) and the raw
corpus (every document). Each document scores the mean, over its n-grams, of
``log p_target - log p_raw`` with add-``SMOOTHING`` probabilities, so length
does not matter, and is kept when the score reaches ``MIN_SCORE`` and the base
rules hold. Counts are integers summed by Spark, so the scores do not depend
on partitioning; only the ``BUCKETS`` totals come to the driver, and the
table of log ratios (8 bytes a bucket) goes back to the tasks.

Words are the runs without ASCII white space. Nulls and empty texts have no
words and fail the base rules. Without labels, or without any good document,
the target equals the raw corpus and only the base rules decide. Every input
row gives one output row; repeated document ids are scored row by row, and
repeated label rows count their document once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerline.llm.common import map_arrow, raw_texts
from ledgerline.llm.lexical import WordHash, hashed_words

BUCKETS = 16_384
SMOOTHING = 0.5
MIN_SCORE = -0.25
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8

# fixed values
SYMBOLS = b"#*$%&|<>"
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
CONTINUATION = bytes(range(0x80, 0xC0))

_BIGRAM = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.random.default_rng(11).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def ngram_buckets(raw: bytes, hashes: WordHash, buckets: int) -> np.ndarray:
    """Buckets of the unigrams and bigrams of a text."""
    h = hashed_words(raw, hashes)
    pairs = (h[:-1] * _BIGRAM + h[1:] + np.uint64(1)) * _BIGRAM >> np.uint64(33)
    return (np.concatenate([h, pairs]) % np.uint64(buckets)).astype(np.int64)


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words inside a ``window``-word sequence that the text holds twice or
    more, every occurrence included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.uint64)
    code = np.zeros(n, dtype=np.uint64)
    for k in range(window):
        code += ids[k:k + n] * _MIX[k]
    if len(np.unique(code)) == n:
        return 0                        # no two windows even hash alike
    # exact: equal windows get equal ranks, doubling the length until it covers the window
    rank, size = ids.astype(np.int64), 1
    while size < window:
        step = min(size, window - size)
        m = len(rank) - step
        rank = np.unique(rank[:m] * (len(words) + 1) + rank[step:step + m], return_inverse=True)[1]
        size += step
    counts = np.bincount(rank)
    starts = np.flatnonzero(counts[rank] > 1)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(edge)))


def base_counts(raw: bytes) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines, repeated words."""
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (len(words), len(raw.translate(None, CONTINUATION + SPACE)),
            len(raw) - len(raw.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words))


def _counter(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, total = WordHash(), np.zeros(buckets, dtype=np.int64)
        for b in batches:
            for raw in raw_texts(b.column("text")):
                total += np.bincount(ngram_buckets(raw, hashes, buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": at, "n": total[at]})
    return run


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """N-grams per bucket over every document; each task sends one row per
    bucket and Spark adds them up."""
    parts = map_arrow(docs.select("text"), _counter(buckets), "bucket long, n long")
    total = np.zeros(buckets, dtype=np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[row["bucket"]] = row["n"]
    return total


def log_ratios(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS,
               smoothing: float = SMOOTHING) -> np.ndarray:
    """Per bucket ``log p_target - log p_raw``."""
    trusted = labels.where("quality = 1").select("doc_id").distinct()
    raw = bucket_counts(docs, buckets)
    # labels grow with the documents, so their join is by shuffle at every size
    target = bucket_counts(
        docs.select("doc_id", "text").join(trusted.hint("merge"), "doc_id", "left_semi"), buckets)
    if not target.sum():
        return np.zeros(buckets)
    share = [np.log((x + smoothing) / (x.sum() + smoothing * buckets)) for x in (target, raw)]
    return share[0] - share[1]


def _scorer(ratios, min_score: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, hashes = ratios.value, WordHash()
        for b in batches:
            counts, scores = [], []
            for raw in raw_texts(b.column("text")):
                counts.append(base_counts(raw))
                grams = ngram_buckets(raw, hashes, len(table))
                scores.append(float(table[grams].mean()) if len(grams) else 0.0)
            c = np.array(counts, dtype=np.int64).reshape(-1, 5)
            score = np.array(scores, dtype=np.float64)
            failed = (c[:, 0] < MIN_WORDS) | (100 * c[:, 4] > MAX_REPEAT_PERCENT * c[:, 0])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(c[:, k].copy()) for k in range(5)), pa.array(score),
                 pa.array(failed), pa.array(~failed & (score >= min_score))],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", "score", "base_failed", "kept"])
    return run


def apply_rules(docs: DataFrame, labels: DataFrame, min_score: float = MIN_SCORE,
                buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> DataFrame:
    """Per document the base counts, the length-normalised score and the
    verdict (``score >= min_score``; a score equal to the threshold is kept)."""
    shared = docs.sparkSession.sparkContext.broadcast(log_ratios(docs, labels, buckets, smoothing))
    return map_arrow(
        docs.select("doc_id", "text"), _scorer(shared, min_score),
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, score double, base_failed boolean, kept boolean")
