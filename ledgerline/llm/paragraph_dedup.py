"""Repeated passages by paragraph MinHash banding.

Paragraphs are cut by content, not by line ends, so that a passage is seen
wherever it stands. With a hash for every ``SHINGLE``-word shingle of the
lower-cased words, a position whose hash is the least of some window of w
consecutive ones is an anchor for w: two anchors are at most w apart, and whether
a place is one depends on the words round it only. A paragraph goes from every
anchor for ``START_WINDOW`` to the first anchor for ``STOP_WINDOW`` that is at least
``LEAST`` shingles further on: 24 to 31 words, paragraphs overlap, and a run of
more than 50 words that is copied into any surroundings holds a whole one.

1. One pass over the texts gives each paragraph a digest of its words and the
   hashes of its MinHash bands; the minima are worked out once per stretch
   between two anchors and combined. The number of bands and the rows in each are
   tuned for the recall asked for at the threshold; a copied passage is found by
   any of its paragraphs.
2. Band hashes found at two places are kept: in two documents, or so far apart in
   one that the paragraphs do not overlap. Everything else is unique and done with.
3. Paragraphs that share a kept band hash form a bucket; paragraphs with one digest
   are one text in it. Texts are read again for the shingle sets of these only.
4. Within a bucket the exact Jaccard similarity of the sets is verified, as the
   links that span its components (``sketch_dedup.link_buckets``: complete at every
   size, no pairs listed, hot buckets dealt out).
5. Links of ``THRESHOLD`` or more give components, the passages. Of each the first
   place (smallest document id, then position) stays; the others are removed.
   Neighbouring paragraphs of a document with one verdict are joined to spans.

No text and texts of fewer words have no paragraphs. Rows of equal id and text are
one document, whose places count once per row. Repeated ids with other texts are documents of their own; a null
document id sorts first. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerline.llm.common import LOWER, Scratch, connected_components, map_arrow, raw_texts, stored
from ledgerline.llm.sketch_dedup import buckets_of, link_buckets

SHINGLE = 5
START_WINDOW = 20
STOP_WINDOW = 8
LEAST = 20
MOST = LEAST + STOP_WINDOW        # shingles of a paragraph stay below this
THRESHOLD = (80, 100)             # exact: 100 * intersection >= 80 * union
RECALL = 0.85                     # of one pair of paragraphs at the threshold; a passage has several
MAX_BANDS = 2
CHUNK = 10_000                    # a set has some 200 bytes
CACHED_WORDS = 100_000
MAX_BROADCAST_BYTES = 128 * 1024 * 1024
_SET_BYTES = 8 * MOST
_POSITION_BITS = 28
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
_MIX = np.random.default_rng(5).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALT = np.random.default_rng(6).integers(1, 2**63, 256, dtype=np.uint64)


def tune_bands(threshold=THRESHOLD, recall: float = RECALL, most: int = MAX_BANDS) -> tuple[int, int]:
    """``(bands, rows)``: the longest bands of which at most ``most`` find a
    pair at the threshold with probability ``recall``."""
    best, share = None, threshold[0] / threshold[1]
    for rows in range(1, 16):
        found = share ** rows
        bands = 1 if found >= 1 else ceil(log(1 - recall) / log(1 - found))
        if best is None or bands <= most:
            best = (bands, rows)
    return best


class Words(dict):
    """64-bit hash of a word, remembered; emptied when it gets large."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest
        if len(self) >= CACHED_WORDS:
            self.clear()
        found = self[word] = xxh64_intdigest(word)
        return found


def _mixed(x: np.ndarray, k: int) -> np.ndarray:
    x = (x ^ _SALT[k]) * _MIX[k]
    x ^= x >> np.uint64(32)
    return x * _MIX[k + 100]


def shingle_hashes(raw: bytes, words: Words) -> np.ndarray:
    """The hash of every shingle of a text, in order."""
    found = raw.translate(LOWER).split()
    if len(found) < SHINGLE:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    n = len(h) - SHINGLE + 1
    out = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        out = (out ^ h[k:k + n]) * _MIX[k]
        out ^= out >> np.uint64(31)
    return out


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` of every window of ``width``."""
    size = 1
    while 2 * size <= width:
        x = best(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return best(x[:-rest], x[rest:]) if rest else x


def anchors(h: np.ndarray, window: int) -> np.ndarray:
    """Whether each position holds the least hash of some window round it. Of a
    run of equal neighbours the first one counts."""
    if len(h) < window:
        return np.zeros(len(h), bool)
    least = _sliding(h, window, np.minimum)
    edge = np.zeros(window - 1, np.uint64)
    return (_sliding(np.concatenate([edge, least, edge]), window, np.maximum) == h) & np.append(True, h[1:] != h[:-1])


def paragraphs(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last (exclusive) shingle of every paragraph, the anchors for
    the stop window, and the number of the anchor that each starts at."""
    stops = np.flatnonzero(anchors(h, STOP_WINDOW))
    first = np.flatnonzero(anchors(h, START_WINDOW))
    at = np.searchsorted(stops, first + LEAST)
    real = at < len(stops)
    first, at = first[real], at[real]
    return first, stops[at] if len(at) else at, stops, np.searchsorted(stops, first)


def digests(h: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of paragraphs: sums over their shingles, and their
    first and last one. Paragraphs of equal shingles are equal here."""
    out = []
    for seed, end in ((7, first), (17, last - 1)):
        sums = np.append(np.uint64(0), np.cumsum(_mixed(h, seed)))
        out.append((sums[last] - sums[first]) ^ _mixed(h[end], seed + 1))
    return out[0], out[1]


def band_keys(h: np.ndarray, stops: np.ndarray, begin: np.ndarray, end: np.ndarray, bands: int,
              rows: int) -> np.ndarray:
    """The band hashes of paragraphs, one row each, given by the numbers of
    their anchors: minima of the stretches between anchors, combined."""
    ranges = np.stack([begin, end], axis=1).ravel()
    out = np.empty((len(begin), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(begin), _SALT[200 + b], np.uint64)
        for r in range(rows):
            value = _mixed(h, 20 + b * rows + r)
            between = np.append(np.minimum.reduceat(value, stops), _TOP)
            key = (key ^ np.minimum.reduceat(between, ranges)[::2]) * _MIX[0]
            key ^= key >> np.uint64(29)
        out[:, b] = key
    return out


_PARAGRAPHS = "row long, doc_id long, start int, n_words int, d1 long, d2 long, bands array<long>"
_ARROW = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int32()), ("n_words", pa.int32()),
                    ("d1", pa.int64()), ("d2", pa.int64()), ("bands", pa.list_(pa.int64()))])


def _paragraph_task(bands: int, rows: int):
    def batch(found: list[tuple], ids: list) -> pa.RecordBatch:
        row, doc, sizes, starts, n_words, d1, d2, keys = zip(*found)
        total = sum(sizes)
        repeated = lambda x: np.repeat(np.array(x, np.int64), sizes)
        return pa.RecordBatch.from_arrays([
            pa.array(repeated(row)), pa.array(ids, pa.int64()).take(pa.array(repeated(doc))),
            pa.array(np.concatenate(starts), pa.int32()), pa.array(np.concatenate(n_words), pa.int32()),
            pa.array(np.concatenate(d1).view(np.int64)), pa.array(np.concatenate(d2).view(np.int64)),
            pa.ListArray.from_arrays(pa.array(np.arange(total + 1, dtype=np.int32) * bands),
                                     pa.array(np.concatenate(keys).reshape(-1).view(np.int64)))], schema=_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for b in batches:
            ids, found = b.column("doc_id").to_pylist(), []
            for k, (row, raw) in enumerate(zip(b.column("row").to_pylist(), raw_texts(b.column("text")))):
                h = shingle_hashes(raw, words)
                first, last, stops, begin = paragraphs(h)
                if len(first):
                    end = np.searchsorted(stops, last)
                    found.append((row, k, len(first), first, last - first + SHINGLE - 1, *digests(h, first, last),
                                  band_keys(h, stops, begin, end, bands, rows)))
            if found:
                yield batch(found, ids)
    return run


def _set_task():
    """The shingle sets of wanted paragraphs of texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for b in batches:
            ids, codes = [], []
            for raw, wanted in zip(raw_texts(b.column("text")), b.column("wanted").to_pylist()):
                h = shingle_hashes(raw, words)
                for w in wanted:
                    ids.append(w["id"])
                    codes.append(np.unique(h[w["start"]:w["start"] + w["n_words"] - SHINGLE + 1]).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(codes, pa.binary())],
                                             names=["id", "codes"])
    return run


def _joined(df: DataFrame, row_bytes: int) -> DataFrame:
    """A stored table of rows of at most ``row_bytes``: broadcast within the
    bound, joined by shuffle beyond it."""
    return F.broadcast(df) if df.count() * row_bytes <= MAX_BROADCAST_BYTES else df.hint("merge")


def _with_keys(found: DataFrame, keys: DataFrame, bands: int) -> DataFrame:
    """The paragraphs that have band hashes among ``keys``, as ``keys``."""
    if keys.count() * 32 <= MAX_BROADCAST_BYTES:
        for b in range(bands):
            known = F.broadcast(keys.select(F.col("key").alias(f"key{b}")))
            found = found.join(known, F.col("bands")[b] == F.col(f"key{b}"), "left")
        found = found.withColumn("keys", F.array_compact(F.array(*(f"key{b}" for b in range(bands)))))
        return found.where(F.size("keys") > 0)
    # beyond the bound only place and band hash meet the keys, and of the rest what has one its place
    hits = (found.select("place", F.explode("bands").alias("key")).join(keys.hint("merge"), "key")
            .groupBy("place").agg(F.collect_list("key").alias("keys")))         # at most ``bands``
    return found.join(hits.hint("merge"), "place")


def _apart(low: str = "place", high: str = "place"):
    """Whether places are in two documents or do not overlap in one."""
    return F.max(high) - F.min(low) >= MOST + SHINGLE - 1


def _row(docs: DataFrame):
    """What tells a document from others: a hash of its id and text."""
    return F.xxhash64(docs["doc_id"], docs["text"])


def repeated_paragraphs(docs: DataFrame, threshold=THRESHOLD, recall: float = RECALL, chunk: int = CHUNK,
                        tuned: tuple[int, int] | None = None) -> DataFrame:
    """``(row, doc_id, start, n_words, first, n, removed)`` of every paragraph
    of a passage that occurs more than once; ``first`` is the place that stays."""
    bands, rows = tuned or tune_bands(threshold, recall)
    texts = docs.select(_row(docs).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    with Scratch() as scratch:
        found = scratch.store(map_arrow(texts, _paragraph_task(bands, rows), _PARAGRAPHS), "passages")
        # 35 bits of the document and the position: places of one document are near each other
        place = F.shiftrightunsigned("row", 64 - 63 + _POSITION_BITS).bitwiseAND(F.lit((1 << 63 - _POSITION_BITS) - 1))
        place = F.shiftleft(place, _POSITION_BITS).bitwiseOR(F.col("start").cast("long"))
        keys = found.select(place.alias("place"), F.explode("bands").alias("key")).groupBy("key").agg(_apart().alias("apart"))
        keys = scratch.store(keys.where("apart").select("key"), "passage-keys")
        # what shares no band hash with another place is done with
        shared = stored(_with_keys(found.withColumn("place", place), keys, bands).select(
            "row", "doc_id", "start", "n_words", "place", F.concat(*(
                F.unhex(F.lpad(F.hex(d), 16, "0")) for d in ("d1", "d2"))).alias("id"), "keys"), "passage-shared")
        distinct = scratch.store(shared.groupBy("id").agg(
            F.min(F.struct("doc_id", "row", "start", "n_words")).alias("at"), F.count("*").alias("n"),
            F.min("place").alias("low"), F.max("place").alias("high"), F.first("keys").alias("bands")),
            "passage-distinct")
        level = buckets_of(scratch, distinct.select("id", F.lit(_SET_BYTES).cast("long").alias("size"), "bands"), chunk)
        # the texts to be read again: told by 8 bytes each, then joined to what is wanted of them
        wanted = scratch.store(
            level.select("id").distinct().join(distinct.select("id", "at"), "id").groupBy(F.col("at.row").alias("row"))
            .agg(F.collect_list(F.struct("id", "at.start", "at.n_words")).alias("wanted")), "passage-wanted")
        read = texts.select("row", "text").join(_joined(wanted.select("row"), 32), "row", "left_semi")
        sets = scratch.store(map_arrow(read.join(wanted, "row").select("text", "wanted"), _set_task(),
                                       "id binary, codes binary"), "passage-sets")
        roots = scratch.own(connected_components(link_buckets(scratch, level, sets, threshold, chunk)))
        rooted = scratch.store(distinct.drop("bands").join(roots.withColumnRenamed("node", "id"), "id", "left")
                               .withColumn("root", F.coalesce("root", "id")), "passage-rooted")
        classes = rooted.groupBy("root").agg(F.min("at").alias("first"), F.sum("n").alias("n"),
                                             _apart("low", "high").alias("apart"))
        classes = scratch.store(classes.where("apart").drop("apart"), "passage-classes")
        verdict = stored(rooted.select("id", "root").join(classes, "root").select("id", "first", "n"),
                         "passage-verdict")
    kept = (F.col("row") == F.col("first.row")) & (
        F.abs(F.col("start") - F.col("first.start")) < MOST + SHINGLE - 1)
    # both sides are stored tables: a passage with very many copies is split
    return shared.select("row", "doc_id", "start", "n_words", "id").join(verdict, "id").select(
        "row", "doc_id", "start", "n_words", "first", "n", (~kept).alias("removed"))


def _spans(docs: DataFrame, **options) -> DataFrame:
    """Paragraphs of one document and verdict that touch, as one span."""
    found = repeated_paragraphs(docs, **options)
    by = Window.partitionBy("row", "removed").orderBy("start", "n_words")
    before = F.max(F.col("start") + F.col("n_words")).over(by.rowsBetween(Window.unboundedPreceding, -1))
    opened = F.when(before >= F.col("start"), 0).otherwise(1)
    numbered = found.withColumn("_new", opened).withColumn(
        "_span", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy("row", "doc_id", "removed", "_span").agg(
        F.min("start").alias("start_word"), F.max(F.col("start") + F.col("n_words")).alias("_end"),
        F.min("first").alias("first"), F.max("n").alias("n_occurrences"))


def find_repeats(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, start_word, n_words, first_doc_id, first_word, n_occurrences,
    removed)`` for every span of repeated passages: the first place of the
    earliest of them, and how many places the most frequent of them has."""
    return _spans(docs, **options).select(
        "doc_id", "start_word", (F.col("_end") - F.col("start_word")).alias("n_words"),
        F.col("first.doc_id").alias("first_doc_id"), F.col("first.start").alias("first_word"), "n_occurrences", "removed")


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _cut(text: str | None, spans: list[dict] | None) -> str | None:
    """A text without the words of spans."""
    if text is None or not spans:
        return text
    raw = text.encode()
    words = [m.span() for m in _WORD.finditer(raw)]
    gone = np.zeros(len(words) + 2, bool)
    for s in spans:
        gone[s["start"] + 1:s["end"] + 1] = True
    edges = np.flatnonzero(gone[1:] != gone[:-1]).tolist()
    out, at = [], 0
    for a, z in zip(edges[::2], edges[1::2]):
        out.append(raw[at:words[a][0]])
        at = words[z - 1][1]
    return b"".join([*out, raw[at:]]).decode()


def _cut_task(columns: list[str], name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [_cut(*x) for x in zip(b.column("text").to_pylist(), b.column(name).to_pylist())]
            new = {"text": pa.array(out, pa.string())}
            if "n_chars" in columns:
                new["n_chars"] = pa.array([None if t is None else len(t) for t in out], b.column("n_chars").type)
            yield pa.RecordBatch.from_arrays([new.get(c, b.column(c)) for c in columns], names=columns)
    return run


def remove_repeats(docs: DataFrame, **options) -> DataFrame:
    """``docs``, all rows and columns, without the words of paragraphs that
    repeat an earlier place. The place is earlier in the order of (id, document,
    position), so what is copied stays at its first place. A row is cut by the
    hash of its own id and text, so rows that share an id with it keep theirs.
    ``n_chars``, where there is one, counts the text that is left."""
    name = "cut"
    while name in docs.columns:
        name += "_"
    spans = _spans(docs, **options).where("removed")
    cut = spans.groupBy(F.struct("row").alias("_key")).agg(F.struct(F.collect_list(F.struct(
        F.col("start_word").alias("start"), F.col("_end").alias("end"))).alias(name)).alias("_found"))
    rows = docs.select(F.struct(*docs.columns).alias("_doc"), F.struct(_row(docs)).alias("_key"))
    joined = rows.join(cut, "_key", "left").select("_doc.*", F.col("_found")[name].alias(name))
    return map_arrow(joined, _cut_task(docs.columns, name), docs.schema)
