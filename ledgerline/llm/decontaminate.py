"""Benchmark decontamination by a broadcast hash set of test n-grams.

Words are the runs of ASCII letters, digits and non-ASCII characters after
lower-casing A-Z. Each item gives its windows of ``WINDOW`` consecutive words
(an item of fewer words, but not none, is one window). Words become 64-bit
hashes, and the index holds the items' words as one array and, per window size,
arrays of window hashes in order with the place and the item of each: some 30
bytes a word, so that its size is known from that of the items. It is broadcast.
Tasks hash the words of their documents, sieve the windows by a bit table,
look the rest up and verify each hit against the words of the item's window.

One index holds at most ``MAX_ITEM_BYTES`` of item text, which bounds it by about
``100 MB`` in the driver and in each worker. A larger benchmark is dealt into groups
of items that each stay below it; every group is scanned the same way and the
hits of a document are merged, so nothing is lost or capped.

Nulls: a null text has no words; a null item id is listed as an empty string.
Repeated item rows count once. Documents keep one output row per input row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ledgerline.llm.common import LOWER, map_arrow, raw_texts, stored

WINDOW = 10
MAX_ITEM_BYTES = 16 * 1024 * 1024
SIEVE_BITS = 22
CACHED_WORDS = 100_000

# fixed values: bytes 0-9, A-Z (lowered), a-z and all of 0x80-0xFF are word characters
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))
WORD_PATTERN = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")        # of lowered text

_MIX = np.array([0x9E3779B97F4A7C15 * (2 * k + 1) % 2**64 | 1 for k in range(64)], dtype=np.uint64)


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(WORD_BYTES).split()


class WordHashes(dict):
    """64-bit hash of a word, remembered; emptied when it gets large."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest
        if len(self) >= CACHED_WORDS:
            self.clear()
        found = self[word] = xxh64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


class Windows:
    """The windows of one size of a group of items, by hash."""

    def __init__(self, words: np.ndarray, starts: np.ndarray, owners: np.ndarray, size: int):
        self.size = size
        hashes = _window_hashes(words, size)[starts]
        order = np.lexsort((owners, hashes))
        hashes, owners, starts = hashes[order], owners[order], starts[order]
        # an item that repeats a window is listed once for it
        first = np.append(True, (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1]))
        self.hashes, self.owners, self.starts = hashes[first], owners[first], starts[first]
        table = np.zeros(1 << SIEVE_BITS, bool)
        table[self.hashes >> np.uint64(64 - SIEVE_BITS)] = True
        self.sieve = np.packbits(table)

    def maybe(self, hashes: np.ndarray) -> np.ndarray:
        """Where a window may be one of these: few others pass."""
        at = hashes >> np.uint64(64 - SIEVE_BITS)
        return np.flatnonzero(self.sieve[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8) & 1)


class ItemIndex:
    """Words and windows of a bounded group of items."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.ids: list[str] = sorted({i for i, _ in items})
        number = {i: k for k, i in enumerate(self.ids)}
        hashes = WordHashes()
        words, at = [], 0
        starts: dict[int, list[np.ndarray]] = {}
        owners: dict[int, list[np.ndarray]] = {}
        for item, text in items:
            found = hashes.of(words_of(text))
            if not len(found):
                continue
            size = min(window, len(found))
            n = len(found) - size + 1
            starts.setdefault(size, []).append(np.arange(at, at + n, dtype=np.int32))
            owners.setdefault(size, []).append(np.full(n, number[item], np.int32))
            words.append(found)
            at += len(found)
        self.words = np.concatenate(words) if words else np.zeros(0, np.uint64)
        self.windows = [Windows(self.words, np.concatenate(starts[size]), np.concatenate(owners[size]), size)
                        for size in sorted(starts)]


def _window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of the window that begins at each word, where one fits."""
    n = max(len(words) - size + 1, 0)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size if n else 0):
        out = (out ^ words[k:k + n]) * _MIX[k % len(_MIX)]
        out ^= out >> np.uint64(29)
    return out


def _scan(texts: list[bytes], index: ItemIndex, hashes: WordHashes | None = None):
    """Per text: number of words, hit word positions (sorted), item numbers."""
    hashes = WordHashes() if hashes is None else hashes
    parts = [hashes.of(words_of(raw)) for raw in texts]
    counts = np.array([len(p) for p in parts], np.int64)
    seq = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    ends = np.cumsum(counts)
    room = np.repeat(ends, counts) - np.arange(len(seq))        # words left in the text
    hit = np.zeros(len(seq) + 1, dtype=np.int32)
    items: dict[int, set[int]] = {}
    for windows in index.windows:
        size = windows.size
        h = _window_hashes(seq, size)
        at = windows.maybe(h)
        at = at[room[at] >= size]
        low = np.searchsorted(windows.hashes, h[at], "left")
        high = np.searchsorted(windows.hashes, h[at], "right")
        for start, a, z in zip(at[low < high].tolist(), low[low < high].tolist(), high[low < high].tolist()):
            own = seq[start:start + size]
            found = {int(windows.owners[k]) for k in range(a, z)
                     if (index.words[windows.starts[k]:windows.starts[k] + size] == own).all()}
            if found:
                hit[start] += 1
                hit[start + size] -= 1
                items.setdefault(int(np.searchsorted(ends, start, "right")), set()).update(found)
    covered = np.cumsum(hit)[:-1] > 0
    for d, c in enumerate(counts.tolist()):
        start = int(ends[d]) - c
        yield c, (np.flatnonzero(covered[start:start + c]) if d in items else ()), items.get(d, ())


def _item_groups(benchmark: DataFrame, max_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """Distinct items in groups whose text stays below ``max_bytes`` (a single
    longer item is a group of its own); a generator, one group at a time."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"),
        F.coalesce("text", F.lit("")).alias("t")).distinct()
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-2 * int(total) // max_bytes)) if total > max_bytes else 1
    for g in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == g)
        yield [(r["i"], r["t"].encode()) for r in part.collect()]


LEAKS = "struct<n_words:long,hits:array<struct<start:long,end:long>>,items:array<string>>"


def _annotated(docs: DataFrame, benchmark: DataFrame, window: int, max_item_bytes: int,
               keep_text: bool) -> tuple[DataFrame, str]:
    """``docs`` with a struct column of what was found, and that column's name.

    One pass per group of items; between passes the rows are written to the
    shared folder, so a task never holds more than one group's index."""
    spark = docs.sparkSession
    name = "leaks"
    while name in docs.columns:
        name += "_"
    groups = _item_groups(benchmark, max_item_bytes)
    items = next(groups)
    while True:
        following = next(groups, None)
        shared = spark.sparkContext.broadcast(ItemIndex(items, window))
        keep = [c for c in docs.columns if c != name
                and (keep_text or following is not None or c != "text")]
        schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
                           + [f"`{name}` {LEAKS}"])
        docs = map_arrow(docs, _finder(shared, keep, name), schema)
        if following is None:
            return docs, name
        docs, items = stored(docs, "leaks"), following


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
               max_item_bytes: int = MAX_ITEM_BYTES) -> DataFrame:
    """``(doc_id, n_words, hits, items)`` per document row: the hit word
    positions as sorted ``[start, end)`` runs and the sorted item ids whose
    windows occur."""
    found, name = _annotated(docs.select("doc_id", "text"), benchmark, window, max_item_bytes, False)
    return found.select("doc_id", f"{name}.n_words", f"{name}.hits", f"{name}.items")


def _runs(positions) -> list[dict]:
    if len(positions) == 0:
        return []
    p = np.asarray(positions)
    cut = np.flatnonzero(np.diff(p) > 1)
    starts = p[np.concatenate([[0], cut + 1])]
    ends = p[np.concatenate([cut, [len(p) - 1]])] + 1
    return [{"start": int(a), "end": int(b)} for a, b in zip(starts, ends)]


def _merged(first: list[dict], second: list[dict]) -> list[dict]:
    out: list[dict] = []
    for r in sorted(first + second, key=lambda r: (r["start"], r["end"])):
        if out and r["start"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], r["end"])
        else:
            out.append(dict(r))
    return out


_FOUND = pa.struct([("n_words", pa.int64()),
                    ("hits", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    ("items", pa.list_(pa.string()))])


def _finder(shared, keep: list[str], name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, hashes = shared.value, WordHashes()
        for b in batches:
            found = [{"n_words": n, "hits": _runs(positions), "items": [index.ids[i] for i in sorted(items)]}
                     for n, positions, items in _scan(raw_texts(b.column("text")), index, hashes)]
            if name in b.schema.names:          # what the groups before have found
                for new, old in zip(found, b.column(name).to_pylist()):
                    new["hits"] = _merged(old["hits"], new["hits"])
                    new["items"] = sorted({*old["items"], *new["items"]})
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [pa.array(found, _FOUND)],
                                             names=[*keep, name])
    return run


def leak_digest(leaks: DataFrame) -> DataFrame:
    """Per document: words, hit words, items and the digest of their ids."""
    return leaks.select(
        "doc_id", "n_words",
        F.aggregate("hits", F.lit(0).cast("long"),
                    lambda s, r: s + r["end"] - r["start"]).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"))


def remove_leaks(docs: DataFrame, benchmark: DataFrame, mode: str = "documents",
                 window: int = WINDOW, max_item_bytes: int = MAX_ITEM_BYTES) -> DataFrame:
    """``docs`` with all their columns, without what leaks: ``documents`` drops
    every document with a hit, ``spans`` cuts each run of hit words (from the
    first byte of its first word to the last byte of its last) out of ``text``
    and, where there is an ``n_chars`` column, counts the text anew."""
    if mode not in ("documents", "spans"):
        raise ValueError(f"mode {mode!r}: documents or spans")
    columns, schema = docs.columns, docs.schema
    found, name = _annotated(docs, benchmark, window, max_item_bytes, True)
    if mode == "documents":
        return found.where(F.size(F.col(name)["hits"]) == 0).select(*columns)
    return map_arrow(found, _cutter(name), schema)


def _cut(raw: bytes, runs: list[dict]) -> bytes:
    spans = [m.span() for m in WORD_PATTERN.finditer(raw.translate(LOWER))]
    out, last = [], 0
    for r in runs:
        out.append(raw[last:spans[r["start"]][0]])
        last = spans[r["end"] - 1][1]
    return b"".join([*out, raw[last:]])


def _cutter(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            runs = [x["hits"] for x in b.column(name).to_pylist()]
            new = [_cut(t, r).decode() if r else None for t, r in zip(raw_texts(b.column("text")), runs)]
            keep = pa.array([not r for r in runs], pa.bool_())
            names = [c for c in b.schema.names if c != name]
            columns = []
            for c in names:
                column = b.column(c)
                if c == "text":
                    column = pc.if_else(keep, column, pa.array(new, column.type))
                elif c == "n_chars":
                    column = pc.if_else(keep, column,
                                        pa.array([None if t is None else len(t) for t in new], column.type))
                columns.append(column)
            yield pa.RecordBatch.from_arrays(columns, names=names)
    return run
