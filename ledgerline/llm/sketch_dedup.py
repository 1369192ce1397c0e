"""MinHash near-duplicates by fast similarity sketching.

Documents link when the Jaccard similarity of their sets of distinct
``SHINGLE``-word shingles is at least ``THRESHOLD``; the answer is the component
of each document.

1. One pass over the texts gives each the digest of its set, the sorted 64-bit
   hashes of its shingles, and its sketch of ``BANDS * ROWS`` coordinates by fast similarity sketching (Dahlgaard,
   Knudsen and Thorup, 2017): in each round every element is thrown into one
   hashed bin with one hashed value; a bin keeps the least (round, value). After
   as many rounds as bins, a round throws everything into one bin, so that
   after twice as many rounds all bins are filled. A text stops after the first
   round that leaves none empty: a set of n elements and t bins costs about
   n + t log t steps, not n * t, every coordinate is filled, and the share of
   equal coordinates is concentrated round the similarity as if they were
   independent.
2. Texts with one set are one text from here on, so copies cost nothing more.
3. Texts that agree on a band of the sketch form a bucket; buckets of the same
   texts are taken once. Only texts in a bucket are read again for their sets.
4. A bucket gives links that span its near copies, verified on the full sets,
   never its pairs. It is dealt into chunks of about ``CHUNK`` texts by a hash,
   and a chunk is worked out in full by one task (``chunk_links``).
5. Only buckets of several chunks have pairs left, those between chunks. Pairs
   that are in one component already need no look. For the others, the texts
   outside the largest component of the bucket are joined with all its texts on
   prefix shingles: with the shingles of a bucket ordered from the rarest, two
   sets at the threshold share one of the first (1 - threshold) * size + 1 of
   each. The rows are linear in the sizes of the sets; a shingle that is in very
   many prefixes is dealt into chunks once more. Every pair of a bucket is
   covered, at every size.
6. Links give components, components the smallest document id.

No words is an empty set, linked with nothing and kept. A text of fewer words
than a shingle is one shingle. A null document id takes part in linking but is
never a component's id unless the component has no other. Repeated document ids
keep their rows. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerline.llm.common import (
    LOWER, Scratch, connected_components, map_arrow, raw_texts, stored,
)

SHINGLE = 3
THRESHOLD = (85, 100)       # exact: 100 * intersection >= 85 * union
BANDS, ROWS = 16, 5         # a pair at the threshold shares no band once in 12,000
SEED = 42
CHUNK, CHUNK_BYTES = 2000, 16 * 1024 * 1024       # texts and bytes of sets that one task works out at once
MAX_BROADCAST_BYTES = 32 * 1024 * 1024
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_VALUE_BITS = 48


def shingle_set(raw: bytes, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a whole text."""
    from xxhash import xxh64_intdigest
    words = raw.translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxh64_intdigest(joined, seed)], np.uint64)
    ends = (np.cumsum([len(w) + 1 for w in words]) - 1).tolist()
    starts = [0] + [e + 1 for e in ends[:-shingle]]
    return np.unique(np.fromiter((xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1:])),
                                 np.uint64, len(starts)))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sketch(codes: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    """The ``size`` coordinates of a set of at least one element."""
    out = np.full(size, _EMPTY)
    at, step = 0, min(2 * size, max(1, ceil(6 * size / len(codes))))
    while at < 2 * size:
        # several rounds at once for small sets: a later round never wins over an earlier one
        rounds = np.arange(at, min(at + step, 2 * size), dtype=np.uint64)
        h = _mixed(codes[:, None] + _mixed(rounds + np.uint64(1))[None, :])
        bins = np.where(rounds < size, (h >> np.uint64(_VALUE_BITS)) * np.uint64(size) >> np.uint64(16),
                        rounds - np.uint64(size) * (rounds >= size))
        value = rounds << np.uint64(_VALUE_BITS) | h & np.uint64((1 << _VALUE_BITS) - 1)
        np.minimum.at(out, bins.ravel().astype(np.int64), value.ravel())
        if (out != _EMPTY).all():
            break
        at += step
    return out


def band_keys(coordinates: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One key per band, different bands apart."""
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for column in coordinates.reshape(bands, rows).T:
        key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key


_SKETCHES = "row long, doc_id long, n_shingles long, id binary, bands array<long>"


def _set_id(codes: np.ndarray) -> bytes | None:
    from xxhash import xxh3_128_digest
    return xxh3_128_digest(codes.tobytes()) if len(codes) else None


def _sketch_task(shingle: int, bands: int, rows: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, ids, keys = [], [], []
            for raw in raw_texts(b.column("text")):
                codes = shingle_set(raw, shingle, seed)
                sizes.append(len(codes))
                ids.append(_set_id(codes))
                keys.append(band_keys(sketch(codes, bands * rows), bands, rows).view(np.int64)
                            if len(codes) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))],
                names=["row", "doc_id", "n_shingles", "id", "bands"])
    return run


def _code_task(shingle: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(raw, shingle, seed) for raw in raw_texts(b.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_set_id(x) for x in sets], pa.binary()),
                 pa.array([x.tobytes() for x in sets], pa.binary())], names=["id", "codes"])
    return run


def _resembles(shared, size, sizes, threshold):
    num, den = threshold
    return den * shared >= num * (size + sizes - shared)


class _Index:
    """Shared elements of one set with every set of a group."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(x) for x in sets])
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        self.owners = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.values, self.starts = np.unique(flat[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(flat))

    def shared(self, codes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.values, codes), len(self.values) - 1)
        at = at[self.values[at] == codes]
        found = [self.owners[a:z] for a, z in zip(self.starts[at], self.ends[at])]
        return np.bincount(np.concatenate(found), minlength=len(self.sizes)) if found else np.zeros(
            len(self.sizes), np.int64)

    def commonness(self, codes: np.ndarray) -> float:
        at = np.searchsorted(self.values, codes)
        return float((self.ends[at] - self.starts[at]).mean())


def chunk_links(sets: list[np.ndarray], threshold=THRESHOLD) -> list[tuple[int, int]]:
    """Links that span the components of a group of sets. The sets whose
    elements are the most common come first: what many resemble gathers them at
    once, and a set that all others are linked to already needs no look."""
    if len(sets) == 2:
        shared = len(np.intersect1d(*sets, assume_unique=True))
        return [(0, 1)] if _resembles(shared, len(sets[0]), len(sets[1]), threshold) else []
    index = _Index(sets)
    label, links = np.arange(len(sets)), []
    for i in np.argsort([-index.commonness(x) for x in sets], kind="stable"):
        apart = label != label[i]
        if not apart.any():
            break               # one component
        similar = _resembles(index.shared(sets[i]), index.sizes[i], index.sizes, threshold)
        for j in np.flatnonzero(apart & similar):
            if label[j] != label[i]:
                links.append((int(i), int(j)))
                label[label == label[j]] = label[i]
    return links


def cross_links(some: list[np.ndarray], own: list, others: list[np.ndarray], label: list,
                threshold=THRESHOLD) -> list[tuple[int, int]]:
    """Links between ``some`` and ``others`` of different components, enough
    to span those that they join."""
    numbers: dict = {}
    own = np.array([numbers.setdefault(c, len(numbers)) for c in own])
    label = np.array([numbers.setdefault(c, len(numbers)) for c in label])
    index, links = _Index(others), []
    for i, codes in enumerate(some):
        apart = label != own[i]
        if not apart.any():
            continue
        similar = _resembles(index.shared(codes), len(codes), index.sizes, threshold)
        for j in np.flatnonzero(apart & similar):
            if label[j] != own[i]:
                links.append((i, int(j)))
                old = label[j]
                label[label == old] = own[i]
                own[own == old] = own[i]
    return links


def _grouped(work, keys: tuple[str, ...], values: tuple[str, ...]):
    """A task over rows sorted by ``keys`` that gives the links ``(a, b)`` of
    ``work(members)`` for the members of each key."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, members, rows = None, [], []
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in keys + values)):
                if row[:len(keys)] != group:
                    rows += work(members) if len(members) > 1 else ()
                    group, members = row[:len(keys)], []
                members.append(row[len(keys):])
            if len(rows) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*rows)], schema=schema)
                rows = []
        rows += work(members) if len(members) > 1 else ()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*rows)], schema=schema)
    return run


def _codes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint64)


def _chunk_task(threshold):
    def work(members: list[tuple[bytes, bytes]]) -> Iterator[tuple[bytes, bytes]]:
        for i, j in chunk_links([_codes(c) for _, c in members], threshold):
            yield members[i][0], members[j][0]
    return _grouped(work, ("bucket", "chunk"), ("id", "codes"))


def _cross_task(threshold):
    def work(members: list[tuple]) -> Iterator[tuple[bytes, bytes]]:
        some, others = ([m for m in members if m[0] == side] for side in (True, False))
        if some and others:
            for i, j in cross_links([_codes(m[2]) for m in some], [m[3] for m in some],
                                    [_codes(m[2]) for m in others], [m[3] for m in others], threshold):
                yield some[i][1], others[j][1]
    return _grouped(work, ("bucket", "code", "piece", "chunk"), ("outside", "id", "codes", "root"))


def _bounded(df: DataFrame, row_bytes: int) -> DataFrame:
    """A stored table of rows of at most ``row_bytes``, with the hint to
    broadcast it within the bound and to join by shuffle beyond it."""
    return F.broadcast(df) if df.count() * row_bytes <= MAX_BROADCAST_BYTES else df.hint("merge")


def _in_chunks(n: str, size: str, chunk: int):
    """Chunks for ``n`` sets of ``size`` bytes together."""
    return F.greatest(F.ceil(F.col(n) / chunk), F.ceil(F.col(size) / CHUNK_BYTES), F.lit(1)).cast("long")


def _spread_links(scratch: Scratch, rows: DataFrame, keys: list[str], values: list[str], task) -> DataFrame:
    spread = rows.repartition(*keys).sortWithinPartitions(*keys, "id")
    return scratch.store(map_arrow(spread.select(*keys, *values), task, "a binary, b binary"), "sketch-links")


def _explode_codes(df: DataFrame, *columns: str) -> DataFrame:
    """One row per element of the sets in ``codes``, as a long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                b = batch.slice(at, 500)
                sets = [np.frombuffer(c, np.int64) for c in b.column("codes").to_pylist()]
                at_row = pa.array(np.repeat(np.arange(len(sets)), [len(x) for x in sets]))
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c).take(at_row) for c in columns), pa.array(np.concatenate(sets))],
                    names=[*columns, "code"])
    kinds = dict(df.dtypes)
    return map_arrow(df.select(*columns, "codes"), run,
                     ", ".join([*(f"{c} {kinds[c]}" for c in columns), "code long"]))


def _prefix_links(scratch: Scratch, members: DataFrame, threshold, chunk: int) -> DataFrame:
    """Links between the texts outside the largest component of their bucket
    and all texts of the bucket; ``members(bucket, id, codes, root, outside)``."""
    num, den = threshold
    codes = _explode_codes(members, "bucket", "id")
    rare = scratch.store(codes.groupBy("bucket", "code").agg(F.count("*").alias("n")), "sketch-rare")
    size = F.count("*").over(by := Window.partitionBy("bucket", "id"))
    place = F.row_number().over(by.orderBy("n", "code"))
    # sets at the threshold share at least num/den of either: one of the first size - ceil(size * num / den) + 1
    prefix = codes.join(rare, ["bucket", "code"]).select(
        "bucket", "id", "code", place.alias("place"), size.alias("size"))
    prefix = scratch.store(prefix.where(
        F.col("place") <= F.col("size") - F.ceil(F.col("size") * num / den) + 1).select("bucket", "id", "code"),
        "sketch-prefix")
    keyed = prefix.join(members, ["bucket", "id"]).select("bucket", "code", "id", "codes", "root", "outside")
    size = F.octet_length("codes")
    counts = (keyed.groupBy("bucket", "code").agg(
        F.count("*").alias("n"), F.sum(size).alias("size"), F.count_if("outside").alias("out"),
        F.sum(F.when(F.col("outside"), size).otherwise(0)).alias("out_size")).where("out > 0 and n > 1"))
    counts = scratch.store(counts.select(
        "bucket", "code", _in_chunks("n", "size", chunk).alias("chunks"),
        _in_chunks("out", "out_size", chunk).alias("pieces")), "sketch-counts")
    keyed = keyed.join(_bounded(counts, 64), ["bucket", "code"])
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    dealt = lambda n, salt: F.pmod(F.xxhash64("bucket", "code", "id", F.lit(salt)), F.col(n))
    columns = ["id", "codes", "root"]
    blocks = keyed.select("bucket", "code", upto("pieces").alias("piece"), dealt("chunks", 1).alias("chunk"),
                          F.lit(False).alias("outside"), *columns)
    blocks = blocks.unionByName(keyed.where("outside").select(
        "bucket", "code", dealt("pieces", 2).alias("piece"), upto("chunks").alias("chunk"),
        F.lit(True).alias("outside"), *columns))
    return _spread_links(scratch, blocks, ["bucket", "code", "piece", "chunk"], ["outside", *columns],
                         _cross_task(threshold))


def buckets_of(scratch: Scratch, sets: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``(bucket, id, chunks, chunk)``: the buckets of at least two of the
    distinct sets of ``sets(id, size, bands)``, and the chunk of each member."""
    banded = sets.select("id", "size", F.explode("bands").alias("bucket"))
    # buckets of the same sets are one: told by two 64-bit sums, the number and the size of the sets
    buckets = (banded.groupBy("bucket")
               .agg(F.count("*").alias("n"), F.sum("size").alias("size"), F.bit_xor(F.xxhash64("id")).alias("x"),
                    F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("y"))
               .where("n > 1").groupBy("n", "size", "x", "y").agg(F.min("bucket").alias("bucket")))
    buckets = scratch.store(buckets.select("bucket", _in_chunks("n", "size", chunk).alias("chunks")),
                            "sketch-buckets")
    return scratch.store(banded.join(_bounded(buckets, 64), "bucket").select(
        "bucket", "id", "chunks", F.pmod(F.xxhash64("bucket", "id"), F.col("chunks")).alias("chunk")),
        "sketch-level")


def link_buckets(scratch: Scratch, level: DataFrame, sets: DataFrame, threshold=THRESHOLD,
                 chunk: int = CHUNK) -> DataFrame:
    """Spanning links ``(a, b)`` between the similar sets of each bucket of
    ``level``, with the stored table ``sets(id, codes)``."""
    members = level.join(sets, "id")
    links = _spread_links(scratch, members, ["bucket", "chunk"], ["id", "codes"], _chunk_task(threshold))
    hot = level.where("chunks > 1")
    if hot.isEmpty():
        return links
    roots = scratch.own(connected_components(links)).withColumnRenamed("node", "id")
    spread = scratch.store(hot.join(roots, "id", "left").select(
        "bucket", "id", F.coalesce("root", "id").alias("root")), "sketch-hot")
    largest = (spread.groupBy("bucket", "root").agg(F.count("*").alias("n")).groupBy("bucket")
               .agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("parts"))
               .where("parts > 1"))
    largest = scratch.store(largest.select("bucket", "main"), "sketch-largest")
    open_members = spread.join(_bounded(largest, 64), "bucket").join(sets, "id").select(
        "bucket", "id", "codes", "root", (F.col("root") != F.col("main")).alias("outside"))
    open_members = scratch.store(open_members, "sketch-open")
    return links.unionByName(_prefix_links(scratch, open_members, threshold, chunk))


def components(docs: DataFrame, shingle: int = SHINGLE, threshold=THRESHOLD, bands: int = BANDS,
               rows: int = ROWS, seed: int = SEED, chunk: int = CHUNK) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` per document row;
    ``threshold`` is a pair: den * intersection >= num * union."""
    with Scratch() as scratch:
        # a row is told by a hash of id and text when its text is read again
        texts = docs.select(F.xxhash64("doc_id", "text").alias("row"),
                            F.col("doc_id").cast("long").alias("doc_id"), "text")
        found = scratch.store(map_arrow(texts, _sketch_task(shingle, bands, rows, seed), _SKETCHES),
                              "sketch-bands")
        places = stored(found.select("doc_id", "n_shingles", "id"), "sketch-places")
        distinct = scratch.store(found.where("id is not null").groupBy("id").agg(
            F.min("doc_id").alias("first"), F.min("row").alias("row"), (8 * F.max("n_shingles")).alias("size"),
            F.first("bands").alias("bands")), "sketch-distinct")
        groups = distinct.select("id", "first")
        level = buckets_of(scratch, distinct, chunk)
        wanted = scratch.store(level.select("id").distinct().join(distinct, "id").select("row").distinct(),
                               "sketch-wanted")
        sets = scratch.store(map_arrow(
            texts.join(_bounded(wanted, 32), "row", "left_semi").select("text"), _code_task(shingle, seed),
            "id binary, codes binary").groupBy("id").agg(F.first("codes").alias("codes")), "sketch-sets")
        roots = scratch.own(connected_components(link_buckets(scratch, level, sets, threshold, chunk)))
        rooted = scratch.store(groups.join(roots.withColumnRenamed("node", "id"), "id", "left").select(
            "id", "first", F.coalesce("root", "id").alias("root")), "sketch-rooted")
        smallest = scratch.store(rooted.groupBy("root").agg(F.min("first").alias("component_id")),
                                 "sketch-smallest")
        by_set = stored(rooted.join(smallest, "root").select("id", "component_id"), "sketch-components")
    # both sides are stored tables: a set shared by very many documents is split
    joined = places.where("id is not null").join(by_set, "id").select("doc_id", "n_shingles", "component_id")
    alone = places.where("id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
