"""SimHash near-duplicates by multi-index hashing.

A document's fingerprint has a bit set where more than half of its shingle
hashes (XXH64, seed 42, of ``SHINGLE`` lower-cased words, repeats included)
have it set. Documents link when their fingerprints differ in at most
``RADIUS`` bits; the answer is the component of each document.

Linking works on distinct fingerprints, so exact copies cost nothing:

1. The fingerprint is cut into segments. If two differ in at most r bits, one
   of m segments differs in at most r // m of them; counting exactly, the
   first r % m + 1 segments are probed with a ball of radius r // m and the
   others with one bit less. The number of segments is the one that costs
   least for the number of fingerprints (``plan_segments``); any is exact.
2. Every fingerprint enters one table row per segment value and probes the
   table with each value of the ball round its own; matches are verified on all
   64 bits.
3. A segment value held by more than ``HOT`` fingerprints is not joined, since
   its pairs would grow with the square of a group of near copies. There
   everybody meets at common points instead: with the segment set aside, two
   fingerprints within distance a + b have a point within a of the one and b of
   the other. Each holder of the value claims the points within r // 2 of it, and
   everybody who differs by s bits in the segment (holders: none) visits the
   points within r - s - r // 2; visitors of a claimed point are linked to the
   smallest holder that claims it. Both ends of every true link meet, whoever
   meets is within r, and the rows grow with the size of the group only.

No join of tables that grow with the documents is left to Spark's estimate of a
side: it takes exploded rows for one row and a compressed file for rows in memory,
and would send millions of probes through the driver. These joins are by shuffle
at every size; only the list of crowded values is broadcast, up to
``CROWDED_BYTES`` as measured.

No text and a text without words have fingerprint zero, linked like any other.
A null document id takes part in linking but is never a component's id unless
the component has no other. Repeated document ids keep their rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ledgerline.llm.common import (
    LOWER, Scratch, connected_components, drop_stored, map_arrow, raw_texts, stored,
)
from ledgerline.plans.strategy import small_tables

SHINGLE = 4
RADIUS = 4
SEED = 42
HOT = 128
CROWDED_BYTES = 10 * 1024 * 1024        # of crowded segment values sent to all tasks
BITS = 64


def fingerprint(raw: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit fingerprint of a whole text."""
    from xxhash import xxh64_intdigest
    words = raw.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxh64_intdigest(joined, seed)]
    else:
        ends = (np.cumsum([len(w) + 1 for w in words]) - 1).tolist()
        starts = [0] + [e + 1 for e in ends[:-shingle]]
        hashes = [xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1:])]
    total = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):       # bounded scratch for very long texts
        block = np.array(hashes[at:at + (1 << 16)], dtype="<u8")
        total += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1,
                               bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprinter(shingle: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = np.array([fingerprint(t, shingle, seed) for t in raw_texts(b.column("text"))],
                              dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(prints.view(np.int64))],
                                             names=["doc_id", "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``(doc_id, fp)`` per document row, the fingerprint as a signed long."""
    return map_arrow(docs.select("doc_id", "text"), _fingerprinter(shingle, seed), "doc_id long, fp long")


def plan_segments(n: int, radius: int = RADIUS) -> list[tuple[int, int, int]]:
    """``(shift, width, ball radius)`` of the segments to probe: of all even
    cuts the one with the fewest probes plus expected chance matches."""
    best = None
    for m in range(min(2, radius + 1), radius + 2):
        cut, at = [], 0
        for k in range(m):
            width = BITS // m + (k >= m - BITS % m)
            ball = radius // m - (k > radius % m)
            if ball >= 0:
                cut.append((at, width, ball))
            at += width
        cost = sum(sum(comb(w, i) for i in range(b + 1)) * (1 + n / 2.0 ** w) for _, w, b in cut)
        if best is None or cost < best[0]:
            best = (cost, cut)
    return best[1]


def ball_masks(positions: list[int], radius: int) -> list[int]:
    """Bit masks of at most ``radius`` bits among ``positions``, as signed
    64-bit values."""
    out = []
    for r in range(radius + 1):
        for bits in combinations(positions, r):
            mask = sum(1 << b for b in bits)
            out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def _segment_key(k: int, shift: int, width: int, value):
    """Segment number and value as one long that keeps segments apart; a
    segment as wide as the fingerprint is its own key."""
    if width >= BITS:
        return value
    part = F.shiftrightunsigned(value, shift).bitwiseAND(F.lit((1 << width) - 1))
    return part.bitwiseXOR(F.lit(k << 60)) if width <= 58 else part


def link_fingerprints(scratch: Scratch, distinct: DataFrame, n: int, radius: int = RADIUS,
                      hot: int = HOT) -> DataFrame:
    """Links ``(a, b)`` between the distinct longs of ``distinct(fp)``, enough
    to connect every two that differ in at most ``radius`` bits, and none
    between others."""
    segments = plan_segments(n, radius)
    holders = probes = None
    for k, (shift, width, ball) in enumerate(segments):
        rows = distinct.select(_segment_key(k, shift, width, F.col("fp")).alias("key"), "fp",
                               F.lit(k).alias("seg"))
        holders = rows if holders is None else holders.unionByName(rows)
        masks = ball_masks(list(range(shift, shift + width)), ball)
        rows = distinct.select("fp", F.explode(F.array(*(F.lit(m).cast("long") for m in masks))).alias("m"))
        rows = rows.select(_segment_key(k, shift, width, F.col("fp").bitwiseXOR(F.col("m"))).alias("key"),
                           "fp", F.bit_count("m").cast("int").alias("off"), F.lit(k).alias("seg"))
        probes = rows if probes is None else probes.unionByName(rows)
    crowded = scratch.store(holders.groupBy("key", "seg").agg(F.count("*").alias("size"))
                            .where(F.col("size") > hot).select("key", "seg"), "simhash-hot")
    on = ["key", "seg"]
    few = small_tables({"crowded": crowded}, max_bytes=CROWDED_BYTES)["crowded"]
    sent = F.broadcast(crowded) if few else crowded.hint("merge")
    table = holders.join(sent, on, "left_anti").select(*on, F.col("fp").alias("a"))
    near = (probes.select(*on, F.col("fp").alias("b")).join(table.hint("merge"), on)
            .where((F.col("a") < F.col("b"))
                   & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))
            .select("a", "b"))
    if crowded.isEmpty():
        return near
    return near.unionByName(_meetings(scratch, probes.join(sent, on), segments, radius))


def _meetings(scratch: Scratch, members: DataFrame, segments: list[tuple[int, int, int]],
              radius: int) -> DataFrame:
    """Links within the crowded keys, through common points."""
    half, links = radius // 2, None
    for k, (shift, width, ball) in enumerate(segments):
        rest = [b for b in range(BITS) if not shift <= b < shift + width]
        segment_mask = ((1 << width) - 1) << shift
        outside = ~segment_mask & (1 << 64) - 1
        outside = outside - (1 << 64) if outside >> 63 else outside
        points = None
        for off in range(ball + 1):
            # holders (off = 0) reach half-way as such, and everybody the rest of what
            # the segment leaves of the radius
            masks = ball_masks(rest, radius - off - half)
            rows = members.where((F.col("seg") == k) & (F.col("off") == off)).select(
                "key", "fp", F.explode(F.array(*(F.lit(m).cast("long") for m in masks))).alias("m"))
            rows = rows.select(
                "key", "fp", (F.bit_count("m") <= (half if off == 0 else -1)).alias("holder"),
                F.col("fp").bitwiseAND(F.lit(outside)).bitwiseXOR(F.col("m")).alias("point"))
            points = rows if points is None else points.unionByName(rows)
        points = stored(points, "simhash-points")
        least = stored(points.where("holder").groupBy("key", "point").agg(F.min("fp").alias("b")),
                       "simhash-least")
        found = (points.join(least.hint("merge"), ["key", "point"]).where(F.col("fp") != F.col("b"))
                 .select(F.col("fp").alias("a"), "b").distinct())
        found = scratch.store(found, "simhash-met")
        drop_stored(points, least)
        links = found if links is None else links.unionByName(found)
    return links


def components(prints: DataFrame, radius: int = RADIUS, hot: int = HOT, roots: bool = False) -> DataFrame:
    """``(doc_id, fp, component_id)`` for the rows of ``prints(doc_id, fp)``:
    the smallest document id reachable over links of at most ``radius`` bits;
    with ``roots`` also ``root``, which tells components of one id apart."""
    more = ["root"] if roots else []
    prints = stored(prints, "simhash-prints")
    with Scratch() as scratch:
        groups = scratch.store(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-groups")
        links = link_fingerprints(scratch, groups.select("fp"), groups.count(), radius, hot)
        nodes = scratch.own(connected_components(links))
        rooted = groups.join(nodes.withColumnRenamed("node", "fp").hint("merge"), "fp", "left").select(
            "fp", "first", F.coalesce("root", "fp").alias("root"))
        rooted = scratch.store(rooted, "simhash-rooted")
        smallest = scratch.store(rooted.groupBy("root").agg(F.min("first").alias("component_id")),
                                 "simhash-smallest")
        by_print = stored(rooted.join(smallest.hint("merge"), "root").select("fp", "component_id", *more),
                          "simhash-components")
    # both sides are stored tables: a fingerprint shared by very many documents is split
    return prints.join(by_print.hint("merge"), "fp").select("doc_id", "fp", "component_id", *more)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
                    hot: int = HOT) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per document row, the
    fingerprint as 16 lower-case hex digits."""
    return components(fingerprints(docs, shingle), radius, hot).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _print_adder(shingle: int, seed: int, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = np.array([fingerprint(t, shingle, seed) for t in raw_texts(b.column("text"))],
                              dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(prints.view(np.int64))],
                                             names=[*b.schema.names, name])
    return run


def keep_first(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
               hot: int = HOT) -> DataFrame:
    """``docs`` with one document, that of the smallest id, of each component;
    all columns. Of the rows with that id in the component one stays; a repeated
    id whose rows lie in several components is the keeper of each by itself.
    Rows without an id cannot be named and stay as they are."""
    near = components(fingerprints(docs, shingle), radius, hot, roots=True)
    keeper = F.col("doc_id") == F.col("component_id")
    first = stored(near.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
                   .agg(F.count("*").alias("n"), F.bool_or(keeper).alias("keep")).where("keep"), "simhash-first")
    # the ids grow with the documents, so the join is by shuffle at every size
    named = docs.where(F.col("doc_id").isNotNull())
    kept = named.join(first.where("n = 1").select("doc_id").hint("merge"), "doc_id", "left_semi")
    kept = kept.select(*docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))
    repeated = first.where("n > 1").select("doc_id")
    if repeated.isEmpty():
        return kept
    # the id does not tell these rows apart, their fingerprints do
    name = "fp"
    while name in docs.columns:
        name += "_"
    rows = named.join(repeated.hint("merge"), "doc_id", "left_semi").select(*docs.columns)
    rows = map_arrow(rows, _print_adder(shingle, SEED, name),
                     StructType([*rows.schema.fields, StructField(name, LongType())]))
    keys = near.where(keeper).select(F.struct("doc_id", "fp").alias("_key"), F.col("root").alias("_root"))
    keys = keys.join(repeated.hint("merge"), F.col("_key.doc_id") == F.col("doc_id"), "left_semi").distinct()
    row = F.struct(*(F.col(c) for c in docs.columns)).alias("_row")
    rows = rows.select(row, F.struct(F.col("doc_id"), F.col(name).alias("fp")).alias("_key"))
    rows = rows.join(keys.hint("merge"), "_key")
    rows = rows.select("_row", F.col("_key.doc_id").alias("_id"), "_root").dropDuplicates(["_id", "_root"])
    return kept.unionByName(rows.select("_row.*"))
