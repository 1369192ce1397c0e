"""Exact distinct counts that merge: bitmaps as a rollup measure.

A customer key is a bit of a bitmap of its bucket (32,768 keys each). The lines
are read once, to one bitmap per finest combination of dimensions and bucket; a
bitmap of any coarser combination is the OR of finer ones, so every other
combination comes from the stored rollup, exactly, where counts of distinct
customers could not be added up. ``sketch=True`` keeps HyperLogLog sketches of
fixed size instead: ``1.04 / sqrt(2 ** LOG_NOMINAL)`` relative standard error, one
sketch per combination whatever the number of customers.

Null customers are not counted; a null dimension is a value of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, functions as F

LOG_NOMINAL = 12
DIMENSIONS = ("region", "category", "ship_mode")


def distinct_rollup(fact: DataFrame, dims: Sequence[str] = DIMENSIONS, sketch: bool = False) -> DataFrame:
    """One row per combination (and bucket): ``keys``, a bitmap or a sketch."""
    rows = fact.where("customer_key is not null")
    if sketch:
        return rows.groupBy(*dims).agg(F.hll_sketch_agg("customer_key", LOG_NOMINAL).alias("keys"))
    bucket = F.bitmap_bucket_number("customer_key").alias("bucket")
    return rows.groupBy(*dims, bucket).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("customer_key")).alias("keys"))


def merged(rollup: DataFrame, keep: Sequence[str], sketch: bool = False) -> DataFrame:
    """``keep`` and ``customers`` from the rollup."""
    if sketch:
        return rollup.groupBy(*keep).agg(F.hll_sketch_estimate(F.hll_union_agg("keys")).alias("customers"))
    bitmaps = rollup.groupBy(*keep, "bucket").agg(F.bitmap_or_agg("keys").alias("keys"))
    return bitmaps.groupBy(*keep).agg(F.sum(F.bitmap_count("keys")).alias("customers"))


def customers_by_dimensions(rollup: DataFrame, dims: Sequence[str] = DIMENSIONS, sketch: bool = False) -> DataFrame:
    """The distinct customers of every combination of every subset of ``dims``;
    ``grouped`` names the subset, other dimensions are null."""
    out = None
    for k in range(len(dims) + 1):
        for keep in combinations(dims, k):
            part = merged(rollup, keep, sketch).select(
                F.lit("+".join(keep) or "all").alias("grouped"),
                *((F.col(d) if d in keep else F.lit(None).cast("string")).alias(d) for d in dims), "customers")
            out = part if out is None else out.unionByName(part)
    return out
