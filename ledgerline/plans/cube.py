"""All combinations of the dimensions (CUBE) as a lattice of stored cuboids.

``GROUP BY CUBE`` over five dimensions expands every line 32-fold before it is
aggregated. Here the lines are read once, to the finest cuboid; every other one is
aggregated from its smallest parent, the cuboid of one dimension more that has the
fewest rows. A level of the lattice is one job whose result is written to the
shared folder, a folder per cuboid, so a parent is read without its neighbours and a
lost executor re-reads files. Measures are sums and counts, which add up.

``cuboid`` is the bit mask of the grouped dimensions (bit k: the k-th), which tells a
null value from a dimension that is not grouped. No lines give the grand total only
where there is any, that is no row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, functions as F

from ledgerline.config import DIMENSIONS
from ledgerline.session import delete_path, scratch_path

MEASURES = ("sales", "profit", "lines")


def _mask(dims: Sequence[str], chosen: Sequence[str]) -> int:
    return sum(1 << k for k, d in enumerate(dims) if d in chosen)


def _shaped(df: DataFrame, dims: Sequence[str], chosen: Sequence[str], kinds: dict[str, str]) -> DataFrame:
    return df.select(F.lit(_mask(dims, chosen)).alias("cuboid"), *(
        F.col(d) if d in chosen else F.lit(None).cast(kinds[d]).alias(d) for d in dims), *MEASURES)


def smallest_parent(chosen: Sequence[str], dims: Sequence[str], rows: dict[int, int]) -> int:
    """The cuboid of one dimension more with the fewest rows."""
    parents = [_mask(dims, [*chosen, d]) for d in dims if d not in chosen]
    return min(parents, key=lambda p: (rows.get(p, 0), p))


def build_cube(fact: DataFrame, dims: Sequence[str] = DIMENSIONS) -> DataFrame:
    """``cuboid``, the dimensions (null where not grouped) and the measures of
    every cuboid, as a stored table; its attribute ``scratch`` names the folder."""
    spark, dims = fact.sparkSession, list(dims)
    kinds = {d: fact.schema[d].dataType.simpleString() for d in dims}
    path = scratch_path(spark, "cube")
    finest = fact.groupBy(*dims).agg(F.sum("sales").alias("sales"), F.sum("profit").alias("profit"),
                                     F.count(F.lit(1)).alias("lines"))
    level = _shaped(finest, dims, dims, kinds)
    schema = level.schema
    for size in range(len(dims), -1, -1):
        level.write.partitionBy("cuboid").mode("append").parquet(path)
        stored = spark.read.schema(schema).parquet(path)
        if not size:
            break
        above = [_mask(dims, c) for c in combinations(dims, size)]
        counts = stored.where(F.col("cuboid").isin(above)).groupBy("cuboid").count().collect()    # one row per cuboid
        rows = {r["cuboid"]: r["count"] for r in counts}
        if not rows:
            break
        parts = []
        for chosen in combinations(dims, size - 1):
            parent = stored.where(F.col("cuboid") == smallest_parent(chosen, dims, rows))
            grouped = parent.groupBy(*chosen).agg(*(F.sum(m).alias(m) for m in MEASURES))
            # sums of sums would widen the decimals from level to level
            grouped = grouped.select(*chosen, *(F.col(m).cast(schema[m].dataType).alias(m) for m in MEASURES))
            parts.append(_shaped(grouped, dims, chosen, kinds))
        level = reduce(DataFrame.unionByName, parts)
    stored = stored.select(*schema.names)
    stored.scratch = path
    return stored


def drop_cube(cube: DataFrame) -> None:
    delete_path(cube.sparkSession, cube.scratch)


def cuboid(cube: DataFrame, chosen: Sequence[str], dims: Sequence[str] = DIMENSIONS) -> DataFrame:
    """One cuboid: the dimensions ``chosen`` and the measures."""
    return cube.where(F.col("cuboid") == _mask(dims, chosen)).select(*chosen, *MEASURES)


def sales_cube(fact: DataFrame) -> DataFrame:
    """The cube with money as the reports show it."""
    cube = build_cube(fact)
    return cube.select("cuboid", *DIMENSIONS, F.round("sales", 2).cast("double").alias("total_sales"),
                       F.round("profit", 2).cast("double").alias("total_profit"), F.col("lines").alias("total_orders"))
