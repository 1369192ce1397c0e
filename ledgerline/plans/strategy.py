"""Join and partitioning decisions backed by measured sizes.

* ``small_tables``: which dimensions are broadcast. A table whose files are
  larger than the bound is out at once (the optimizer's statistics, no job).
  The others are measured by ONE aggregation over the exact columns that would
  be shipped: rows and in-memory bytes. A table is small when both are within
  bounds, and the smallest ones are taken while their sum stays within the
  byte bound. Nothing is remembered between calls, so a table that grew is
  measured as it is now. Beyond the bounds the DataFrame is left alone and
  Spark shuffles (sort-merge join, with AQE splitting skewed partitions).
* ``spread``: a scan that arrives in fewer partitions than the cluster has
  cores (e.g. one large row group) is re-balanced by hash so the per-row
  work after it runs in parallel. A large input already has more partitions
  than cores and is left as it is.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

# Largest dimension (rows) shipped whole to every task ...
BROADCAST_MAX_ROWS = 2_000_000
# ... and the largest measured size of all broadcast columns together, as Spark's
# UnsafeRow holds them (null bits + 8 bytes per field + variable-length data
# rounded up to 8 bytes). The hashed relations add their index on top.
BROADCAST_MAX_BYTES = 256 * 1024 * 1024


def file_bytes(df: DataFrame) -> int:
    """Bytes of the files ``df`` reads, from the optimizer's statistics."""
    return int(str(df._jdf.queryExecution().analyzed().stats().sizeInBytes()))


def row_bytes(df: DataFrame) -> F.Column:
    """In-memory size of one row of ``df`` in Spark's UnsafeRow format."""
    fields = df.schema.fields
    fixed = 8 * ((len(fields) + 63) // 64) + 8 * len(fields)
    var = [F.coalesce(F.ceil(F.octet_length(F.col(f.name)) / 8) * 8, F.lit(0))
           for f in fields if isinstance(f.dataType, (StringType, BinaryType))]
    return reduce(operator.add, var, F.lit(fixed).cast("bigint"))


def measured(tables: dict[str, DataFrame]) -> dict[str, tuple[int, int]]:
    """Rows and in-memory bytes of every table (its own columns only), in one
    job."""
    if not tables:
        return {}
    parts = [df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows"),
                    F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes"))
             for name, df in tables.items()]
    return {r["name"]: (int(r["rows"]), int(r["bytes"]))
            for r in reduce(DataFrame.unionByName, parts).collect()}


def small_tables(tables: dict[str, DataFrame], max_rows: int = BROADCAST_MAX_ROWS,
                 max_bytes: int = BROADCAST_MAX_BYTES) -> dict[str, bool]:
    """Which of ``tables`` (projected to the columns to be shipped) are proven
    small enough to broadcast together."""
    sizes = measured({t: df for t, df in tables.items() if file_bytes(df) <= max_bytes})
    small, total = dict.fromkeys(tables, False), 0
    for name, (rows, size) in sorted(sizes.items(), key=lambda x: x[1][1]):
        if rows <= max_rows and total + size <= max_bytes:
            small[name] = True
            total += size
    return small


def spread(spark: SparkSession, df: DataFrame, keys: list[str]) -> DataFrame:
    """Hash-distribute ``df`` when it arrives in fewer partitions than the
    cluster has cores; otherwise return it unchanged.

    The hash runs over ``keys``, columns that every query reads anyway; with
    two of them one hot value is still spread by the other. Hashing avoids the
    sort a round-robin repartition performs to stay deterministic under
    retries. Only ever applied to an input smaller than one partition per
    core, so even equal keys landing together cost no more than the single
    partition they came from.
    """
    target = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target, *keys)
    return df
