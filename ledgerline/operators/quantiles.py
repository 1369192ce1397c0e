"""Exact quantiles of groups by histogram refinement.

A quantile is the value at a known rank. Every round counts the values of each
open range in ``BINS`` equal bins - a partial aggregation of at most bins x groups
rows a task, whatever a group holds - and the bin in which the rank falls becomes
the next range. Values are whole numbers (decimals by their scale), so after
log(range) / log(bins) rounds a range is one value. No group is sorted or
collected anywhere, and a group that holds a third of all rows costs like others.

Nulls are left out; a group of nulls only has no row. Ties and repeated rows
count each. The quantile of p is the first value with at least p of the rows up
to it. A null group is a group.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import DataFrame, Window, functions as F

from ledgerline.plans.fact import materialize
from ledgerline.plans.strategy import BROADCAST_MAX_ROWS

BINS = 1024


def grouped_quantiles(df: DataFrame, by: Sequence[str], value: str, probabilities: dict[str, str],
                      scale: int = 4, bins: int = BINS) -> DataFrame:
    """``by`` columns, ``n`` and one DECIMAL(38, scale) column per entry of
    ``probabilities`` (name -> probability, as text such as "0.95") with the exact
    quantile of ``value``, a decimal of at most ``scale`` places."""
    spark = df.sparkSession
    kind = f"decimal(38,{scale})"
    rows = materialize(spark, df.where(F.col(value).isNotNull()).select(
        F.struct(*by).alias("_g"), (F.col(value).cast(kind) * 10 ** scale).cast("long").alias("_v")))
    ranges = rows.groupBy("_g").agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"), F.count("*").alias("n"))
    ranges = materialize(spark, ranges)
    asked = []
    for name, text in probabilities.items():
        p = Fraction(text)
        # the smallest rank that is not below p * n
        rank = F.expr(f"greatest(1L, (n * {p.numerator}L + {p.denominator - 1}L) div {p.denominator}L)")
        asked.append(F.struct(F.lit(name).alias("q"), rank.alias("rank")))
    state = ranges.select("_g", "n", "lo", "hi", F.explode(F.array(*asked)).alias("a")).select(
        "_g", "n", "lo", "hi", "a.q", "a.rank")
    widest = ranges.agg(F.max(F.col("hi") - F.col("lo"))).first()[0]
    by_bin = Window.partitionBy("_g", "q").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    while widest:
        width = F.expr(f"(hi - lo) div {bins}L + 1")
        few = state.count() <= BROADCAST_MAX_ROWS
        open_ranges = state.withColumn("width", width).withColumnRenamed("_g", "_s")
        open_ranges = F.broadcast(open_ranges) if few else open_ranges.hint("merge")
        counted = (rows.join(open_ranges, F.col("_g") == F.col("_s"))
                   .where("_v between lo and hi")
                   .groupBy("_g", "q", "n", "lo", "hi", "width", "rank", F.expr("(_v - lo) div width").alias("bin"))
                   .agg(F.count("*").alias("c")))
        chosen = counted.withColumn("upto", F.sum("c").over(by_bin)).where("upto >= rank and upto - c < rank")
        state = materialize(spark, chosen.select(
            "_g", "n", F.expr("lo + bin * width").alias("lo"), F.expr("least(hi, lo + bin * width + width - 1)").alias("hi"),
            "q", F.expr("rank - (upto - c)").alias("rank")))
        widest //= bins             # a bin holds (hi - lo) div bins + 1 values
    value_of = (F.col("lo").cast("decimal(38,0)") / 10 ** scale).cast(kind)
    return state.groupBy("_g").agg(F.max("n").alias("n"), *(
        F.max(F.when(F.col("q") == name, value_of)).alias(name) for name in probabilities)).select("_g.*", "n", *probabilities)


def profit_quantiles(fact: DataFrame, dimension: str = "ship_mode") -> DataFrame:
    """Median and 95th percentile of the profit per line of each group."""
    out = grouped_quantiles(fact, [dimension], "profit", {"median_profit": "0.5", "p95_profit": "0.95"})
    return out.select(dimension, F.col("n").alias("total_orders"), F.col("median_profit").cast("double").alias("median_profit"),
                      F.col("p95_profit").cast("double").alias("p95_profit"))
