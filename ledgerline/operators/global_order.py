"""Running totals and ranks over one global order, without a single task that
sees all rows.

The rows are dealt to range partitions by the order, numbered and written to the
shared folder, so that their partition is a fact and not a new sample in every
job. Totals per partition, one row each, come to the driver; their prefix sums
are what a partition starts from, and a window within the partition does the
rest. The order may be refined by tie columns, which splits a value that very
many rows share over several partitions; the dense rank takes into account that a
value may go on from the partition before.

Rows that are equal in the order and tie columns may change places with each
other. Nulls come first when ascending and last when descending, as in SQL with
that default, and share a rank. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerline.session import scratch_path


def ranged(df: DataFrame, order: Sequence[Column], partitions: int | None = None) -> DataFrame:
    """``df`` with ``_part``, ascending in ``order``, as a stored table."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "ranged")
    rows = df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id())
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def running(df: DataFrame, by: str, ties: Sequence[str] = (), value: str | None = None, descending: bool = False,
            partitions: int | None = None) -> DataFrame:
    """``df`` with ``row_number`` and ``dense_rank`` (of ``by`` alone) in the
    order of ``by, *ties``, and ``running_total`` of the decimal or long
    column ``value``; null values add nothing."""
    spark = df.sparkSession
    first = F.col(by).desc() if descending else F.col(by).asc()
    order = [first, *(F.col(c).asc() for c in ties)]
    rows = ranged(df, order, partitions)
    added = F.col(value) if value else F.lit(0)
    total = rows.select(F.sum(added).alias("s")).schema["s"].dataType.simpleString()
    parts = rows.groupBy("_part").agg(
        F.count("*").alias("n"), F.coalesce(F.sum(added), F.lit(0)).cast(total).alias("s"),
        F.count_distinct(by).alias("d"), F.max(F.col(by).isNull()).alias("gap"),
        F.min(by).alias("low"), F.max(by).alias("high"), F.max(F.col(by).isNotNull()).alias("some"))
    starts, n, rank, last = [], 0, 0, None
    s = Decimal(0) if total.startswith("decimal") else 0
    # one row per partition, in their order
    for p in sorted(parts.collect(), key=lambda r: r["_part"]):
        keys = [("null", None)] if p["gap"] else []
        known = [("is", p["low"]), ("is", p["high"])] if p["some"] else []
        ends = known[::-1] + keys if descending else keys + known
        goes_on = last == ends[0]
        starts.append((p["_part"], n, s, rank - goes_on))
        n, s, rank, last = n + p["n"], s + p["s"], rank + p["d"] + p["gap"] - goes_on, ends[-1]
    offsets = spark.createDataFrame(starts, f"_part int, _n long, _s {total}, _d long")
    inside = Window.partitionBy("_part").orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.withColumns({
        "_row": F.row_number().over(inside), "_rank": F.dense_rank().over(Window.partitionBy("_part").orderBy(first)),
        "_sum": F.coalesce(F.sum(added).over(so_far), F.lit(0).cast(total))})
    out = out.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_n") + F.col("_row")).alias("row_number"),
        (F.col("_d") + F.col("_rank")).alias("dense_rank"),
        *([(F.col("_s") + F.col("_sum")).cast(total).alias("running_total")] if value else []))
    return out


def sales_running_totals(fact: DataFrame, partitions: int | None = None) -> DataFrame:
    """Every line from the largest sale down: its number, the rank of its sale,
    the sales so far and their share of all sales (the Pareto curve)."""
    lines = fact.select("order_key", "sales", "quantity", "discount", "profit")
    out = running(lines, "sales", ["order_key", "quantity", "discount", "profit"], value="sales",
                  descending=True, partitions=partitions)
    return out.select(
        "order_key", F.col("sales").cast("double").alias("sales"), F.col("row_number").cast("long").alias("row_number"),
        F.col("dense_rank").cast("long").alias("dense_rank"),
        F.col("running_total").cast("double").alias("running_sales"))


def open_lines_count(moments: DataFrame, lines: DataFrame, partitions: int | None = None) -> DataFrame:
    """``(event_id, open_lines)``: at each moment of ``moments(event_id, at)``
    the order lines that are ordered and not yet shipped. Starts add one, ends
    take one away, and a moment reads the running total: no pair is made."""
    spans = lines.where(F.col("l_shipdate") > F.col("order_date"))
    steps = (spans.select(F.unix_micros("order_date").alias("t"), F.lit(0).alias("kind"), F.lit(1).alias("step"))
             .unionByName(spans.select(F.unix_micros("l_shipdate").alias("t"), F.lit(0).alias("kind"),
                                       F.lit(-1).alias("step"))))
    # equal steps at one time are one row; moments come after them
    steps = steps.groupBy("t", "kind").agg(F.sum("step").alias("step"))
    asked = moments.where("at is not null").select(F.unix_micros("at").alias("t"), F.lit(1).alias("kind"),
                                                   F.lit(0).cast("long").alias("step"), "event_id")
    out = running(steps.unionByName(asked, allowMissingColumns=True), "t", ["kind", "event_id"], value="step",
                  partitions=partitions)
    return out.where("kind = 1").select("event_id", F.col("running_total").alias("open_lines"))
