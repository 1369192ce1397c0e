"""Per-dimension breakdowns (A7-A14, A25) and the single-pass variant over all
dimensions (GROUPING SETS).

A breakdown is one grouped aggregate over the fact (or the report rollup):
scan -> partial aggregate -> hash Exchange of at most (#keys x #tasks) rows ->
final aggregate. Shares of the total use a window with no partition over the
*aggregated* rows (one row per key), never over the fact itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.config import DIMENSIONS, MONEY_SCALE, TABLE_PCT_SCALE
from ledgerline.functions.measures import aggregate
from ledgerline.functions.money import pct

SORTS = {"sales": "total_sales", "profit": "total_profit", "orders": "total_orders"}
BASE = ("sales", "profit", "orders")


def _finish(grouped: DataFrame, keys: list[str], margin: bool = True) -> DataFrame:
    cols = [F.col(k) for k in keys] + [
        F.round("_sales", MONEY_SCALE).cast("double").alias("total_sales"),
        F.round("_profit", MONEY_SCALE).cast("double").alias("total_profit"),
        F.col("_orders").alias("total_orders")]
    if margin:
        cols.append(F.round(pct("_profit", "_sales"), TABLE_PCT_SCALE).alias("margin_pct"))
    return grouped.select(*cols, "_sales", "_profit")


def breakdown(fact: DataFrame, dim: str, sort_by: str = "sales",
              share: bool = False, margin: bool = True) -> DataFrame:
    """Sales, profit, order count and margin % per value of ``dim``.

    ``sort_by`` is 'sales' or 'profit' (descending, key ascending on ties).
    ``share=True`` adds ``share_pct``: the key's sales as a percentage of the
    total sales rounded to cents (the report divides by the rounded total).
    """
    grouped = aggregate(fact, [dim], BASE)
    out = _finish(grouped, [dim], margin=margin)
    if share:
        total = F.round(F.sum("_sales").over(Window.partitionBy()), MONEY_SCALE)
        out = out.withColumn("share_pct", F.round(pct("_sales", total), TABLE_PCT_SCALE))
    return (out.orderBy(F.desc(SORTS[sort_by]), F.asc(dim))
            .drop("_sales", "_profit"))


def breakdown_region(fact: DataFrame) -> DataFrame:
    """Region table, best-selling first."""
    return breakdown(fact, "region", sort_by="sales")


def breakdown_category(fact: DataFrame) -> DataFrame:
    """Category table, most profitable first."""
    return breakdown(fact, "category", sort_by="profit")


def breakdown_subcategory(fact: DataFrame) -> DataFrame:
    """Sub-category table, most profitable first."""
    return breakdown(fact, "sub_category", sort_by="profit")


def breakdown_ship_mode(fact: DataFrame) -> DataFrame:
    """Ship-mode table with order count and share of revenue."""
    return breakdown(fact, "ship_mode", sort_by="sales", share=True, margin=False)


def ship_mode_order_share(fact: DataFrame) -> DataFrame:
    """Each ship mode's share of all *orders* (rows), 1 decimal."""
    grouped = (aggregate(fact, ["ship_mode"], ["orders"])
               .withColumnRenamed("_orders", "total_orders"))
    total = F.sum("total_orders").over(Window.partitionBy())
    return (grouped.withColumn("order_share_pct",
                               F.round(pct("total_orders", total), TABLE_PCT_SCALE))
            .orderBy(F.desc("total_orders"), F.asc("ship_mode")))


def breakdown_all_dimensions(fact: DataFrame, dims: tuple[str, ...] = DIMENSIONS[:4]) -> DataFrame:
    """Every single-dimension breakdown plus the grand total in ONE pass.

    GROUPING SETS ((d1), (d2), ..., ()) scans the fact once; the
    result has one row per key per dimension (42 rows on the test tables)
    with columns ``dimension``, ``dim_value``, ``total_sales``,
    ``total_profit``, ``total_orders``, ``margin_pct``. The grand total row has
    dimension 'all' and a NULL value.
    """
    grouped = grouped_sets(fact, dims)
    return (grouped.select(
                "dimension", "dim_value",
                F.round("_sales", MONEY_SCALE).cast("double").alias("total_sales"),
                F.round("_profit", MONEY_SCALE).cast("double").alias("total_profit"),
                F.col("_orders").alias("total_orders"),
                F.round(pct("_profit", "_sales"), TABLE_PCT_SCALE).alias("margin_pct"))
            .orderBy("dimension", F.desc("total_sales"), "dim_value"))


def grouped_sets(fact: DataFrame, dims: tuple[str, ...] = DIMENSIONS[:4]) -> DataFrame:
    """Raw GROUPING SETS aggregate: exact DECIMAL sums ``_sales``/``_profit``
    and the count ``_orders``, tagged with the dimension name and its value.

    The fact is first reduced to one row per combination of ``dims`` (a
    partial + final aggregate whose size is bounded by the product of the
    dimensions' cardinalities, 3,750 on the test tables; on the report rollup
    this is a re-aggregation of at most that many rows), and only that is
    expanded into the grouping sets; sums and counts re-aggregate exactly.
    """
    base = aggregate(fact, list(dims), BASE, null_keys=True)
    sets = [[F.col(d)] for d in dims] + [[]]
    grouped = base.groupingSets(sets, *dims).agg(
        F.sum("_sales").alias("_sales"), F.sum("_profit").alias("_profit"),
        F.sum("_orders").alias("_orders"), F.grouping_id().alias("_gid"))
    n = len(dims)
    name = F.lit("all")
    value = F.lit(None).cast("string")
    # grouping_id has bit (n-1-i) set when dims[i] is NOT grouped.
    for i, d in reversed(list(enumerate(dims))):
        only_d = (1 << n) - 1 - (1 << (n - 1 - i))
        name = F.when(F.col("_gid") == only_d, F.lit(d)).otherwise(name)
        value = F.when(F.col("_gid") == only_d, F.col(d).cast("string")).otherwise(value)
    out = grouped.select(name.alias("dimension"), value.alias("dim_value"),
                         "_sales", "_profit", "_orders")
    return out.where((F.col("dimension") == "all") | F.col("dim_value").isNotNull())
