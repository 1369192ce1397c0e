"""Arg-max / arg-min over grouped sums.

The reference uses pandas ``idxmax``/``idxmin``, which break ties by the first
key in sorted order; here every ranking orders by the exact DECIMAL sum and
then by the key, and takes the first row (``TakeOrderedAndProject``; never a
bare ``max_by`` whose tie winner is arbitrary).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.config import MONEY_SCALE, TABLE_PCT_SCALE
from ledgerline.functions.measures import aggregate
from ledgerline.functions.money import pct

MEASURES = ("sales", "profit")


def ranked(fact: DataFrame, dim: str, measure: str, descending: bool = True,
           k: int = 1, value_name: str | None = None) -> DataFrame:
    """Top (or bottom) ``k`` keys of ``dim`` by the sum of ``measure``."""
    if measure not in MEASURES:
        raise ValueError(f"rank by one of {MEASURES}, not {measure!r}")
    value_name = value_name or f"total_{measure}"
    grouped = aggregate(fact, [dim], [measure]).withColumnRenamed(f"_{measure}", "_v")
    order = F.desc("_v") if descending else F.asc("_v")
    return (grouped.orderBy(order, F.asc(dim)).limit(k)
            .select(dim, F.round("_v", MONEY_SCALE).cast("double").alias(value_name)))


def top_region(fact: DataFrame) -> DataFrame:
    """Region with the highest sales, and those sales."""
    return ranked(fact, "region", "sales", True)


def bottom_region(fact: DataFrame) -> DataFrame:
    """Region with the lowest sales."""
    return ranked(fact, "region", "sales", False)


def top_category(fact: DataFrame) -> DataFrame:
    """Most profitable category."""
    return ranked(fact, "category", "profit", True)


def best_subcategory(fact: DataFrame) -> DataFrame:
    """Most profitable sub-category."""
    return ranked(fact, "sub_category", "profit", True)


def worst_subcategory(fact: DataFrame) -> DataFrame:
    """Least profitable sub-category, its profit and the absolute loss."""
    return (ranked(fact, "sub_category", "profit", False)
            .withColumn("abs_profit", F.abs("total_profit")))


def top_ship_mode_share(fact: DataFrame) -> DataFrame:
    """R7 (+P9, P11): ship mode with the highest sales and its share of all
    revenue in %, 1 decimal, over the revenue total rounded to cents.

    Computed from one aggregate: the per-mode sums and their windowed total
    (the window runs over a handful of aggregated rows), then the first row
    by sales - no second pass that filters the fact by the winner.
    """
    grouped = aggregate(fact, ["ship_mode"], ["sales"]).withColumnRenamed("_sales", "_v")
    total = F.round(F.sum("_v").over(Window.partitionBy()), MONEY_SCALE)
    return (grouped.withColumn("share_pct", F.round(pct("_v", total), TABLE_PCT_SCALE))
            .orderBy(F.desc("_v"), F.asc("ship_mode")).limit(1)
            .select("ship_mode",
                    F.round("_v", MONEY_SCALE).cast("double").alias("total_sales"),
                    "share_pct"))
