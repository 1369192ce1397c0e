"""Data series behind the reference's five charts (V1-V5). Drawing is left to
the caller; every series is a small aggregated DataFrame except the scatter,
which is one row per order line (its scale-out form is the density grid)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.config import DEFAULT, MONEY_SCALE, TABLE_PCT_SCALE, AnalyticsConfig
from ledgerline.functions.formats import currency_label
from ledgerline.functions.measures import aggregate, require_lines
from ledgerline.functions.money import pct
from ledgerline.functions.predicates import is_high_discount, scatter_sign


def _bar(fact: DataFrame, dim: str, measure: str) -> DataFrame:
    name = f"total_{measure}"
    return (aggregate(fact, [dim], [measure]).withColumnRenamed(f"_{measure}", "_v")
            .select(dim, F.round("_v", MONEY_SCALE).cast("double").alias(name),
                    currency_label(F.col("_v").cast("double")).alias("value_label"),
                    "_v")
            .orderBy(F.desc("_v"), F.asc(dim)).drop("_v"))


def chart_region_sales(fact: DataFrame) -> DataFrame:
    """V1: bar per region, total sales, label '$n,nnn', largest first."""
    return _bar(fact, "region", "sales")


def chart_category_profit(fact: DataFrame) -> DataFrame:
    """V2: bar per category, total profit, label, largest first."""
    return _bar(fact, "category", "profit")


def top10_subcategory_sales(fact: DataFrame, cfg: AnalyticsConfig = DEFAULT) -> DataFrame:
    """The ten best-selling sub-categories with their rank and a
    highlight flag on the first three. Top-k first (TakeOrderedAndProject),
    then the rank window over those k rows only."""
    top = (aggregate(fact, ["sub_category"], ["sales"]).withColumnRenamed("_sales", "_v")
           .orderBy(F.desc("_v"), F.asc("sub_category")).limit(cfg.chart_top_k))
    rank = F.row_number().over(Window.orderBy(F.desc("_v"), F.asc("sub_category"))).cast("bigint")
    return (top.withColumn("sales_rank", rank)
            .select("sales_rank", "sub_category",
                    F.round("_v", MONEY_SCALE).cast("double").alias("total_sales"),
                    (F.col("sales_rank") <= cfg.chart_highlight).alias("highlight"))
            .orderBy("sales_rank"))


def discount_profit_points(fact: DataFrame, cfg: AnalyticsConfig = DEFAULT) -> DataFrame:
    """V4: one point per order line: discount, profit, its colour class
    ('loss' only when profit < 0) and which side of the discount guide line
    (x = threshold) it falls on."""
    require_lines(fact, "the scatter")
    return fact.select(
        F.col("discount").cast("double").alias("discount"),
        F.col("profit").cast("double").alias("profit"),
        scatter_sign("profit").alias("point_class"),
        F.when(is_high_discount(cfg), F.lit("high")).otherwise(F.lit("low"))
        .alias("discount_side"))


def discount_profit_density(fact: DataFrame, cfg: AnalyticsConfig = DEFAULT) -> DataFrame:
    """V4 at scale (an addition): point counts on a (discount, profit-bin)
    grid. The output size is bounded by the grid, not by the data."""
    require_lines(fact, "the density grid")
    bin_ = F.floor(F.col("profit").cast("double") / F.lit(float(cfg.profit_bin_width)))
    return (fact.groupBy(F.col("discount").cast("double").alias("discount"),
                         bin_.cast("bigint").alias("profit_bin"),
                         scatter_sign("profit").alias("point_class"))
            .agg(F.count(F.lit(1)).alias("points"))
            .orderBy("discount", "profit_bin", "point_class"))


def density_from_grid(grid: DataFrame) -> DataFrame:
    """V4 at scale from a precomputed grid (``plans.rollup.split_report_aggregates``:
    the cells counted in the same pass as the report rollup)."""
    return (grid.select("discount", "profit_bin", "point_class", "points")
            .orderBy("discount", "profit_bin", "point_class"))


def chart_ship_mode_share(fact: DataFrame) -> DataFrame:
    """V5/A10: pie slices - each ship mode's sales and % of total sales
    (1 decimal, as the slice label prints it)."""
    grouped = aggregate(fact, ["ship_mode"], ["sales"]).withColumnRenamed("_sales", "_v")
    total = F.sum("_v").over(Window.partitionBy())
    return (grouped.select(
                "ship_mode", F.round("_v", MONEY_SCALE).cast("double").alias("total_sales"),
                F.round(pct("_v", total), TABLE_PCT_SCALE).alias("share_pct"))
            .orderBy("ship_mode"))
