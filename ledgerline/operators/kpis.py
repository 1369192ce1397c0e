"""Report KPIs (A15-A24) and extremes (R10) as one-row DataFrames.

The reference evaluates each KPI with its own pass over the data (about a
dozen for the scalars, and the same group-by again for every extreme). Here
all scalar KPIs are conditional aggregates of ONE global aggregation, and all
extremes come from ONE grouping-sets aggregation whose output is a few dozen
rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.config import (
    DEFAULT, KPI_MARGIN_SCALE, KPI_PCT_SCALE, MONEY_SCALE, TABLE_PCT_SCALE,
    AnalyticsConfig,
)
from ledgerline.functions.measures import aggregate
from ledgerline.functions.money import pct, ratio
from ledgerline.operators.breakdowns import grouped_sets

TOTALS = ("sales", "profit", "orders", "disc_sum", "disc_n", "sales_n")
QUALITY = ("orders", "profitable", "loss")
DISCOUNT = ("orders", "hi_orders", "hi_profit", "hi_profit_n", "zero_profit", "zero_profit_n")


def _money(c) -> F.Column:
    return F.round(c, MONEY_SCALE).cast("double")


def _totals_cols() -> list:
    return [_money("_sales").alias("total_sales"),
            _money("_profit").alias("total_profit"),
            F.col("_orders").alias("total_orders"),
            F.round(pct("_profit", "_sales"), KPI_MARGIN_SCALE).alias("profit_margin_pct"),
            F.round(ratio("_sales", "_sales_n"), MONEY_SCALE).alias("avg_order_value"),
            F.round(ratio("_disc_sum", "_disc_n") * F.lit(100), KPI_PCT_SCALE)
            .alias("avg_discount_pct")]


def _band_means() -> tuple[F.Column, F.Column]:
    """Mean profit of the high-discount band and of full-price lines, cents."""
    return (F.round(ratio("_hi_profit", "_hi_profit_n"), MONEY_SCALE),
            F.round(ratio("_zero_profit", "_zero_profit_n"), MONEY_SCALE))


def kpi_totals(fact: DataFrame) -> DataFrame:
    """Revenue, profit, orders, margin %, mean order value, mean discount %."""
    return aggregate(fact, [], TOTALS).select(*_totals_cols())


def kpi_order_quality(fact: DataFrame) -> DataFrame:
    """Profitable / loss / break-even order counts and their % of all.

    Zero-profit orders are neither profitable nor loss-making, so the two
    percentages may not add up to 100; ``breakeven_orders`` shows the rest.
    """
    return aggregate(fact, [], QUALITY).select(
        F.col("_orders").alias("total_orders"),
        F.col("_profitable").alias("profitable_orders"),
        F.col("_loss").alias("loss_orders"),
        (F.col("_orders") - F.col("_profitable") - F.col("_loss")).alias("breakeven_orders"),
        F.round(pct("_profitable", "_orders"), KPI_PCT_SCALE).alias("profit_pct"),
        F.round(pct("_loss", "_orders"), KPI_PCT_SCALE).alias("loss_pct"))


def kpi_discount_impact(fact: DataFrame, cfg: AnalyticsConfig = DEFAULT) -> DataFrame:
    """The high-discount band (discount >= threshold) against
    full-price orders. An empty band gives NULL means and a zero count."""
    hi_mean, zero_mean = _band_means()
    return aggregate(fact, [], DISCOUNT, cfg).select(
        F.col("_hi_orders").alias("high_disc_count"),
        F.round(pct("_hi_orders", "_orders"), KPI_PCT_SCALE).alias("high_disc_pct"),
        hi_mean.alias("high_disc_avg_profit"),
        F.abs(hi_mean).alias("high_disc_abs_avg_profit"),
        zero_mean.alias("zero_disc_avg_profit"),
        F.round(zero_mean - hi_mean, MONEY_SCALE).alias("discount_profit_gap"))


def kpi_extremes(fact: DataFrame, dims: tuple[str, ...] = ("region", "category",
                                                          "sub_category", "ship_mode")) -> DataFrame:
    """Every extreme of the report in one row, from one grouping-sets pass.

    The grouping-sets output (one row per key per dimension, plus the grand
    total) is a few dozen rows; the extremes are one aggregate over them, each
    the value at the smallest (measure, key) of its dimension.

    ``max_region_profit`` is the largest regional profit (what the reference
    prints next to the top region, T7); ``top_region_own_profit`` is the profit
    of the top-sales region itself. Ties: first key in ascending order.
    """
    g = grouped_sets(fact, dims)

    def pick(dim: str, rank: str, col: str):
        # the value of ``col`` on the row that comes first by ``rank`` (one SQL
        # expression: the dimension names are this module's own constants)
        name, order = rank.rsplit("_", 1)
        sign = "-" if order == "desc" else ""
        return F.expr(f"min_by({col}, struct({sign}{name}, dim_value)) "
                      f"FILTER (WHERE dimension = '{dim}')")

    def money(dim: str, rank: str, col: str):
        return F.round(pick(dim, rank, col), MONEY_SCALE).cast("double")

    is_region = F.col("dimension") == "region"
    return g.agg(
        pick("region", "_sales_desc", "dim_value").alias("top_region"),
        money("region", "_sales_desc", "_sales").alias("top_region_sales"),
        money("region", "_sales_desc", "_profit").alias("top_region_own_profit"),
        F.round(F.max(F.when(is_region, F.col("_profit"))), MONEY_SCALE).cast("double")
        .alias("max_region_profit"),
        pick("region", "_sales_asc", "dim_value").alias("bottom_region"),
        pick("category", "_profit_desc", "dim_value").alias("top_category"),
        money("category", "_profit_desc", "_profit").alias("top_category_profit"),
        pick("sub_category", "_profit_desc", "dim_value").alias("best_subcategory"),
        money("sub_category", "_profit_desc", "_profit").alias("best_subcategory_profit"),
        pick("sub_category", "_profit_asc", "dim_value").alias("worst_subcategory"),
        money("sub_category", "_profit_asc", "_profit").alias("worst_subcategory_profit"),
        F.abs(money("sub_category", "_profit_asc", "_profit")).alias("worst_subcategory_abs_loss"),
        pick("ship_mode", "_sales_desc", "dim_value").alias("top_ship_mode"),
        F.round(pct(pick("ship_mode", "_sales_desc", "_sales"),
                    F.round(F.max(F.when(F.col("dimension") == "all", F.col("_sales"))),
                            MONEY_SCALE)), TABLE_PCT_SCALE).alias("top_ship_mode_share_pct"))


def kpi_summary(fact: DataFrame, cfg: AnalyticsConfig = DEFAULT) -> DataFrame:
    """All scalar KPIs (A15-A24) in one row from a single aggregation."""
    names = dict.fromkeys(TOTALS + QUALITY + DISCOUNT)
    hi_mean, zero_mean = _band_means()
    return aggregate(fact, [], names, cfg).select(
        *_totals_cols(),
        F.col("_profitable").alias("profitable_orders"),
        F.col("_loss").alias("loss_orders"),
        F.round(pct("_profitable", "_orders"), KPI_PCT_SCALE).alias("profit_pct"),
        F.round(pct("_loss", "_orders"), KPI_PCT_SCALE).alias("loss_pct"),
        F.col("_hi_orders").alias("high_disc_count"),
        F.round(pct("_hi_orders", "_orders"), KPI_PCT_SCALE).alias("high_disc_pct"),
        hi_mean.alias("high_disc_avg_profit"),
        zero_mean.alias("zero_disc_avg_profit"),
        F.round(zero_mean - hi_mean, MONEY_SCALE).alias("discount_profit_gap"))
