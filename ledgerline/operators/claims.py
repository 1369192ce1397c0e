"""Checks of the report's fixed-text findings (an addition; the reference
prints these as prose regardless of the data)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.config import DEFAULT, MONEY_SCALE, TABLE_PCT_SCALE, AnalyticsConfig
from ledgerline.functions.measures import aggregate
from ledgerline.functions.money import pct, ratio


def high_discount_loss_rate(fact: DataFrame, cfg: AnalyticsConfig = DEFAULT) -> DataFrame:
    """"Nearly every order at or above the threshold loses money": the share
    of loss-making lines inside the high-discount band."""
    agg = (aggregate(fact, [], ["hi_orders", "hi_loss"], cfg)
           .toDF("high_disc_orders", "high_disc_loss_orders"))
    return agg.withColumn("loss_rate_pct", F.round(
        pct("high_disc_loss_orders", "high_disc_orders"), TABLE_PCT_SCALE))


def subcategory_discount_band_profit(fact: DataFrame, cfg: AnalyticsConfig = DEFAULT) -> DataFrame:
    """"The worst sub-category is due to discounting": profit per
    sub-category split by discount band ('high': discount >= threshold,
    'low': every other line). One aggregate per sub-category carries both
    bands as conditional measures; ``stack`` turns them into two rows and a
    band with no lines is left out, as a group-by on the band would."""
    g = aggregate(fact, ["sub_category"], ["hi_profit", "hi_orders", "lo_profit", "lo_orders"],
                  cfg)
    bands = g.select("sub_category", F.expr(
        "stack(2, 'high', _hi_profit, _hi_orders, 'low', _lo_profit, _lo_orders)"
        " AS (discount_band, _p, total_orders)"))
    return (bands.filter(F.col("total_orders") > 0)
            .select("sub_category", "discount_band",
                    F.round("_p", MONEY_SCALE).cast("double").alias("total_profit"),
                    "total_orders")
            .orderBy("sub_category", "discount_band"))



def category_discount_rank(fact: DataFrame) -> DataFrame:
    """"The top category is the most profitable partly because it is
    discounted least": each category's profit rank and mean-discount rank
    (1 = least discounted). The claim holds when the row with
    ``profit_rank`` 1 also has ``discount_rank`` 1. Ranks run over the
    aggregated rows (one per category), ties broken by the key."""
    g = (aggregate(fact, ["category"], ["profit", "disc_sum", "disc_n"])
         .select("category", F.col("_profit").alias("_p"),
                 ratio("_disc_sum", "_disc_n").alias("_d")))
    return g.select(
        "category",
        F.round("_p", MONEY_SCALE).cast("double").alias("total_profit"),
        F.round("_d", 3).alias("avg_discount"),
        F.row_number().over(Window.orderBy(F.desc("_p"), "category")).cast("bigint")
        .alias("profit_rank"),
        F.row_number().over(Window.orderBy(F.asc("_d"), "category")).cast("bigint")
        .alias("discount_rank"))
