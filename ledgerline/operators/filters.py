"""Row-level projections and filters.

All are narrow transformations: they run inside the scan's whole-stage
codegen with no shuffle, and parquet receives the predicate (PushedFilters)
when the fact is stored as a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.config import DEFAULT, AnalyticsConfig
from ledgerline.functions.predicates import (
    is_high_discount, is_loss, is_profitable, is_zero_discount,
)

ORDER_LINE_COLUMNS = ("sales", "quantity", "discount", "profit")


def row_count(fact: DataFrame) -> DataFrame:
    """Number of order lines, as a one-row DataFrame."""
    return fact.agg(F.count(F.lit(1)).alias("total_orders"))


def project_order_lines(fact: DataFrame) -> DataFrame:
    """The reference's (Sales, Quantity, Discount, Profit) projection,
    money as DOUBLE."""
    return fact.select(F.col("sales").cast("double").alias("sales"),
                       F.col("quantity").cast("double").alias("quantity"),
                       F.col("discount").cast("double").alias("discount"),
                       F.col("profit").cast("double").alias("profit"))


def _rows(fact: DataFrame, cond) -> DataFrame:
    return project_order_lines(fact.filter(cond))


def profitable_orders(fact: DataFrame) -> DataFrame:
    """P5: lines with profit > 0."""
    return _rows(fact, is_profitable())


def loss_orders(fact: DataFrame) -> DataFrame:
    """Lines with profit < 0."""
    return _rows(fact, is_loss())


def high_discount_orders(fact: DataFrame, cfg: AnalyticsConfig = DEFAULT) -> DataFrame:
    """Lines with discount >= the high-discount threshold."""
    return _rows(fact, is_high_discount(cfg))


def zero_discount_orders(fact: DataFrame) -> DataFrame:
    """Full-price lines (discount == 0)."""
    return _rows(fact, is_zero_discount())
