"""The report's display tables (F11) and their text search.

The reference renders each breakdown as HTML rows: '$12,345' money (half-even,
no decimals, a negative prints as '$-1,234'), a 'pos'/'neg' class on the
profit cell (zero is 'neg') and '12.5%' for the rounded margin or share.
Here the same cells are string columns; no HTML is produced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.config import DIMENSIONS, MONEY_SCALE, TABLE_PCT_SCALE
from ledgerline.functions.formats import currency_label, percent_label, thousands_label
from ledgerline.functions.measures import aggregate
from ledgerline.functions.money import pct
from ledgerline.functions.predicates import table_sign
from ledgerline.operators.breakdowns import grouped_sets


def _grouped(fact: DataFrame, dim: str) -> DataFrame:
    return (aggregate(fact, [dim], ["sales", "profit", "orders"])
            .toDF(dim, "_s", "_p", "_n"))


def _money_table(fact: DataFrame, dim: str, sort_by: str) -> DataFrame:
    g = _grouped(fact, dim)
    margin = F.round(pct("_p", "_s"), TABLE_PCT_SCALE)
    order = F.desc("_s") if sort_by == "sales" else F.desc("_p")
    return (g.orderBy(order, F.asc(dim))
            .select(dim,
                    currency_label(F.col("_s").cast("double")).alias("sales_label"),
                    currency_label(F.col("_p").cast("double")).alias("profit_label"),
                    table_sign("_p").alias("profit_class"),
                    percent_label(margin).alias("margin_label")))


def formatted_region_table(fact: DataFrame) -> DataFrame:
    return _money_table(fact, "region", "sales")


def formatted_category_table(fact: DataFrame) -> DataFrame:
    return _money_table(fact, "category", "profit")


def formatted_subcategory_table(fact: DataFrame) -> DataFrame:
    return _money_table(fact, "sub_category", "profit")


def formatted_ship_mode_table(fact: DataFrame) -> DataFrame:
    g = _grouped(fact, "ship_mode")
    total = F.round(F.sum("_s").over(Window.partitionBy()), MONEY_SCALE)
    share = F.round(pct("_s", total), TABLE_PCT_SCALE)
    return (g.withColumn("_share", share).orderBy(F.desc("_s"), F.asc("ship_mode"))
            .select("ship_mode",
                    thousands_label("_n").alias("orders_label"),
                    currency_label(F.col("_s").cast("double")).alias("sales_label"),
                    currency_label(F.col("_p").cast("double")).alias("profit_label"),
                    table_sign("_p").alias("profit_class"),
                    percent_label("_share").alias("share_label")))


def breakdown_sign_class(fact: DataFrame, dims: tuple[str, ...] = DIMENSIONS[:4]) -> DataFrame:
    """The class of the profit cell ('pos' only when the total is
    strictly positive, zero is 'neg') for every row of the four breakdown
    tables, from one grouping-sets pass."""
    g = grouped_sets(fact, dims).filter(F.col("dimension") != "all")
    return (g.select("dimension", "dim_value",
                     F.round("_profit", MONEY_SCALE).cast("double").alias("total_profit"),
                     table_sign("_profit").alias("profit_class"))
            .orderBy("dimension", "dim_value"))


def row_text(table: DataFrame) -> F.Column:
    """A rendered row's text: its cells run together, as a browser's
    ``textContent`` returns them."""
    return F.concat_ws("", *[F.col(c) for c in table.columns if c != "profit_class"])


def search_table(table: DataFrame, query: str) -> DataFrame:
    """Keep rows whose text contains ``query``, case-insensitively.
    An empty query keeps every row."""
    if not query:
        return table
    return table.filter(F.lower(row_text(table)).contains(query.lower()))


def search_breakdown(fact: DataFrame, query: str, dim: str = "region") -> DataFrame:
    """Search one of the three searchable report tables (region, category,
    sub-category)."""
    tables = {"region": formatted_region_table, "category": formatted_category_table,
              "sub_category": formatted_subcategory_table}
    return search_table(tables[dim](fact), query)
