"""The reference's grouped SQL reports (A1-A6), as DataFrame functions.

Each takes the sales fact (see ``ledgerline.sources``) - or the report rollup
(``ledgerline.plans.rollup``), which gives the same answer from a few
thousand pre-aggregated rows - and returns a small DataFrame; nothing is
collected. Plans: scan -> partial HashAggregate -> one hash Exchange on the
group key -> final HashAggregate -> sort (or TakeOrderedAndProject for the
LIMIT queries). Partial aggregation makes a hot key (one ship mode holding
most rows) harmless: each task ships one row per key, not the rows themselves.

Every ORDER BY ... LIMIT carries the key as a tie-breaker so the result is
deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.config import AVG_DISCOUNT_SCALE, DEFAULT, MONEY_SCALE, AnalyticsConfig
from ledgerline.functions.measures import aggregate
from ledgerline.functions.money import ratio


def _money(c: str) -> F.Column:
    """Exact DECIMAL total rounded to cents (HALF_UP), then DOUBLE."""
    return F.round(c, MONEY_SCALE).cast("double")


def sales_profit_by_region(fact: DataFrame) -> DataFrame:
    """A1: total sales and profit per region, best-selling region first."""
    return (aggregate(fact, ["region"], ["sales", "profit"])
            .select("region", _money("_sales").alias("total_sales"),
                    _money("_profit").alias("total_profit"))
            .orderBy(F.desc("total_sales"), F.asc("region")))


def _subcategory_profit(fact: DataFrame) -> DataFrame:
    return (aggregate(fact, ["sub_category"], ["profit"])
            .select("sub_category", _money("_profit").alias("total_profit")))


def top_subcategory_profit(fact: DataFrame, cfg: AnalyticsConfig = DEFAULT) -> DataFrame:
    """A2: the k most profitable sub-categories."""
    return (_subcategory_profit(fact)
            .orderBy(F.desc("total_profit"), F.asc("sub_category"))
            .limit(cfg.top_k))


def bottom_subcategory_profit(fact: DataFrame, cfg: AnalyticsConfig = DEFAULT,
                              only_losses: bool = False) -> DataFrame:
    """A3: the k least profitable sub-categories ("loss-making").

    Faithful to the reference this is simply the bottom k, whatever the sign;
    ``only_losses=True`` adds the HAVING total_profit < 0 the title implies.
    """
    grouped = _subcategory_profit(fact)
    if only_losses:
        grouped = grouped.filter(F.col("total_profit") < 0)
    return (grouped.orderBy(F.asc("total_profit"), F.asc("sub_category"))
            .limit(cfg.top_k))


def sales_by_ship_mode(fact: DataFrame) -> DataFrame:
    """A4: order count and sales per ship mode."""
    return (aggregate(fact, ["ship_mode"], ["orders", "sales"])
            .select("ship_mode", F.col("_orders").alias("total_orders"),
                    _money("_sales").alias("total_sales"))
            .orderBy(F.desc("total_sales"), F.asc("ship_mode")))


def profit_by_category(fact: DataFrame) -> DataFrame:
    """A5: sales, profit and mean discount (3 decimals) per category."""
    return (aggregate(fact, ["category"], ["sales", "profit", "disc_sum", "disc_n"])
            .select("category", _money("_sales").alias("total_sales"),
                    _money("_profit").alias("total_profit"),
                    F.round(ratio("_disc_sum", "_disc_n"), AVG_DISCOUNT_SCALE)
                    .alias("avg_discount"))
            .orderBy(F.desc("total_profit"), F.asc("category")))


def region_category_profit(fact: DataFrame) -> DataFrame:
    """The region x category matrix the reference saves as CSV."""
    return (aggregate(fact, ["region", "category"], ["sales", "profit"])
            .select("region", "category", _money("_sales").alias("total_sales"),
                    _money("_profit").alias("total_profit"))
            .orderBy(F.desc("total_profit"), F.asc("region"), F.asc("category")))


# The same reports as SQL text over a registered view of the fact, for
# users who prefer ``spark.sql``. ``{view}`` is the view name, ``{k}`` the k.
SQL_TEXT = {
    "sales_profit_by_region": """
        SELECT region, CAST(ROUND(SUM(sales), 2) AS DOUBLE) AS total_sales,
               CAST(ROUND(SUM(profit), 2) AS DOUBLE) AS total_profit
        FROM {view} GROUP BY region ORDER BY total_sales DESC, region""",
    "top_subcategory_profit": """
        SELECT sub_category, CAST(ROUND(SUM(profit), 2) AS DOUBLE) AS total_profit
        FROM {view} GROUP BY sub_category
        ORDER BY total_profit DESC, sub_category LIMIT {k}""",
    "bottom_subcategory_profit": """
        SELECT sub_category, CAST(ROUND(SUM(profit), 2) AS DOUBLE) AS total_profit
        FROM {view} GROUP BY sub_category
        ORDER BY total_profit ASC, sub_category LIMIT {k}""",
    "sales_by_ship_mode": """
        SELECT ship_mode, COUNT(*) AS total_orders,
               CAST(ROUND(SUM(sales), 2) AS DOUBLE) AS total_sales
        FROM {view} GROUP BY ship_mode ORDER BY total_sales DESC, ship_mode""",
    "profit_by_category": """
        SELECT category, CAST(ROUND(SUM(sales), 2) AS DOUBLE) AS total_sales,
               CAST(ROUND(SUM(profit), 2) AS DOUBLE) AS total_profit,
               ROUND(CAST(SUM(CAST(discount AS DECIMAL(4,2))) AS DOUBLE)
                     / COUNT(discount), 3) AS avg_discount
        FROM {view} GROUP BY category ORDER BY total_profit DESC, category""",
    "region_category_profit": """
        SELECT region, category, CAST(ROUND(SUM(sales), 2) AS DOUBLE) AS total_sales,
               CAST(ROUND(SUM(profit), 2) AS DOUBLE) AS total_profit
        FROM {view} GROUP BY region, category
        ORDER BY total_profit DESC, region, category""",
}


def run_sql(spark, name: str, view: str = "sales", cfg: AnalyticsConfig = DEFAULT) -> DataFrame:
    """Run one of the reports as SQL text against a registered view."""
    return spark.sql(SQL_TEXT[name].format(view=view, k=int(cfg.top_k)))
