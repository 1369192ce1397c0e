"""Sales in time: quarters on a generated calendar, the best year, the peak
quarter of a year.

The lines are aggregated once to (group, quarter) rows; everything after works on
these few rows. The calendar runs from the first to the last quarter that occurs,
so a quarter without sales is a row of zeros and the quarter of the year before is
always a fixed distance away; the frames are in time (``RANGE INTERVAL``), not in
rows. Lines without a date are left out; a null group is a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerline.functions.money import pct
from ledgerline.plans.fact import materialize


def by_quarter(fact: DataFrame, group: str) -> DataFrame:
    """``group, quarter_start, sales, profit, lines`` of the quarters with lines."""
    dated = fact.where("order_date is not null")
    return dated.groupBy(group, F.trunc("order_date", "quarter").alias("quarter_start")).agg(
        F.sum("sales").alias("sales"), F.sum("profit").alias("profit"), F.count("*").alias("lines"))


def on_calendar(quarters: DataFrame, group: str) -> DataFrame:
    """Every group with every quarter from the first to the last; the stored
    table ``quarters`` has at most groups x quarters rows."""
    low, high = quarters.agg(F.min("quarter_start"), F.max("quarter_start")).first()
    groups = quarters.select(group).distinct()
    days = F.explode(F.sequence(F.lit(low), F.lit(high), F.expr("interval 3 months")))
    dense = groups.select(F.struct(group).alias("_g"), days.alias("quarter_start"))
    known = quarters.select(F.struct(group).alias("_g"), "quarter_start", "sales", "profit", "lines")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast(dict(known.dtypes)[c])).alias(c)
    return dense.join(known, ["_g", "quarter_start"], "left").select(
        "_g.*", "quarter_start", zero("sales"), zero("profit"), zero("lines"))


def quarterly_sales(fact: DataFrame, group: str = "region") -> DataFrame:
    """Sales and profit of each group by quarter, empty quarters included, with
    the change against the same quarter of the year before and the sales of the
    twelve months that end with the quarter."""
    quarters = materialize(fact.sparkSession, by_quarter(fact, group))
    dense = on_calendar(quarters, group)
    frame = f"PARTITION BY {group} ORDER BY quarter_start RANGE BETWEEN INTERVAL '{{}}' MONTH PRECEDING AND {{}}"
    year_ago = F.expr("max(sales) OVER (" + frame.format(12, "INTERVAL '12' MONTH PRECEDING") + ")")
    trailing = F.expr("sum(sales) OVER (" + frame.format(9, "CURRENT ROW") + ")")
    out = dense.withColumns({"_ago": year_ago, "_trailing": trailing})
    money = lambda c: F.round(c, 2).cast("double")
    return out.select(
        group, F.year("quarter_start").alias("year"), F.quarter("quarter_start").alias("quarter"),
        money(F.col("sales")).alias("total_sales"), money(F.col("profit")).alias("total_profit"),
        F.col("lines").alias("total_orders"), money(F.col("_trailing")).alias("trailing_year_sales"),
        F.round(pct(F.col("sales") - F.col("_ago"), "_ago"), 1).alias("yoy_pct"))


def best_year(fact: DataFrame) -> DataFrame:
    """The year of the highest sales (the earlier of equal ones), one row."""
    years = fact.where("order_date is not null").groupBy(F.year("order_date").alias("best_year")).agg(
        F.sum("sales").alias("_s"))
    return years.orderBy(F.desc("_s"), "best_year").limit(1).select(
        "best_year", F.round("_s", 2).cast("double").alias("best_year_sales"))


def peak_quarters(fact: DataFrame) -> DataFrame:
    """Per year its quarter of the highest sales, the share of the fourth
    quarter, and whether that is the peak: the claim that sales peak in Q4."""
    quarters = fact.where("order_date is not null").groupBy(
        F.year("order_date").alias("year"), F.quarter("order_date").alias("q")).agg(F.sum("sales").alias("s"))
    years = quarters.groupBy("year").agg(
        F.max_by("q", F.struct("s", -F.col("q"))).alias("peak_quarter"), F.sum("s").alias("s"),
        F.sum(F.when(F.col("q") == 4, F.col("s"))).alias("q4"))
    return years.select("year", "peak_quarter", F.round("s", 2).cast("double").alias("total_sales"),
                        F.round(pct(F.coalesce("q4", F.lit(0)), "s"), 1).alias("q4_share_pct"),
                        (F.col("peak_quarter") == 4).alias("q4_is_peak"))
