"""Metamorphic checks: breakdowns add up, shares sum to 100, grouping sets
equal the single breakdowns, results do not depend on partitioning."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import breakdowns as B, charts as C, kpis as K, queries as Q


def test_breakdowns_add_up(fact_small):
    totals = K.kpi_totals(fact_small).collect()[0]
    for fn in (B.breakdown_region, B.breakdown_category, B.breakdown_subcategory,
               B.breakdown_ship_mode):
        rows = fn(fact_small).collect()
        assert sum(r.total_orders for r in rows) == totals.total_orders
        assert sum(r.total_sales for r in rows) == pytest.approx(totals.total_sales, abs=0.01 * len(rows))


def test_shares_sum_to_100(fact_small):
    for df, col in ((B.breakdown_ship_mode(fact_small), "share_pct"),
                    (C.chart_ship_mode_share(fact_small), "share_pct"),
                    (B.ship_mode_order_share(fact_small), "order_share_pct")):
        total = sum(r[col] for r in df.collect())
        assert total == pytest.approx(100.0, abs=0.1 * df.count())


def test_grouping_sets_equal_single_breakdowns(fact_small):
    allrows = B.breakdown_all_dimensions(fact_small)
    for dim, fn in (("region", B.breakdown_region), ("category", B.breakdown_category),
                    ("sub_category", B.breakdown_subcategory)):
        single = sorted((r[dim], r.total_sales, r.total_profit, r.total_orders, r.margin_pct)
                        for r in fn(fact_small).collect())
        grouped = sorted((r.dim_value, r.total_sales, r.total_profit, r.total_orders, r.margin_pct)
                         for r in allrows.filter(F.col("dimension") == dim).collect())
        assert single == grouped


def test_partitioning_does_not_change_results(fact_small):
    shuffled = fact_small.repartition(7, "sub_category")
    for fn in (Q.sales_profit_by_region, Q.profit_by_category, K.kpi_summary, K.kpi_extremes,
               Q.top_subcategory_profit):
        assert sorted(fn(fact_small).collect()) == sorted(fn(shuffled).collect())


def test_sql_text_equals_dataframe(spark, fact_small):
    fact_small.createOrReplaceTempView("sales")
    for name in Q.SQL_TEXT:
        df = getattr(Q, name)(fact_small)
        assert sorted(df.collect()) == sorted(Q.run_sql(spark, name).collect()), name
