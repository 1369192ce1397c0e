"""The report rollup: every aggregate section computed from the stored rollup
equals the same section computed from the order-line fact, the rollup is
bounded by the dimension combinations, and a section over it scans only the
rollup."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerline.config import RETAIL
from ledgerline.functions.measures import is_rollup, line_measures
from ledgerline.operators import charts as C, claims as CL, kpis as K
from ledgerline.plans import inspect as I
from ledgerline.plans.report import report_sections
from ledgerline.plans.fact import materialize
from ledgerline.plans.rollup import (
    ROLLUP_GRAIN, build_report_aggregates, build_rollup, split_report_aggregates, store_rollup,
)


@pytest.fixture(scope="module")
def rollup(spark, fact_small):
    return store_rollup(spark, build_rollup(fact_small))


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_every_section_equals_the_line_path(fact_small, rollup):
    direct = report_sections(fact_small)
    via = report_sections(fact_small, rollup=rollup)
    assert direct.keys() == via.keys()
    for name in direct:
        assert direct[name].columns == via[name].columns, name
        assert _rows(direct[name]) == _rows(via[name]), name


def test_sections_keep_their_order(fact_small, rollup):
    direct = report_sections(fact_small)
    via = report_sections(fact_small, rollup=rollup)
    for name in ("sales_profit_by_region", "top_subcategory_profit", "breakdowns"):
        assert direct[name].collect() == via[name].collect(), name


def test_rollup_size_and_totals(fact_small, rollup):
    assert is_rollup(rollup)
    distinct = fact_small.select(*ROLLUP_GRAIN).distinct().count()
    assert rollup.count() == distinct
    totals = rollup.agg(F.sum("m_orders"), F.sum("m_sales"), F.sum("m_profit")).first()
    direct = fact_small.agg(F.count(F.lit(1)), F.sum("sales"), F.sum("profit")).first()
    assert tuple(totals) == tuple(direct)


def test_rollup_carries_every_measure(rollup):
    for name in line_measures():
        assert f"m_{name}" in rollup.columns


def test_other_threshold_needs_its_own_rollup(spark, fact_small):
    retail = store_rollup(spark, build_rollup(fact_small, RETAIL))
    assert retail.select("high_discount").distinct().first()[0] == RETAIL.high_discount
    a = _rows(K.kpi_discount_impact(fact_small, RETAIL))
    assert a == _rows(K.kpi_discount_impact(retail, RETAIL))
    assert _rows(CL.subcategory_discount_band_profit(fact_small, RETAIL)) == _rows(
        CL.subcategory_discount_band_profit(retail, RETAIL))


def test_section_over_rollup_scans_only_the_rollup(rollup):
    """One scan of the stored rollup file (cached whole), no joins; the
    in-memory columnar scan serves only the columns the section uses."""
    df = K.kpi_summary(rollup)
    schemas = I.scans(df)
    assert len(schemas) == 1 and "m_orders" in schemas[0] and "l_orderkey" not in schemas[0]
    tree = I.physical_section(df)
    assert "InMemoryTableScan" in tree and "Join" not in tree


def test_line_outputs_refuse_a_rollup(rollup):
    with pytest.raises(ValueError):
        C.discount_profit_points(rollup)
    with pytest.raises(ValueError):
        C.discount_profit_density(rollup)


def test_rollup_plan_is_one_aggregation(fact_small):
    """Above the fact's own plan: one partial + final aggregation, one hash
    exchange."""
    base = I.physical_section(fact_small)
    tree = I.physical_section(build_rollup(fact_small))
    assert tree.count("Exchange hashpartitioning") - base.count("Exchange hashpartitioning") == 1
    assert tree.count("HashAggregate") - base.count("HashAggregate") == 2


@pytest.fixture(scope="module")
def combined(spark, fact_small):
    return split_report_aggregates(store_rollup(spark, build_report_aggregates(fact_small)))


def test_one_pass_gives_the_rollup_and_the_grid(fact_small, rollup, combined):
    r, grid = combined
    assert _rows(r) == _rows(rollup)
    direct = C.discount_profit_density(fact_small)
    assert C.density_from_grid(grid).collect() == direct.collect()


def test_report_from_one_pass_equals_line_path(fact_small, combined):
    r, grid = combined
    direct = report_sections(fact_small)
    via = report_sections(fact_small, rollup=r, grid=grid)
    for name in direct:
        assert direct[name].collect() == via[name].collect(), name


def test_one_pass_reads_the_lines_once(spark, fact_small):
    stored = materialize(spark, fact_small)
    df = build_report_aggregates(stored)
    assert len(I.scans(df)) == 1
    tree = I.physical_section(df)
    assert tree.count("Expand") == 1 and tree.count("Exchange hashpartitioning") == 1


def test_a_rollup_refuses_another_threshold(spark, rollup):
    from ledgerline.config import AnalyticsConfig
    other = AnalyticsConfig(high_discount=0.02)
    with pytest.raises(Exception, match="not in a rollup"):
        K.kpi_discount_impact(rollup, other).collect()
    assert K.kpi_totals(rollup).count() == 1
