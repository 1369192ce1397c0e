"""Property tests on generated facts: the KPI row and a breakdown against a
plain-Python brute force (exact decimals, HALF_UP), the top-k tie rule, and
the rollup path against the line path. Generated rows include zero sales,
zero profit, ties, an empty high-discount band and discounts exactly at the
threshold."""

from __future__ import annotations

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerline.config import DEFAULT
from ledgerline.operators import breakdowns as B, claims as CL, kpis as K, queries as Q
from ledgerline.plans.rollup import build_rollup

SCHEMA = ("order_key bigint, region string, segment string, category string, "
          "sub_category string, ship_mode string, quantity double, discount double, "
          "sales decimal(18,2), profit decimal(18,4)")

rows = st.lists(st.tuples(
    st.sampled_from(["East", "West", "North"]),
    st.sampled_from(["Tech", "Office"]),
    st.sampled_from(["Binders", "Chairs", "Phones"]),
    st.sampled_from(["First", "Standard"]),
    st.integers(1, 5),
    st.sampled_from([0.0, 0.02, 0.08, 0.1]),
    st.integers(0, 50_000),            # sales in cents (0 allowed)
    st.integers(-2_000_000, 2_000_000).map(lambda v: v - v % 100),  # profit, 1/10000
), min_size=1, max_size=25)

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture,
                                           HealthCheck.too_slow])


def _df(spark, data):
    recs = [(i, r, "Consumer", c, s, m, float(q), d, Decimal(sc) / 100, Decimal(pc) / 10000)
            for i, (r, c, s, m, q, d, sc, pc) in enumerate(data)]
    return spark.createDataFrame(recs, SCHEMA)


def _cents(x: Decimal) -> float:
    return float(x.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


def _mean(values):
    return sum(values, Decimal(0)) / len(values) if values else None


@given(data=rows)
@SETTINGS
def test_kpi_summary_matches_brute_force(spark, data):
    got = K.kpi_summary(_df(spark, data)).first().asDict()
    sales = [Decimal(r[6]) / 100 for r in data]
    profit = [Decimal(r[7]) / 10000 for r in data]
    disc = [r[5] for r in data]
    n = len(data)
    assert got["total_orders"] == n
    assert got["total_sales"] == _cents(sum(sales))
    assert got["total_profit"] == _cents(sum(profit))
    assert got["profitable_orders"] == sum(p > 0 for p in profit)
    assert got["loss_orders"] == sum(p < 0 for p in profit)
    hi = [p for p, d in zip(profit, disc) if d >= DEFAULT.high_discount]
    zero = [p for p, d in zip(profit, disc) if d == 0]
    assert got["high_disc_count"] == len(hi)
    if sum(sales) == 0:
        assert got["profit_margin_pct"] is None
    else:
        assert got["profit_margin_pct"] == pytest.approx(
            float(sum(profit)) / float(sum(sales)) * 100, abs=0.006)
    for key, band in (("high_disc_avg_profit", hi), ("zero_disc_avg_profit", zero)):
        if not band:
            assert got[key] is None
        else:
            assert got[key] == pytest.approx(float(_mean(band)), abs=0.006)


@given(data=rows)
@SETTINGS
def test_region_breakdown_matches_brute_force(spark, data):
    got = [r.asDict() for r in B.breakdown_region(_df(spark, data)).collect()]
    acc = defaultdict(lambda: [Decimal(0), Decimal(0), 0])
    for r in data:
        a = acc[r[0]]
        a[0] += Decimal(r[6]) / 100
        a[1] += Decimal(r[7]) / 10000
        a[2] += 1
    # best-selling first, ties alphabetical (the exact sum decides, not the label)
    order = sorted(acc, key=lambda k: (-acc[k][0], k))
    assert [g["region"] for g in got] == order
    for g in got:
        s, p, n = acc[g["region"]]
        assert (g["total_sales"], g["total_profit"], g["total_orders"]) == (_cents(s), _cents(p), n)


@given(data=rows)
@SETTINGS
def test_top_k_ties_are_alphabetical(spark, data):
    got = [r.sub_category for r in Q.top_subcategory_profit(_df(spark, data)).collect()]
    acc = defaultdict(Decimal)
    for r in data:
        acc[r[2]] += Decimal(r[7]) / 10000
    rounded = {k: _cents(v) for k, v in acc.items()}
    assert got == sorted(rounded, key=lambda k: (-rounded[k], k))[:DEFAULT.top_k]


@given(data=rows)
@SETTINGS
def test_rollup_path_equals_line_path(spark, data):
    fact = _df(spark, data)
    rollup = build_rollup(fact)
    for fn in (K.kpi_summary, K.kpi_extremes, B.breakdown_all_dimensions,
               CL.subcategory_discount_band_profit, Q.profit_by_category):
        assert fn(fact).collect() == fn(rollup).collect(), fn.__name__
