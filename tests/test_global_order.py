"""Global running totals, calendars and exact quantiles against plain Python."""

from __future__ import annotations

import random
from datetime import date
from decimal import Decimal
from math import ceil

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import calendar as CAL, global_order as G, quantiles as Q
from ledgerline.plans import inspect as I
from ledgerline.sources.tables import with_order_date


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_running_equals_plain_loop(spark, descending, partitions):
    rng = random.Random(partitions)
    # one value on a third of the rows, split by the tie column
    rows = [(i, rng.choice([None, 5, 5, 5, *range(20)]), rng.choice([None, Decimal(f"{rng.randrange(-99, 99)}.25")]))
            for i in range(300)]
    df = spark.createDataFrame(rows, "id long, x int, v decimal(18,2)").repartition(4)
    got = G.running(df, "x", ["id"], value="v", descending=descending, partitions=partitions)
    assert got.columns == ["id", "x", "v", "row_number", "dense_rank", "running_total"]
    key = (lambda r: (r[1] is None, -(r[1] or 0), r[0])) if descending else (lambda r: (r[1] is not None, r[1] or 0, r[0]))
    total, ranks, want = Decimal(0), [], []
    for n, (i, x, v) in enumerate(sorted(rows, key=key), 1):
        total += v or 0
        if x not in ranks:
            ranks.append(x)
        want.append((n, i, ranks.index(x) + 1, total))
    assert sorted((r["row_number"], r["id"], r["dense_rank"], r["running_total"]) for r in got.collect()) == want


def test_no_task_sees_all_rows(spark, fact_small):
    out = G.sales_running_totals(fact_small, partitions=8)
    tree = I.physical_section(out)
    assert "SinglePartition" not in tree and "Window" in tree
    sizes = [r["n"] for r in G.ranged(fact_small, [F.col("sales")], 8).groupBy("_part").agg(
        F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 3 * sum(sizes) / 8


def test_running_over_nothing(spark):
    df = spark.createDataFrame([], "id long, x int, v decimal(18,2)")
    assert G.running(df, "x", ["id"], value="v").count() == 0


def test_open_lines_count(spark):
    lines = spark.createDataFrame([(1, 1, 5), (1, 5, 9), (2, 3, 3), (2, 9, 4), (3, None, 4)], "k long, a long, b long")
    lines = lines.select(F.timestamp_seconds("a").alias("order_date"), F.timestamp_seconds("b").alias("l_shipdate"))
    moments = spark.createDataFrame([(i, i) for i in range(11)] + [(99, None)], "event_id long, s long").select(
        "event_id", F.timestamp_seconds("s").alias("at"))
    got = {r["event_id"]: r["open_lines"] for r in G.open_lines_count(moments, lines, 3).collect()}
    assert got == {i: sum(a <= i < b for a, b in ((1, 5), (5, 9))) for i in range(11)}


def dated(spark, rows):
    return spark.createDataFrame([(r, d, Decimal(s), Decimal(p)) for r, d, s, p in rows],
                                 "region string, order_date date, sales decimal(18,2), profit decimal(18,4)")


def test_empty_quarters_are_filled(spark):
    fact = dated(spark, [("A", date(2020, 2, 3), "10.00", "1"), ("A", date(2021, 3, 31), "15.00", "2"),
                         ("A", date(2021, 1, 1), "5.00", "2"), (None, date(2021, 12, 31), "7.00", "-1"),
                         ("B", None, "99.00", "1")])
    rows = {(r["region"], r["year"], r["quarter"]): r for r in CAL.quarterly_sales(fact).collect()}
    assert len(rows) == 2 * 8
    a = rows["A", 2021, 1]
    assert (a["total_sales"], a["total_orders"], a["trailing_year_sales"], a["yoy_pct"]) == (20.0, 2, 20.0, 100.0)
    gap = rows["A", 2020, 4]
    assert (gap["total_sales"], gap["total_orders"], gap["trailing_year_sales"], gap["yoy_pct"]) == (0.0, 0, 10.0, None)
    assert rows["A", 2021, 4]["trailing_year_sales"] == 20.0 and rows["A", 2020, 1]["yoy_pct"] is None
    assert rows[None, 2021, 4]["total_sales"] == 7.0


def test_best_year_and_peaks(spark):
    fact = dated(spark, [("A", date(2020, 11, 3), "10.00", "1"), ("A", date(2021, 3, 1), "6.00", "2"),
                         ("B", date(2021, 4, 1), "4.00", "2"), ("B", None, "50.00", "1")])
    assert CAL.best_year(fact).collect() == [(2020, 10.0)]            # equal years: the earlier
    assert sorted(CAL.peak_quarters(fact).collect()) == [(2020, 4, 10.0, 100.0, True), (2021, 1, 10.0, 0.0, False)]
    assert CAL.best_year(fact.where("false")).count() == 0


@pytest.mark.parametrize("bins", [2, 7, 1024])
def test_quantiles_equal_the_sorted_values(spark, bins):
    rng = random.Random(bins)
    rows = [(rng.choice(["a", "a", "a", "b", None]), Decimal(rng.randrange(-10 ** 9, 10 ** 9)) / 10 ** 4)
            for _ in range(400)]
    rows += [("one", Decimal("3.5")), ("tie", Decimal("-2.25")), ("tie", Decimal("-2.25")), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v decimal(18,4)").repartition(5)
    got = Q.grouped_quantiles(df, ["g"], "v", {"low": "0", "median": "0.5", "p95": "0.95", "top": "1"}, bins=bins)
    found = {r["g"]: r for r in got.collect()}
    groups: dict = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert set(found) == set(groups)
    for g, values in groups.items():
        values.sort()
        want = [values[max(1, ceil(p * len(values) / 100)) - 1] for p in (0, 50, 95, 100)]
        assert [found[g][c] for c in ("low", "median", "p95", "top")] == want and found[g]["n"] == len(values)


def test_no_group_is_sorted_or_collected(spark):
    """The rows meet only a partial count per bin: a hot group ships bins, not rows."""
    df = spark.createDataFrame([("hot", i) for i in range(5000)] + [("cold", 1)], "g string, v int")
    out = Q.grouped_quantiles(df.withColumn("v", F.col("v").cast("decimal(18,4)")), ["g"], "v", {"m": "0.5"})
    assert {r["g"]: r["m"] for r in out.collect()} == {"hot": Decimal(2499), "cold": Decimal(1)}
    assert "collect_list" not in I.physical_section(out)


def test_order_dates_join_the_same_in_both_shapes(spark, fact_small, monkeypatch):
    import ledgerline.sources.tables as tables
    from conftest import SF_SMALL
    small = with_order_date(spark, SF_SMALL, fact_small)
    assert "SortMergeJoin" not in I.physical_section(small)
    monkeypatch.setattr(tables, "small_tables", lambda t: {"orders": False})
    large = with_order_date(spark, SF_SMALL, fact_small)
    assert "SortMergeJoin" in I.physical_section(large)
    assert sorted(CAL.peak_quarters(small).collect()) == sorted(CAL.peak_quarters(large).collect())
