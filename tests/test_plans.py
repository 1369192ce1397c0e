"""Plan checks: exchanges, pushdown, pruning, top-k, no Python in the plan,
and both join shapes of the star binding giving the same answers."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from ledgerline.operators import breakdowns as B, filters as FL, kpis as K, queries as Q
from ledgerline.plans import inspect as I
from ledgerline.plans.fact import is_derived, materialize
from ledgerline.sources.star import bind_fact


@pytest.fixture(scope="module")
def stored(spark, fact_small):
    return materialize(spark, fact_small)


def test_grouped_query_has_one_hash_exchange(stored):
    tree = I.physical_section(Q.sales_profit_by_region(stored))
    assert tree.count("Exchange hashpartitioning") == 1
    assert "HashAggregate" in tree


def test_topk_uses_take_ordered(stored):
    assert I.count_nodes(Q.top_subcategory_profit(stored), "TakeOrderedAndProject") == 1


def test_scan_reads_only_needed_columns(stored):
    schemas = I.scans(Q.sales_profit_by_region(stored))
    assert len(schemas) == 1
    assert schemas[0].startswith("struct<region:string,sales:decimal(18,2),profit:decimal(18,4)>")


def test_filter_pushed_to_parquet(stored):
    text = I.plan_text(FL.loss_orders(stored))
    assert "PushedFilters: [IsNotNull(profit), LessThan(profit,0" in text


def test_kpi_summary_single_scan(stored):
    df = K.kpi_summary(stored)
    assert len(I.scans(df)) == 1
    assert I.physical_section(df).count("Exchange") == 1   # the final single-partition merge


def test_grouping_sets_single_scan(stored):
    assert len(I.scans(B.breakdown_all_dimensions(stored))) == 1
    assert len(I.scans(K.kpi_extremes(stored))) == 1


def test_no_python_in_any_query(spark):
    for name, fn in E._retail_queries().items():
        assert not I.has_python(fn(spark, SF_SMALL)), name


def test_small_star_is_broadcast_pipeline(fact_small):
    tree = I.physical_section(fact_small)
    assert "SortMergeJoin" not in tree
    assert tree.count("BroadcastHashJoin") == 5


def test_large_shape_matches_small_shape(spark, fact_small):
    large = bind_fact(spark, SF_SMALL, max_broadcast_rows=0)   # pretend nothing fits
    tree = I.physical_section(large)
    assert "SortMergeJoin" in tree and "BroadcastHashJoin" not in tree
    a = sorted(B.breakdown_all_dimensions(fact_small).collect())
    b = sorted(B.breakdown_all_dimensions(large).collect())
    assert a == b


def test_byte_bound_also_decides_broadcast(spark, fact_small):
    tight = bind_fact(spark, SF_SMALL, max_broadcast_bytes=1)   # rows fit, bytes do not
    tree = I.physical_section(tight)
    assert "SortMergeJoin" in tree and "BroadcastHashJoin" not in tree
    assert sorted(K.kpi_summary(tight).collect()) == sorted(K.kpi_summary(fact_small).collect())


def test_measured_size_is_the_unsafe_row_size(spark):
    from ledgerline.plans.strategy import measured
    from ledgerline.sources.star import dimension
    region = dimension(spark, SF_SMALL, "region")
    names = [r.r_name for r in region.collect()]
    # null bits (8) + two 8-byte fields + the name rounded up to 8 bytes
    expected = sum(24 + -(-len(n.encode()) // 8) * 8 for n in names)
    assert measured({"region": region}) == {"region": (len(names), expected)}


def test_broadcast_bound_holds_for_the_sum(spark):
    from ledgerline.plans.strategy import measured
    from ledgerline.sources.star import DIM_COLUMNS, broadcastable, dimension
    sizes = {t: b for t, (_, b) in measured({t: dimension(spark, SF_SMALL, t) for t in DIM_COLUMNS}).items()}
    assert all(broadcastable(spark, SF_SMALL, max_bytes=sum(sizes.values())).values())
    small = broadcastable(spark, SF_SMALL, max_bytes=sum(sizes.values()) - 1)
    assert [t for t, ok in small.items() if not ok] == [max(sizes, key=sizes.get)]


def test_spread_hashes_the_join_keys(spark):
    from ledgerline.plans.strategy import spread
    from ledgerline.sources.star import line_side
    lines = line_side(spark, SF_SMALL)
    text = I.physical_section(spread(spark, lines, ["l_orderkey", "l_partkey"]))
    if lines.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism:
        part = text[text.index("hashpartitioning("):].split(")")[0]
        assert "l_orderkey" in part and "l_partkey" in part and "l_quantity" not in part


def test_raw_row_count_reads_the_keys_only(spark):
    raw = bind_fact(spark, SF_SMALL, raw=True)
    lines = [x for x in I.scans(FL.row_count(raw)) if "l_" in x]
    assert lines == ["struct<l_orderkey:bigint,l_partkey:bigint>"]


def test_shuffle_shape_starts_with_sized_partitions(spark):
    from ledgerline.session import start_partitions
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    try:
        n = start_partitions(spark, 40 * 1024 ** 3)
        assert n >= 160 and int(spark.conf.get(key)) == n
        assert start_partitions(spark, 1) == n                # never fewer than are in force
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_each_side_that_passed_is_broadcast(spark):
    from ledgerline.plans.strategy import measured
    from ledgerline.sources.star import DIM_COLUMNS, dimension
    sizes = {t: b for t, (_, b) in measured({t: dimension(spark, SF_SMALL, t) for t in DIM_COLUMNS}).items()}
    big = max(sizes, key=sizes.get)                            # the orders
    tree = I.physical_section(bind_fact(spark, SF_SMALL, max_broadcast_bytes=sum(sizes.values()) - 1))
    assert big == "orders" and tree.count("SortMergeJoin") == 1 and tree.count("BroadcastHashJoin") == 4


def _copy(spark, root, tables):
    from ledgerline.sources.star import STAR_TABLES
    for t in STAR_TABLES:
        tables.get(t, spark.read.parquet(f"{SF_SMALL}/{t}.parquet")).write.parquet(f"{root}/{t}.parquet")


def test_appended_rows_are_seen(spark, tmp_path):
    root = str(tmp_path)
    _copy(spark, root, {})
    assert FL.row_count(bind_fact(spark, root)).first()[0] == 6000
    spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").limit(1000).write.mode("append").parquet(
        f"{root}/lineitem.parquet")
    assert FL.row_count(bind_fact(spark, root)).first()[0] == 7000


def test_a_grown_dimension_is_no_longer_broadcast(spark, tmp_path):
    root, bound = str(tmp_path), 2000
    _copy(spark, root, {})
    shape = lambda: I.physical_section(bind_fact(spark, root, max_broadcast_rows=bound))
    assert "SortMergeJoin" not in shape()
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet").collect()
    schema = spark.read.parquet(f"{SF_SMALL}/part.parquet").schema
    grown = [r.asDict() | {"p_partkey": r["p_partkey"] + 10_000 * k} for k in range(20) for r in part]
    spark.createDataFrame(grown, schema).write.mode("overwrite").parquet(f"{root}/part.parquet")
    assert shape().count("SortMergeJoin") == 1


def test_cleaning_is_on_the_main_path(spark, tmp_path):
    root = str(tmp_path)
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    _copy(spark, root, {"orders": orders.withColumn(
        "o_orderpriority", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")))})
    clean, raw = bind_fact(spark, root), bind_fact(spark, root, raw=True)
    assert clean.where("ship_mode is null").count() == 0 < raw.where("ship_mode is null").count()
    for fact in (clean, raw):
        top = K.kpi_extremes(fact).first()
        assert top["top_ship_mode"] is not None
        assert None not in [r[0] for r in Q.sales_by_ship_mode(fact).collect()]
        assert not [r for r in B.breakdown_all_dimensions(fact).collect()
                    if r["dimension"] != "all" and r["dim_value"] is None]
    assert raw.count() > clean.count()


def test_sizing_conf_scales_with_the_shuffle():
    from ledgerline.session import MAX_SHUFFLE_PARTITIONS, sizing_conf
    small = sizing_conf(10 * 1024 * 1024, 8)
    assert small["spark.sql.shuffle.partitions"] == "8"          # one full wave
    mid = sizing_conf(1024 ** 4, 400)                           # 1 TiB on 400 cores
    parts = int(mid["spark.sql.shuffle.partitions"])
    assert parts % 400 == 0 and 1024 ** 4 / parts <= 256 * 1024 * 1024
    huge = sizing_conf(10 ** 17, 8000)
    assert int(huge["spark.sql.shuffle.partitions"]) == MAX_SHUFFLE_PARTITIONS


def test_line_shuffle_estimate_uses_footer_count(spark):
    from ledgerline.sources.star import LINE_EXCHANGE_ROW_BYTES, line_shuffle_bytes, read_table
    n = read_table(spark, SF_SMALL, "lineitem").count()
    assert line_shuffle_bytes(spark, SF_SMALL) == n * LINE_EXCHANGE_ROW_BYTES


def test_kpi_extremes_needs_no_window(stored):
    assert "Window" not in I.physical_section(K.kpi_extremes(stored))


def test_row_level_sections_keep_their_parallelism(spark, stored, tmp_path):
    from ledgerline.operators.charts import discount_profit_points
    from ledgerline.sources.sinks import write_report
    points = discount_profit_points(stored.repartition(4))
    paths = write_report({"discount_profit_points": points, "top": Q.sales_profit_by_region(stored)},
                         str(tmp_path), single_file=["top"])
    files = lambda p: [f for f in os.listdir(p) if f.startswith("part-")]
    assert len(files(paths["discount_profit_points"])) == 4 and len(files(paths["top"])) == 1


def test_derived_plans_are_told_by_their_nodes(spark, stored):
    assert is_derived(Q.sales_profit_by_region(stored))
    assert not is_derived(stored.withColumnRenamed("region", "SortMergeJoin Exchange"))
