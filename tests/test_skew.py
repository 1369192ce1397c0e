"""A hot key in the shuffle shape: one part key holds about a third of all
order lines. AQE must split the skewed sort-merge join partition (the final
plan marks the join ``skew=true``) and the answer must equal the broadcast
shape's on the same tables."""

from __future__ import annotations

import contextlib

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.operators import breakdowns as B, queries as Q
from ledgerline.plans.inspect import physical_section
from ledgerline.session import scratch_path
from ledgerline.sources.star import STAR_TABLES, bind_fact, read_table

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@contextlib.contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.fixture(scope="module")
def skewed_dir(spark):
    """The sf0.001 star tables with every line discounted 7 % or more (about a
    third of them) moved to one hot part (a test fixture, written below the
    checkpoint folder)."""
    root = scratch_path(spark, "skewed-star")
    hot = read_table(spark, SF_SMALL, "part").agg(F.min("p_partkey")).first()[0]
    for t in STAR_TABLES:
        df = read_table(spark, SF_SMALL, t)
        if t == "lineitem":
            df = df.withColumn("l_partkey", F.when(F.col("l_discount") >= 0.07, F.lit(hot))
                               .otherwise(F.col("l_partkey")))
        df.repartition(4).write.parquet(f"{root}/{t}.parquet")
    return root


def test_hot_part_is_a_third_of_lines(spark, skewed_dir):
    lines = spark.read.parquet(f"{skewed_dir}/lineitem.parquet")
    top = lines.groupBy("l_partkey").count().orderBy(F.desc("count")).first()["count"]
    assert top >= 0.3 * lines.count()


def test_aqe_splits_the_skewed_join(spark, skewed_dir):
    with conf(spark, SKEW_CONF):
        large = bind_fact(spark, skewed_dir, max_broadcast_rows=0)
        df = Q.sales_profit_by_region(large)
        got = df.collect()
        final = physical_section(df)
    assert "isFinalPlan=true" in final
    assert "skew=true" in final
    small = bind_fact(spark, skewed_dir)
    assert got == Q.sales_profit_by_region(small).collect()
    assert sorted(B.breakdown_all_dimensions(large).collect()) == sorted(
        B.breakdown_all_dimensions(small).collect())
