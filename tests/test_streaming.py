"""The streaming ingest gives the same fact as the batch path."""

from __future__ import annotations

import os
import tempfile

from test_fixtures import HEADER, ROWS

from ledgerline.config import RETAIL
from ledgerline.operators import breakdowns as B, kpis as K, queries as Q
from ledgerline.sources.csv import load_retail_fact, text_schema
from ledgerline.streaming import (
    ingest_to_parquet, running_report, running_rollup, stream_sales_csv,
)


def _folder():
    return tempfile.mkdtemp(prefix="ledgerline-stream-")


def _landing():
    d = tempfile.mkdtemp(prefix="ledgerline-landing-")
    for i in range(0, len(ROWS), 3):     # three part files
        with open(os.path.join(d, f"part-{i}.csv"), "w") as f:
            f.write(HEADER + "\n" + "\n".join(ROWS[i:i + 3]) + "\n")
    return d


def test_stream_ingest_equals_batch(spark):
    landing = _landing()
    out = tempfile.mkdtemp(prefix="ledgerline-stream-out-")
    schema = text_schema(spark, landing)
    q = ingest_to_parquet(stream_sales_csv(spark, landing, schema), out, _folder())
    q.awaitTermination(120)
    streamed = spark.read.parquet(out)
    batch = load_retail_fact(spark, landing)
    cols = ["region", "sub_category", "sales", "profit"]
    assert sorted(streamed.select(cols).collect()) == sorted(batch.select(cols).collect())


def test_running_report_equals_batch(spark):
    landing = _landing()
    schema = text_schema(spark, landing)
    seen = {}

    def sink(df, batch_id):
        seen["rows"] = sorted(df.collect())

    q = running_report(stream_sales_csv(spark, landing, schema), Q.sales_profit_by_region, sink, _folder())
    q.awaitTermination(120)
    batch = sorted(Q.sales_profit_by_region(load_retail_fact(spark, landing)).collect())
    assert seen["rows"] == batch


def test_running_rollup_feeds_every_section(spark):
    landing = _landing()
    schema = text_schema(spark, landing)
    seen = {}

    def sink(df, batch_id):
        seen["kpi"] = K.kpi_summary(df, RETAIL).collect()
        seen["all"] = sorted(B.breakdown_all_dimensions(df).collect())

    q = running_rollup(stream_sales_csv(spark, landing, schema), sink, _folder(), RETAIL)
    q.awaitTermination(120)
    fact = load_retail_fact(spark, landing)
    assert seen["kpi"] == K.kpi_summary(fact, RETAIL).collect()
    assert seen["all"] == sorted(B.breakdown_all_dimensions(fact).collect())


def test_restart_takes_up_new_files(spark):
    landing, out, checkpoint = _landing(), _folder(), _folder()
    schema = text_schema(spark, landing)

    def run():
        ingest_to_parquet(stream_sales_csv(spark, landing, schema, do_clean=False), out,
                          checkpoint).awaitTermination(120)
        return spark.read.parquet(out).count()
    assert run() == len(ROWS)
    with open(os.path.join(landing, "part-9.csv"), "w") as f:
        f.write(HEADER + "\n" + "\n".join(ROWS[:5]) + "\n")
    assert run() == len(ROWS) + 5
    assert run() == len(ROWS) + 5
