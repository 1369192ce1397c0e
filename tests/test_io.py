"""Sinks: CSV round trip and the whole report written by Spark."""

from __future__ import annotations

import os

import pytest

from ledgerline.operators import queries as Q
from ledgerline.plans.report import run_report
from ledgerline.sources.catalog import describe_schema, preview
from ledgerline.sources.sinks import write_result


def test_csv_round_trip(spark, fact_small, tmp_out):
    df = Q.region_category_profit(fact_small)
    path = write_result(df, os.path.join(tmp_out, "sql_results"), single_file=True)
    back = spark.read.option("header", True).schema(df.schema).csv(path)
    assert sorted(back.collect()) == sorted(df.collect())


def test_report_writes_every_section(spark, fact_small, tmp_out):
    written = run_report(spark, fact_small, tmp_out, split_mode="stable")
    for name, path in written.items():
        assert os.path.exists(os.path.join(path, "_SUCCESS")), name
    assert {"sql_results", "ml_predictions", "ml_metrics"} <= set(written)


def test_schema_listing_and_preview(spark, fact_small):
    cols = [r.column for r in describe_schema(spark, fact_small).orderBy("position").collect()]
    assert cols == fact_small.columns
    p = preview(Q.sales_profit_by_region(fact_small), 2, ["region"]).collect()
    assert len(p) == 2 and p[0].region < p[1].region


class _FakeConf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class _FakeContext:
    def __init__(self, master, conf=None):
        self.master, self._conf, self.dir = master, _FakeConf(conf or {}), None

    def getCheckpointDir(self):
        return self.dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, d):
        self.dir = d


class _FakeSession:
    def __init__(self, master, conf=None):
        self.sparkContext = _FakeContext(master, conf)
        self.conf = _FakeConf(conf or {})


def test_cluster_without_checkpoint_dir_is_refused():
    from ledgerline.session import ensure_checkpoint_dir
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_FakeSession("yarn"))
    shared = {"spark.checkpoint.dir": "hdfs:///shared/ckpt"}
    assert ensure_checkpoint_dir(_FakeSession("yarn", shared)) == "hdfs:///shared/ckpt"
    assert ensure_checkpoint_dir(_FakeSession("local[4]"))      # tests: a scratch folder


def test_run_report_script(spark, tmp_out):
    import importlib.util
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                        "scripts", "run_report.py")
    spec = importlib.util.spec_from_file_location("run_report_script", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    from ledgerline.session import sizing_conf
    keys = list(sizing_conf(1, 1))                    # the settings main() sizes
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        written = mod.main(["--star", "/root/testdata/sf0.001", "--out", f"{tmp_out}/job",
                            "--no-ml"])
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "sql_results" in written and "kpi_summary" in written and "ml_predictions" not in written
    kpi = spark.read.option("header", "true").csv(written["kpi_summary"]).first()
    assert int(kpi["total_orders"]) == 6000
