"""File-stream ingest of the retail CSV and running reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ledgerline.config import DEFAULT, AnalyticsConfig
from ledgerline.operators.cleaning import clean
from ledgerline.plans.rollup import build_rollup
from ledgerline.sources.csv import to_model


def stream_sales_csv(spark: SparkSession, landing_dir: str, schema: StructType,
                     max_files_per_trigger: int | None = None, do_clean: bool = True) -> DataFrame:
    """A streaming DataFrame of model rows from CSV files in ``landing_dir``.

    ``schema`` lists the CSV header's columns as they are written
    (``sources.csv.text_schema``; a stream cannot infer it); all are read as
    text and typed by ``to_model`` exactly like the batch path. A file with
    other columns, or the same in another order, fails the query.
    """
    as_text = StructType([StructField(f.name, StringType(), True) for f in schema.fields])
    reader = spark.readStream.schema(as_text).option("header", "true").option(
        "enforceSchema", "false")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    fact = to_model(reader.csv(landing_dir))
    return clean(fact) if do_clean else fact


def ingest_to_parquet(stream_fact: DataFrame, out_dir: str, checkpoint: str,
                      available_now: bool = True) -> StreamingQuery:
    """Append the cleaned rows to a parquet table (the stored fact).

    The file sink plus ``checkpoint``, a shared folder that belongs to this
    table and is given again on every run, gives exactly-once output across
    restarts and lost executors.
    """
    writer = (stream_fact.writeStream.format("parquet").outputMode("append")
              .option("path", out_dir).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()


def running_report(stream_fact: DataFrame, op: Callable[[DataFrame], DataFrame],
                   sink: Callable[[DataFrame, int], None], checkpoint: str,
                   available_now: bool = True) -> StreamingQuery:
    """Keep an aggregate report (e.g. ``queries.sales_profit_by_region``)
    up to date over the stream.

    The state holds one row per group key, so it is bounded by the key
    cardinality, not by the data. Each micro-batch hands the complete,
    current report to ``sink(df, batch_id)`` (write a table, update a
    dashboard store, ...).
    """
    writer = (op(stream_fact).writeStream.outputMode("complete")
              .option("checkpointLocation", checkpoint).foreachBatch(sink))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()


def running_rollup(stream_fact: DataFrame, sink: Callable[[DataFrame, int], None],
                   checkpoint: str, cfg: AnalyticsConfig = DEFAULT,
                   available_now: bool = True) -> StreamingQuery:
    """The whole report over a stream with ONE stateful aggregation.

    The state is the report rollup (``plans.rollup.build_rollup``): one row
    per dimension combination, so it is bounded by the dimensions'
    cardinalities however long the stream runs. Each micro-batch hands the
    complete current rollup to ``sink``, which derives any aggregate section
    from it (``plans.report.report_sections(..., rollup=df)`` or a single
    operator) without touching the stream's lines again.
    """
    return running_report(stream_fact, lambda f: build_rollup(f, cfg), sink, checkpoint, available_now)
