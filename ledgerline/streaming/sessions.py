"""Sessions and interval joins over event streams, with bounded state.

A session is a user's events with no gap of more than ``GAP`` between them. The same
expression runs on a batch and on a stream; on a stream the watermark says when a
session is final: it is given out once, and its state goes. Events later than the
watermark are dropped by Spark and counted in the query's progress, which is the
bound on how long state is kept.

``joined_streams`` pairs purchases with the clicks of the same user in the hour
before. Both sides carry watermarks and the join has a time bound, so Spark drops
a row of either side once no partner can come any more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

GAP = "30 minutes"
LATENESS = "2 hours"
EVENT_SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def sessions(events: DataFrame, gap: str = GAP) -> DataFrame:
    """One row per session: user, its start, events, purchases and value.
    Events without a user or time are left out."""
    rows = events.where("user_id is not null and ts is not null")
    return rows.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(
        F.count("*").alias("n_events"), F.count_if(F.col("event_type") == "purchase").alias("n_purchases"),
        F.sum(F.col("value").cast("decimal(18,2)")).alias("value")).select(
        "user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n_events", "n_purchases", "value")


def session_report(events: DataFrame, gap: str = GAP) -> DataFrame:
    """The sessions with their times as microseconds."""
    return sessions(events, gap).select(
        "user_id", F.unix_micros("start").alias("start_us"), (F.unix_micros("end") - F.unix_micros("start")).alias("span_us"),
        "n_events", "n_purchases", F.col("value").cast("double").alias("value"))


def session_stream(events: DataFrame, out_dir: str, checkpoint: str, gap: str = GAP,
                   lateness: str = LATENESS) -> StreamingQuery:
    """Append every final session to a parquet table, exactly once across
    restarts (``checkpoint`` belongs to the table and is given again)."""
    found = sessions(events.withWatermark("ts", lateness), gap)
    return (found.writeStream.format("parquet").outputMode("append").option("path", out_dir)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def clicks_before(purchases: DataFrame, clicks: DataFrame, within: str = "1 hour") -> DataFrame:
    """Pairs of a purchase and a click of the same user in the time before it;
    the same on batches and, with watermarks, on streams."""
    p = purchases.select(F.col("event_id").alias("purchase_id"), F.col("user_id").alias("buyer"), F.col("ts").alias("bought"))
    c = clicks.select(F.col("event_id").alias("click_id"), "user_id", F.col("ts").alias("clicked"))
    return p.join(c, F.expr(f"buyer = user_id and clicked <= bought and clicked >= bought - interval {within}")).select(
        "purchase_id", "click_id", "user_id")


def joined_streams(events: DataFrame, more: DataFrame, out_dir: str, checkpoint: str, within: str = "1 hour",
                   lateness: str = LATENESS) -> StreamingQuery:
    """``clicks_before`` over two streams of events, appended to a table."""
    purchases = events.where("event_type = 'purchase'").withWatermark("ts", lateness)
    clicks = more.where("event_type = 'click'").withWatermark("ts", lateness)
    return (clicks_before(purchases, clicks, within).writeStream.format("parquet").outputMode("append")
            .option("path", out_dir).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
