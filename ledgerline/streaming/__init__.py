"""Incremental form of the CSV landing step (Structured Streaming).

The reference has no streaming operator; it reads one CSV that was copied
onto distributed storage. Here the same read -> normalise -> clean path runs
as a file stream, so new CSV part files dropped into a landing folder are
appended to the stored parquet fact exactly once (checkpointed), and any
report operator that is a plain aggregation can run as a continuously
updated result over the stream.
"""

from ledgerline.streaming.ingest import (  # noqa: F401
    ingest_to_parquet, running_report, running_rollup, stream_sales_csv,
)
