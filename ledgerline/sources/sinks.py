"""Sinks (S4, S5, S11): results written as files by Spark.

Each output is written with a commit protocol (task attempts write to a
staging folder, the job commit publishes them), so a lost executor only
re-runs its tasks. Small results may be collapsed to one part file; large
ones (predictions, per-row series) keep their parallelism.
"""

from __future__ import annotations

from collections.abc import Callable, Collection
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

# Independent report sections submitted at once: each is a small job over
# aggregated rows, so several run side by side instead of queueing.
CONCURRENT_JOBS = 8


def write_result(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite",
                 single_file: bool = False, partition_by: list[str] | None = None) -> str:
    """Write one result DataFrame (header on for CSV). ``single_file`` is for
    small results: a repartition, so that the work before it stays parallel."""
    out = df.repartition(1) if single_file else df
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", "true").csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    elif fmt == "json":
        writer.json(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return path


def run_concurrently(items: dict[str, DataFrame], action: Callable[[str, DataFrame], object],
                     workers: int = CONCURRENT_JOBS) -> dict[str, object]:
    """Run ``action(name, df)`` for every item, up to ``workers`` Spark jobs
    at a time (one driver thread each; Spark schedules their tasks side by
    side). Returns each action's result by name; the first failure is raised."""
    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        futures = {name: pool.submit(action, name, df) for name, df in items.items()}
        return {name: f.result() for name, f in futures.items()}


def write_report(sections: dict[str, DataFrame], root: str, fmt: str = "csv",
                 workers: int = CONCURRENT_JOBS, single_file: Collection[str] = ()) -> dict[str, str]:
    """S11 re-aimed: every report section (breakdown tables, KPI rows, chart
    series) as its own dataset under ``root``, the independent writes running
    concurrently. The sections named in ``single_file`` go to one file each;
    the others keep their parallelism."""
    def write(name: str, df: DataFrame) -> str:
        return write_result(df, f"{root.rstrip('/')}/{name}", fmt=fmt, single_file=name in single_file)
    return run_concurrently(sections, write, workers)
