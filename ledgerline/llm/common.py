"""Shared helpers of the training-data operators: scratch tables, file
access inside tasks, partition sizing and connected components."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.session import ensure_checkpoint_dir, scratch_path

TARGET_BYTES = 128 * 1024 * 1024
LINKS_PER_TASK = 250_000
SLICE_BYTES = 4 * 1024 * 1024

# ASCII upper case to lower case, every other byte unchanged
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: cuts
    the lineage, survives lost executors, and the re-read is a plain scan that
    adaptive execution can split when its join key is skewed."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def drop_stored(*tables: DataFrame) -> None:
    """Delete the files of tables made by ``stored`` once nothing reads them."""
    for df in tables:
        delete_folder(df.sparkSession, df.scratch)


class Scratch:
    """Stored tables that a later step has no use for: ``with Scratch() as
    scratch`` deletes them at the end of the block, so only what a lazy result
    still reads stays behind."""

    def __enter__(self) -> Scratch:
        self.tables: list[DataFrame] = []
        return self

    def __exit__(self, *_) -> None:
        drop_stored(*self.tables)

    def store(self, df: DataFrame, name: str) -> DataFrame:
        return self.own(stored(df, name))

    def own(self, df: DataFrame) -> DataFrame:
        self.tables.append(df)
        return df


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder URI below the shared checkpoint folder that tasks can
    open with ``open_fs``."""
    path = scratch_path(spark, name)
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return path


def open_fs(uri: str):
    """``(filesystem, path)`` for a URI, inside a task. pyarrow's filesystems
    reach local, HDFS, S3 and GCS folders alike."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def local_path(uri: str) -> str | None:
    """The plain path of a URI on a mounted file system, else None."""
    if uri.startswith("file://"):
        return uri[len("file://"):]
    return uri if uri.startswith("/") else None


def sized_partitions(df: DataFrame, column: str, target: int = TARGET_BYTES) -> int:
    """Partitions that give each about ``target`` bytes of ``column`` (one
    pruned scan), and at least one wave of the session's shuffle setting."""
    total = df.agg(F.sum(F.octet_length(column))).first()[0] or 0
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-int(total) // target), 1)


def raw_texts(column: pa.Array) -> list[bytes]:
    """An Arrow string column as UTF-8 bytes; null counts as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that tasks
    can import it however the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut down to about ``SLICE_BYTES``, so that what a task makes of a
    batch in Python stays small however long the texts are."""
    for b in batches:
        rows = max(1, b.num_rows * SLICE_BYTES // max(b.nbytes, 1))
        for at in range(0, max(b.num_rows, 1), rows):
            yield b.slice(at, rows)


def _give_back() -> None:
    """Return freed memory to the system: a worker process outlives its task
    and waits beside the next one's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass                    # another C library


def _bounded_memory(fn):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(_slices(batches))
        finally:
            _give_back()
    return run


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema) -> DataFrame:
    """``mapInArrow`` by a function of this package, over slices of bounded
    size and with its memory given back at the end of the task."""
    ship(df.sparkSession)
    return df.mapInArrow(_bounded_memory(fn), schema)


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node per node, for undirected ``edges(a, b)``.

    Alternating large-star and small-star rounds (Kiveris et al., 2014):
    every round rewires neighbours to the smallest one they see, so chains
    fold in a logarithmic number of rounds. Each round is written to the
    checkpoint folder; the per-node minimum is written too, so the join back
    is between two scans and a node with very many links is split by adaptive
    skew handling. Returns the stored table ``(node, root)`` of every node with
    a link. Self-links, repeated links and null ends are ignored; no links give
    an empty table.
    """
    edges = stored(_ordered(edges), "cc-edges")
    before = _signature(edges)
    while True:
        # few links need few tasks, however many partitions the session has
        tasks = max(1, -(-2 * before[0] // LINKS_PER_TASK))
        large = _star(edges, True, tasks)
        small = _star(large, False, tasks)
        drop_stored(large, edges)
        edges, after = small, _signature(small)
        changed, before = after != before, after
        if not changed:
            nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            out = stored(nodes.unionByName(roots).coalesce(tasks), "cc-roots")
            drop_stored(edges)
            return out


def _ordered(edges: DataFrame) -> DataFrame:
    """Links as (larger, smaller), each once."""
    return (edges.where(F.col("a") != F.col("b"))
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _signature(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, both: bool, tasks: int) -> DataFrame:
    """One star round over links (a > b). Large-star looks at every neighbour
    and moves the larger ones to the smallest; small-star looks at the smaller
    neighbours and moves them, and the node itself, to the smallest."""
    if both:
        seen = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        seen = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = stored(seen.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).coalesce(tasks), "cc-min")
    joined = seen.join(least, "u")
    if both:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    out = stored(out.where(F.col("a") != F.col("b")).distinct().coalesce(tasks), "cc-edges")
    drop_stored(least)
    return out
