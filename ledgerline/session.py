"""Session helpers: sensible defaults for the analytics workload and the
shared checkpoint folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
import warnings

from pyspark.sql import SparkSession

# Session settings the library relies on. AQE coalesces the many small shuffle
# partitions of low-cardinality group-bys and splits skewed join partitions
# (a hot part or customer key); the broadcast threshold is the size check that
# decides when a dimension is shipped whole instead of shuffled.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Spark's default 10 MB: static broadcast only for scans whose files are
    # that small; AQE re-checks with the measured shuffle size at run time.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
}


# Partition sizing (see ``sizing_conf``): bytes one task should sort, hash or
# read - large enough to amortise task start-up, small enough to fit an
# executor core's share of memory - and a cap on reduce partitions beyond
# which map-output bookkeeping on the driver grows too large.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024
MAX_SHUFFLE_PARTITIONS = 200_000


def build_session(master: str | None = None, app: str = "ledgerline",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the recommended settings.

    On a cluster pass ``master=None`` and let spark-submit decide; tests and
    the bench pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (distributed) folder there and we only read it;
    on a cluster without one this raises instead of inventing a folder only
    one machine can see. Only a local-mode session (tests, the bench) with
    the setting unset gets a fresh scratch folder so ``checkpoint()`` and the
    stored tables work.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, S3, ...): "
                               "stored facts, rollups and checkpoints go there")
        configured = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path below the shared checkpoint folder for written tables."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a table written below the checkpoint folder."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def sizing_conf(shuffle_bytes: int, total_cores: int,
                target_bytes: int = TARGET_PARTITION_BYTES) -> dict[str, str]:
    """Partition settings for a job whose largest shuffle moves about
    ``shuffle_bytes`` on ``total_cores`` task slots.

    The shuffle gets ceil(bytes / target) partitions (at least one full wave,
    rounded up to whole waves, at most ``MAX_SHUFFLE_PARTITIONS``); AQE starts
    from that number, merges small neighbours up to half the target and splits
    a partition past the target as skewed. File splits are half the target so
    a scan task's decoded rows stay well inside memory.
    """
    cores = max(1, int(total_cores))
    parts = max(cores, -(-int(shuffle_bytes) // int(target_bytes)))
    parts = -(-parts // cores) * cores
    if parts > MAX_SHUFFLE_PARTITIONS:
        warnings.warn(f"{parts} shuffle partitions are wanted, {MAX_SHUFFLE_PARTITIONS} are used: each "
                      f"task reads {parts / MAX_SHUFFLE_PARTITIONS:.1f} times the target", stacklevel=2)
        parts = MAX_SHUFFLE_PARTITIONS
    half = str(int(target_bytes) // 2)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": half,
        "spark.sql.files.maxPartitionBytes": half,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(int(target_bytes)),
    }


def size_partitions(spark: SparkSession, shuffle_bytes: int,
                    target_bytes: int = TARGET_PARTITION_BYTES) -> dict[str, str]:
    """Apply ``sizing_conf`` to a running session (all are runtime SQL
    settings) for the cores it has; returns what was set."""
    conf = sizing_conf(shuffle_bytes, spark.sparkContext.defaultParallelism, target_bytes)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf


def start_partitions(spark: SparkSession, shuffle_bytes: int,
                     target_bytes: int = TARGET_PARTITION_BYTES) -> int:
    """Let AQE start exchanges from enough partitions for ``shuffle_bytes``,
    unless the session already does; it merges the small ones of lesser jobs.
    A partition count in the plan itself would keep AQE from splitting a hot
    key, so the start is a setting. Returns the number in force."""
    needed = int(sizing_conf(shuffle_bytes, spark.sparkContext.defaultParallelism,
                             target_bytes)["spark.sql.shuffle.partitions"])
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    now = int(spark.conf.get(key, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    if needed > now:
        spark.conf.set(key, str(needed))
    return max(needed, now)
