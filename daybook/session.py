"""Session helpers: a configured local session for tests/bench and the
shared scratch folder taken from ``spark.checkpoint.dir``."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "daybook", memory: str = "16g") -> SparkSession:
    """Session used by tests and bench (cluster jobs get theirs from spark-submit)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "zstd")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder. In local mode (tests) one is made
    when unset; on a cluster, where executors don't share local folders, an
    unset folder is an error."""
    cur = spark.conf.get("spark.checkpoint.dir", None)
    if not cur:
        cur = spark.sparkContext.getCheckpointDir()
    if not cur:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        cur = tempfile.mkdtemp(prefix="daybook-ckpt-")
        spark.conf.set("spark.checkpoint.dir", cur)
        spark.sparkContext.setCheckpointDir(cur)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(cur)
    return cur


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(p: str) -> str:
    """Strip a ``file:`` scheme for local file-system operations."""
    return p[5:] if p.startswith("file:") else p


def is_local_fs(p: str) -> bool:
    return p.startswith("/") or p.startswith("file:") or "://" not in p and os.path.isabs(p)


def materialize(df):
    """Cut lineage with a reliable checkpoint into ``spark.checkpoint.dir``
    (the shared folder on a cluster; never executor-local storage) when a
    small intermediate feeds several branches of one job."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def landed(df, name: str):
    """Write a large intermediate once, as Parquet in the shared checkpoint
    folder, and read it from there: what several branches read is planned and
    computed once, and each branch scans its own columns only."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_parallel(calls, workers: int = 8):
    """Run independent Spark actions ``[(fn, args), ...]`` from a small
    thread pool, so many small jobs share the cluster instead of queueing
    one after another (the scheduler interleaves their tasks)."""
    from concurrent.futures import ThreadPoolExecutor
    if not calls:
        return []
    with ThreadPoolExecutor(max_workers=min(workers, len(calls))) as pool:
        return list(pool.map(lambda c: c[0](*c[1]), calls))


def cluster_conf(input_bytes: float, executors: int, cores_per_executor: int = 8,
                 executor_memory_gb: float = 32.0, target_partition_mb: int = 256,
                 max_partitions: int = 30_000) -> dict[str, str]:
    """Spark settings sized for a cluster run over ``input_bytes``.

    * scan splits of ``target_partition_mb`` (files.maxPartitionBytes) so a
      task's input fits comfortably in its share of executor memory;
    * initial shuffle partitions = max(input / target, 3 × total cores), at
      most ``max_partitions`` (map tasks x reduce partitions is what the driver
      and the shuffle service track), rounded up to a multiple of the core
      count, with AQE coalescing back to the advisory size at run time; a
      stage that shuffles the whole input passes its own number;
    * AQE skew-join splitting for a key that holds a large share of a
      partition, and a broadcast threshold far below a task's memory share.
    Example: 100 TiB on 1000 executors × 8 cores → 256 MiB splits and 24,000
    shuffle partitions before AQE coalescing."""
    cores = max(executors * cores_per_executor, 1)
    target = target_partition_mb * 1024 * 1024
    per_task_mem = executor_memory_gb * 1024 ** 3 / max(cores_per_executor, 1)
    split = int(min(target, per_task_mem / 4))
    parts = max(min(-(-int(input_bytes) // split), max_partitions // cores * cores), 3 * cores)
    parts = ((parts + cores - 1) // cores) * cores
    bcast = int(min(64 * 1024 ** 2, per_task_mem / 16))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(split),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(split),
        "spark.sql.autoBroadcastJoinThreshold": str(bcast),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(bcast),
        "spark.sql.parquet.aggregatePushdown": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.ui.enabled": "false",
    }
