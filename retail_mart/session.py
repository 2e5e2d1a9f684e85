"""Session construction and the shared working folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Defaults for local runs (tests, bench). On a cluster the job submitter
# owns these settings; nothing here overrides a value that is already set.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "16g", event_log_dir: str | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cpus}]")
               .appName("retail_mart")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir)
                   .config("spark.eventLog.compress", "false"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, sub: str = "") -> str:
    """Folder every executor can read and write; also the checkpoint dir.

    Uses the context's checkpoint dir, else the cluster's
    ``spark.checkpoint.dir`` setting. Only when neither is set -- local
    tests -- a fresh temporary folder is created. Whatever is chosen is
    registered as the context's checkpoint dir, so ``checkpoint()`` writes to
    the same shared place.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- e.g. a Spark Connect session has no context
        sc = None
    base = sc.getCheckpointDir() if sc is not None else None
    if not base:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if sc is None or not sc.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            base = tempfile.mkdtemp(prefix="retail_mart-")
        if sc is not None:
            sc.setCheckpointDir(base)
            base = sc.getCheckpointDir() or base
    base = base.rstrip("/")
    return f"{base}/{sub}" if sub else base


def checkpointed(df):
    """Cut lineage: write ``df`` as a Parquet table in the shared folder and
    read it back. One computation (an eager ``checkpoint()`` of an
    unpersisted frame computes it twice), survives executor loss, and the
    read-back carries file statistics for the planner."""
    import uuid
    path = shared_dir(df.sparkSession, f"cut-{uuid.uuid4().hex[:12]}")
    df.write.mode("errorifexists").parquet(path)
    # the schema is known: no inference job on read-back
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_run_dir(spark: SparkSession, prefix: str) -> str:
    """A fresh, never-reused sub-folder of the shared folder."""
    import uuid
    return shared_dir(spark, f"{prefix}-{uuid.uuid4().hex[:12]}")


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20,
                 shuffle_bytes: int | None = None) -> dict:
    """Settings that keep shuffle and scan partitions near ``target_partition_bytes``.

    * scan splits: ``maxPartitionBytes`` = target (Spark itself shrinks
      splits toward input / cores for small inputs);
    * shuffle: start with ~shuffled bytes / target partitions (at least 2 per
      core; ``shuffle_bytes`` as the event log of an earlier run gives it, the
      input's size only while it is unknown, an upper bound here) and
      let AQE coalesce small ones toward the advisory size, and split skewed
      partitions of sort-merge joins;
    * broadcast threshold stays at its default: explicit broadcasts are
      size-checked in code (operators.common.small_side).
    For 100 TB on 1,000 executors x 8 cores whose partial aggregates shuffle
    5 TB: ~20k shuffle partitions before coalescing, 256 MB splits.
    """
    split = target_partition_bytes
    shuffle = max(2 * total_cores, (input_bytes if shuffle_bytes is None else shuffle_bytes) // target_partition_bytes)
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(int(shuffle)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
