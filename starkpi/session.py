"""Session helpers.

The library never creates a cluster session implicitly: callers pass a
SparkSession in.  ``local_session`` exists for tests, the bench and the
examples; ``checkpoint_root`` reads ``spark.checkpoint.dir`` from the
session and only invents a scratch directory when it is unset (local runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoints written by distributed ranks are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", extra: dict | None = None) -> SparkSession:
    """A local[N] session configured like the tests and bench expect."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName("starkpi")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory)
               # local runs only: managed tables go to a scratch warehouse
               .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="starkpi-warehouse-")))
    for k, v in {**_LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and streaming state.

    On a cluster this is the directory the deployment names in
    ``spark.checkpoint.dir`` (a shared file system).  Where it is unset, a
    session on one machine (``local[...]``) gets a fresh scratch directory;
    on a cluster, whose machines would not see it, an unset directory raises.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        # the context reads the setting at start-up only; a value set later on
        # the session must be handed to it for DataFrame.checkpoint()
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="starkpi-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-path of the shared checkpoint root, e.g. for a streaming query."""
    return os.path.join(checkpoint_root(spark), name)


def recommended_conf(shuffled_bytes: int, total_cores: int, advisory_bytes: int = 256 << 20,
                     split_bytes: int = 512 << 20, most_partitions: int = 32_768) -> dict[str, str]:
    """Session settings for a cluster run, derived from the bytes that its widest
    shuffle moves (after pruning and partial aggregation, not the input's size).

    - scan splits of ``split_bytes`` (Parquet is columnar: a 512 MB split
      reads far less after column pruning);
    - the initial shuffle width covers those bytes at ``advisory_bytes`` per
      partition, in whole waves of the cluster's cores (one at least), up to
      ``most_partitions``: the driver's map status grows with map tasks times
      partitions.  AQE then coalesces small partitions to ``advisory_bytes`` and
      splits skewed ones;
    - broadcast joins stay at Spark's default threshold: only dimensions that
      are actually small at run time are broadcast.
    """
    waves = max(1, -(-shuffled_bytes // (advisory_bytes * total_cores)))
    initial = min(waves * total_cores, max(most_partitions, total_cores))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(advisory_bytes),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
