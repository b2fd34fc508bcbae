"""Session helpers.

On a cluster the session comes from the launcher; these helpers only fill in
settings that are unset (tests and the local bench).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A task sorts and groups what it reads uncompressed, up to 15 times the
    # shuffled bytes: 64 MB (Spark's default) of payments are 1 GB in a task.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # The same for files: the latest-version dedup sorts what a scan task reads
    # before the shuffle, and 128 MB (Spark's default) of invoices are 10 million.
    "spark.sql.files.maxPartitionBytes": "16m",
    # Partition columns such as ``ref`` are strings; never infer them as ints.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "billbook") -> SparkSession:
    """A local session for tests and benchmarks (UI off, checkpoint dir set)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("BILLBOOK_DRIVER_MEMORY", "16g"))
        # Local data is small: let AQE keep more (smaller) partitions so all
        # cores work. Cluster sessions keep Spark's default floor.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
    )
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the library's SQL defaults on an existing session where unset."""
    for k, v in DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    # Partition-type inference must be off for string cohorts; it is a
    # runtime SQL conf, so set it regardless.
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only
    when neither is set, and the master is local (tests), a fresh local folder
    is created and registered; on a cluster executors would not see it, so a
    missing setting is an error there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="billbook-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        spark.conf.set("spark.checkpoint.dir", d)
    return d
