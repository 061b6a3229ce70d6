"""Spark session defaults and the shared checkpoint folder.

The library never creates its own session inside an operator; callers pass one in.
``get_spark`` is a convenience for scripts, tests and the bench.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


TARGET_PARTITION_BYTES = 200 * 1024 * 1024


def shuffle_partitions_for(input_bytes: int, target_bytes: int = TARGET_PARTITION_BYTES,
                           minimum: int = 200, maximum: int = 100_000) -> int:
    """Initial shuffle partition count for an input of ``input_bytes``.

    About ``target_bytes`` of shuffle data per task keeps sorts and aggregates in
    executor memory with little spill (100 TB -> 100,000 partitions, the cap). AQE then
    coalesces small partitions and splits skewed ones at run time.
    """
    return max(minimum, min(maximum, -(-input_bytes // target_bytes)))


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tillspark", input_bytes: int | None = None) -> SparkSession:
    """Local/cluster session with AQE on and the UI off.

    On a cluster ``master`` stays ``None`` and the launcher's settings win; the
    options below are only defaults. ``input_bytes`` (the size of the raw data) sizes
    the shuffle partitions when ``shuffle_partitions`` is not given.
    """
    if shuffle_partitions is None and input_bytes:
        shuffle_partitions = shuffle_partitions_for(input_bytes)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # coalesce towards 128 MB reduce partitions; split file scans at 256 MB
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Grouped pandas functions for the model fits get small Arrow batches.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the launcher sets it to a shared file system. Only a local master gets a
    fresh scratch folder where it is unset; a cluster without one is an error, because
    executors would write to disks that others cannot see.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="tillspark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back.

    For whatever is read more than once and must be the same each time: a lost executor or
    a cleared cache costs a re-read, never another result. It runs a job.
    """
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)  # read a few times, then left: small files first
    return df.sparkSession.read.schema(df.schema).parquet(path)
