"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# For tens of terabytes on hundreds of executors; pass to build_session as **LARGE_DATA. Adaptive
# execution merges what turns out small, so the number of shuffle partitions is an upper bound.
LARGE_DATA = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}


def build_session(app_name: str = "seasonline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # A join on a hot name is split even when that costs one more exchange.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    A cluster has to name it. A local session that does not, whose one process is driver and executor, gets
    a folder that goes when the process ends.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        own = tempfile.mkdtemp(prefix="seasonline-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        named = os.path.join(own, "shared")
        spark.conf.set(CHECKPOINT_DIR, named)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one job's files, below the run's own folder in the shared one."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def scratch_root(spark: SparkSession) -> str:
    """The folder of everything this application stages; the caller owns it, see :func:`clear_scratch`."""
    return f"{shared_dir(spark).rstrip('/')}/scratch-{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has staged, once its results are stored: they may still read from it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut at a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame, label: str = "stage") -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Later passes read only the columns they need instead of repeating the work, a lost
    executor costs a re-read, and the planner knows the table's true size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
