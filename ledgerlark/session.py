"""Session settings and the shared folder that jobs write intermediate data to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Overflows and bad casts stop a job; they never give a wrong number.
# A skewed join partition is split even where that costs one more shuffle, so
# a single hot key never decides how long a stage takes.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Turn on the settings the operators count on."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerlark")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="ledgerlark-warehouse-"))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``; a machine-local folder is
    chosen only where nothing is configured and the master is local.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="ledgerlark-")
    context.setCheckpointDir(folder)
    return folder


def scratch(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, never used before."""
    base = shared_folder(spark)
    return os.path.join(base, f"{label}-{uuid.uuid4().hex}")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Store ``df`` as a parquet table in the shared folder and go on from it.

    For a step that is read more than once, and for values that depend on how
    Spark placed the rows. The table outlives the executors that wrote it.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored


def unstage(*stored: DataFrame) -> None:
    """Delete stored steps once all that is derived from them is stored itself.

    Only for what ``stage`` returned; other tables are left alone.
    """
    for df in stored:
        path = getattr(df, "_stored_at", None)
        if path is None:
            continue
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
        df._stored_at = None
