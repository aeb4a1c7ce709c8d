"""Tables laid out by ranges of days."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.functions.buckets import bucket_right

PART = "part_id"


def write_by_range(df: DataFrame, day: str, boundaries: Sequence[dt.date], path: str) -> None:
    """One folder per range of ``day``.

    The rebalance hint gathers the rows of a range into few files, and splits
    a range that is too large for one task.
    """
    (
        df.withColumn(PART, bucket_right(F.col(day), boundaries))
        .hint("rebalance", PART)
        .write.partitionBy(PART)
        .parquet(path)
    )


def read_by_range(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def boundary_table(spark: SparkSession, boundaries: Sequence[dt.date]) -> DataFrame:
    """Every boundary with its number and the range that it opens."""
    rows = [(n, n + 1, bound) for n, bound in enumerate(sorted(boundaries), start=1)]
    return spark.createDataFrame(rows, "boundary_id int, opens_part int, boundary date")


def distribution(df: DataFrame, day: str, boundaries: Sequence[dt.date]) -> DataFrame:
    """Rows, first and last day of every range that holds rows."""
    return df.groupBy(bucket_right(F.col(day), boundaries).alias(PART)).agg(
        F.count("*").alias("qty"), F.min(day).alias("min_day"), F.max(day).alias("max_day")
    )
