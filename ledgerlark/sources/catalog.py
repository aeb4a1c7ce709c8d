"""Small helpers around table definitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same columns."""
    return df.sparkSession.createDataFrame([], df.schema)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Create the table unless it exists."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, source="parquet", schema=schema)
