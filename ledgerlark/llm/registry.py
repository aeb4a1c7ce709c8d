"""Queries of the subpackage by name, each with SQL text where SQL can say the same."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import ledgerlark
from ledgerlark.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


# Python workers hold a batch several times over, so batches are cut by size.
BATCH_BYTES = str(8 << 20)

_sent: set[str] = set()


def ready(spark: SparkSession) -> SparkSession:
    """Set the session up; Python workers get this package from the driver."""
    context = spark.sparkContext
    if context.applicationId not in _sent:
        top = Path(ledgerlark.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="ledgerlark-code-")) / "ledgerlark.zip"
        with zipfile.ZipFile(archive, "w") as packed:
            for source in sorted(top.rglob("*.py")):
                packed.write(source, source.relative_to(top.parent))
        context.addPyFile(str(archive))
        _sent.add(context.applicationId)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return prepare(spark)


def query(name: str, sql: str | None = None):
    """Register a function from (session, data folder) to DataFrame."""

    def add(build: Query) -> Query:
        if name in QUERIES:
            raise KeyError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(ready(spark), folder)
        if sql is not None:
            SQL[name] = sql
        return build

    return add


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")
