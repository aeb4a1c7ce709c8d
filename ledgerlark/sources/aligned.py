"""Tables that lie ready for a join: cut and sorted by their common key once, joined without a shuffle.

Both tables are written in the same number of buckets. A bucket is read by one
task, so the layout is for keys without a dominating value: a key with a third of
the rows would be a third of one task's work, and ``write_aligned`` refuses it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.session import scratch

# A key may hold this share of the rows of an average bucket at most.
HOT_SHARE = 0.5


class HotKey(ValueError):
    """One value of the key has too many rows for a bucket."""


def write_aligned(df: DataFrame, key: str, buckets: int, check: bool = True) -> str:
    """Store ``df`` in ``buckets`` buckets sorted by ``key``; returns the name of the new table.

    The table lies in the shared folder; the catalog holds its name only.
    """
    if check:
        counted = df.groupBy(key).agg(F.count("*").alias("rows")).agg(F.max("rows").alias("most"), F.sum("rows").alias("rows")).first()
        # Small tables have buckets of a few rows, where a share says nothing.
        if counted["rows"] and counted["most"] > max(1000, HOT_SHARE * counted["rows"] / buckets):
            raise HotKey(f"a value of {key} has {counted['most']} of {counted['rows']} rows")
    name = f"aligned_{uuid.uuid4().hex}"
    # Dealt as the buckets are, so a bucket is one file.
    dealt = df.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", scratch(df.sparkSession, name)).saveAsTable(name)
    return name


def read_aligned(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def join_aligned(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner") -> DataFrame:
    """Merge bucket by bucket; neither side is shuffled or sent whole."""
    return left.join(right.hint("merge"), F.col(left_key) == F.col(right_key), how)
