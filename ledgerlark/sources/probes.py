"""Tables written to be asked for single keys.

Rows are clustered by one column, whose values are found by the least and
greatest value of a row group; for others a Bloom filter of each row group says which
values it cannot hold. A question for an absent key reads no row group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROW_GROUP_BYTES = 32 << 20


def write_for_probes(df: DataFrame, path: str, cluster: Sequence[str], blooms: dict[str, int], row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Store ``df`` in the order of ``cluster``, with Bloom filters on columns of about so many values a row group."""
    writer = df.repartitionByRange(*cluster).sortWithinPartitions(*cluster).write.option("parquet.block.size", row_group_bytes)
    for column, values in blooms.items():
        # A dictionary of all values would make the writer leave the filter out.
        writer = (
            writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
            .option(f"parquet.bloom.filter.expected.ndv#{column}", values)
            .option(f"parquet.enable.dictionary#{column}", "false")
        )
    writer.parquet(path)


def probe(spark: SparkSession, path: str, condition: Column) -> DataFrame:
    """Rows for which equalities hold; row groups that cannot hold them are not read."""
    return spark.read.parquet(path).filter(condition)


def exists(spark: SparkSession, path: str, condition: Column) -> DataFrame:
    """One row with ``found``."""
    return probe(spark, path, condition).limit(1).agg((F.count("*") > 0).alias("found"))
