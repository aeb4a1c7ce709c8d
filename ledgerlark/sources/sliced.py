"""A table kept in slices by a hash of its key, so that a merge rewrites only the slices it meets.

The folder has a subfolder ``key_slice=n`` for every slice. A change reads and replaces
the slices that hold a key of the source; the files of all others stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.operators import changes as ch
from ledgerlark.session import stage, unstage

SLICE = "key_slice"


class SlicedTable:
    """Rows below ``path`` by slices of ``key``.

    ``match`` says how keys are compared, as in a merge; ``normal`` gives one and the same bytes for
    all keys that match, such as ``lower`` where letter case does not count.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        key: str,
        slices: int,
        match: ch.Match = ch.same,
        normal: ch.Match | None = None,
    ):
        if SLICE in schema.names:
            raise ValueError(f"a column is called {SLICE}")
        if match is not ch.same and normal is None:
            raise ValueError("a hash does not know which keys match: give their normal form")
        self.spark, self.path, self.schema = spark, path, schema
        self.key, self.slices, self.match, self.normal = key, slices, match, normal or ch.same

    def _slice(self, key: str) -> Column:
        """Rows without a key are one slice more: no merge meets them."""
        of = F.pmod(F.xxhash64(self.normal(F.col(key))), F.lit(self.slices)).cast("int")
        return F.when(F.col(key).isNull(), F.lit(self.slices)).otherwise(of)

    def write(self, rows: DataFrame) -> SlicedTable:
        """Store ``rows`` as the whole table."""
        self._replace(rows.select(*self.schema.names), "static")
        return self

    def _replace(self, rows: DataFrame, mode: str) -> None:
        # A slice too large for one task is split into several files.
        sliced = rows.withColumn(SLICE, self._slice(self.key)).hint("rebalance", SLICE)
        sliced.write.partitionBy(SLICE).mode("overwrite").option("partitionOverwriteMode", mode).parquet(self.path)

    def read(self, slices: list[int] | None = None) -> DataFrame:
        """The table, or the rows of some slices; the files of others are pruned."""
        whole = T.StructType([*self.schema.fields, T.StructField(SLICE, T.IntegerType())])
        rows = self.spark.read.schema(whole).parquet(self.path)
        if slices is not None:
            rows = rows.filter(F.col(SLICE).isin(slices))
        return rows.select(*self.schema.names)

    def touched(self, source: DataFrame) -> list[int]:
        """Numbers of the slices that hold the keys of ``source``: at most one number a slice."""
        rows = source.filter(F.col(self.key).isNotNull()).select(self._slice(self.key).alias(SLICE)).distinct().collect()
        return sorted(r[SLICE] for r in rows)

    def change(self, source: DataFrame, apply: Callable[[DataFrame], ch.Change]) -> DataFrame:
        """Replace the slices of the keys of ``source`` by what ``apply`` makes of their rows; returns its log.

        The new rows and the log are stored before a file is replaced, so the step reads nothing
        that it overwrites. Files are swapped slice by slice: a job that is stopped in the middle
        leaves whole slices, and running it again repeats the change.
        """
        slices = self.touched(source)
        done = apply(self.read(slices))
        log = stage(done.log, "change-log")
        rows = stage(done.table.select(*self.schema.names), "changed-slices")
        self._replace(rows, "dynamic")
        unstage(rows)
        return log

    def merge(self, source: DataFrame, on_match: dict[str, Column], on_insert: dict[str, Column], check: bool = True) -> DataFrame:
        """Upsert by the key, as ``changes.merge``; a source row without a key is refused."""
        if not source.filter(F.col(self.key).isNull()).isEmpty():
            raise ValueError(f"a source row has no {self.key}")
        return self.change(
            source, lambda rows: ch.merge(rows, source, self.key, on_match, on_insert, check=check, match=self.match)
        )
