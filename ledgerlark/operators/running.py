"""Running sums along any order, whole or within groups.

A window without a partition key, or with a key that has most rows, is one task.
Here the rows are first summed by their place in the order, the sums are cut into
ranges of the order, and every range is summed up on its own. What a range starts
from is the sum of the ranges before it: one number a range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.operators.position import ROW_BITS
from ledgerlark.session import stage

_EXACT = "decimal(38,0)"


def running_sums(df: DataFrame, order: Sequence[str], amount: Column, keys: Sequence[str] = (), name: str = "running") -> DataFrame:
    """One row for every distinct ``keys`` and ``order``: ``amount`` summed over the
    rows with equal keys that do not come after it.

    Ascending, NULL first; rows that tie share one value, as in a window ordered
    by range. ``amount`` is in whole numbers. Summing by place comes first and has
    partial results, so any number of rows may tie; a key with most rows is cut
    into ranges like all others.
    """
    by = [*keys, *order]
    sums = df.groupBy(*by).agg(F.sum(amount).cast(_EXACT).alias("__sum"))
    line = [F.col(c).asc_nulls_first() for c in by]
    sorted_sums = sums.repartitionByRange(*line).sortWithinPartitions(*line)
    placed = stage(sorted_sums.withColumn("__id", F.monotonically_increasing_id()), "running")
    placed = placed.withColumn("__range", F.shiftright("__id", ROW_BITS))
    upto = Window.partitionBy("__range", *keys).orderBy("__id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = placed.withColumn(name, F.sum("__sum").over(upto))
    starts = _starts(placed, keys)
    if starts is not None:
        same = F.col("__range") == F.col("__of")
        for key in keys:
            same &= F.col(key).eqNullSafe(F.col(f"__of_{key}"))
        inside = inside.join(F.broadcast(starts), same, "left").withColumn(
            name, F.col(name) + F.coalesce("__start", F.lit(0).cast(_EXACT))
        )
    return inside.select(*by, F.col(name).cast(_EXACT).alias(name))


def _starts(placed: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """What the first key of a range has summed up before it; None if no range starts with more than nothing.

    Of every range only its first and last key are looked at, so the driver sees two
    sums a range, however many keys there are.
    """
    runs = placed.groupBy("__range", *keys).agg(F.sum("__sum").alias("total"), F.min("__id").alias("low"), F.max("__id").alias("high"))
    key = F.struct(F.lit(0).alias("__none"), *keys)
    ends = runs.select("__range", "low", "high", F.struct(key.alias("key"), "total").alias("run")).groupBy("__range").agg(
        F.min_by("run", "low").alias("first"), F.max_by("run", "high").alias("last"), F.count("*").alias("runs")
    )
    found, key_now, sum_now = [], None, 0
    for row in sorted(ends.collect(), key=lambda r: r["__range"]):
        first, last = row["first"], row["last"]
        if first["key"] == key_now:
            found.append((row["__range"], *first["key"][1:], sum_now))
        if row["runs"] == 1 and first["key"] == key_now:
            sum_now += last["total"]
        else:
            key_now, sum_now = last["key"], last["total"]
    if not found:
        return None
    fields = [T.StructField("__of", T.LongType())]
    fields += [T.StructField(f"__of_{k}", placed.schema[k].dataType) for k in keys]
    fields += [T.StructField("__start", T.DecimalType(38, 0))]
    return placed.sparkSession.createDataFrame(found, T.StructType(fields))


def with_running_sum(
    df: DataFrame, order: Sequence[str], amount: Column, keys: Sequence[str] = (), name: str = "running"
) -> DataFrame:
    """Every row of ``df`` with the running sum up to it, those that tie included."""
    by = [*keys, *order]
    sums = running_sums(df, order, amount, keys, name).select(*[F.col(c).alias(f"__{c}") for c in by], name)
    same = F.lit(True)
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"__{c}"))
    return df.join(sums, same).drop(*[f"__{c}" for c in by])
