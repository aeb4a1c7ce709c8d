"""Subquery shapes: comparison with all values, counts over fan-out joins, counts in a period."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def not_above_any(df: DataFrame, column: str, values: DataFrame, value: str) -> DataFrame:
    """Rows with ``column <= ALL (values)``.

    True for every row when there are no values, and for no row when one of
    them is NULL.
    """
    facts = values.agg(
        F.struct(
            F.count("*").alias("n"),
            F.count(value).alias("known"),
            F.min(value).alias("least"),
        )
    ).scalar()
    return (
        df.withColumn("__all", facts)
        .filter(
            (F.col("__all.n") == 0)
            | ((F.col("__all.n") == F.col("__all.known")) & (F.col(column) <= F.col("__all.least")))
        )
        .drop("__all")
    )


def equal_to_least(df: DataFrame, column: str) -> DataFrame:
    """Rows with ``column = (SELECT MIN(column))``; NULLs are ignored."""
    return df.filter(F.col(column) == df.agg(F.min(column)).scalar())


def with_match_count(df: DataFrame, other: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Inner join that keeps one row and the number of its matches.

    Stands for a join made only for its multiplicity: sums over the joined
    rows equal the value times this count, and the pairs are never built.
    """
    matches = other.groupBy(*keys).agg(F.count("*").alias(name))
    return df.join(matches, keys)


def counts_in_periods(
    periods: DataFrame,
    facts: DataFrame,
    key: str,
    day: str,
    first: str,
    last: str,
    measures: list[str],
) -> DataFrame:
    """For every distinct (key, first, last): each measure summed over facts
    with that key and ``first <= day <= last``; 0 where there are none.

    Measures are summed per key and day, accumulated over the days of a key,
    and read at both ends of a period. A key's window holds at most one row
    per calendar day, so neither many facts nor many periods of one key
    collect in a task, and facts and periods are never paired. Facts of other
    keys are dropped by a semi-join; Spark broadcasts few keys.
    """
    spans = periods.select(key, first, last).distinct()
    asked = periods.select(key).distinct()
    # Days before all periods cancel out, those after them are never read.
    bounds = periods.agg(F.struct(F.min(first).alias("low"), F.max(last).alias("high"))).scalar()
    facts = facts.filter(F.col(day).between(bounds["low"], bounds["high"])).join(asked, key, "left_semi")
    ends = periods.select(key, F.explode(F.array(F.date_sub(first, 1), last)).alias("__day"))
    marks = ends.filter(F.col("__day").isNotNull()).select(
        "*", *[F.lit(0).alias(m) for m in measures], F.lit(1).alias("__mark")
    )
    line = (
        facts.select(key, F.col(day).alias("__day"), *measures, F.lit(0).alias("__mark"))
        .unionByName(marks)
        .groupBy(key, "__day")
        .agg(*[F.sum(m).alias(m) for m in measures], F.max("__mark").alias("__mark"))
    )
    upto = Window.partitionBy(key).orderBy("__day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = (
        line.select(key, "__day", "__mark", *[F.sum(m).over(upto).alias(m) for m in measures])
        .filter(F.col("__mark") == 1)
        .drop("__mark")
    )
    # Both readings of a period meet again by aggregation.
    readings = spans.select(
        key,
        first,
        last,
        F.explode(
            F.array(
                F.struct(F.date_sub(first, 1).alias("__day"), F.lit(-1).alias("__sign")),
                F.struct(F.col(last).alias("__day"), F.lit(1).alias("__sign")),
            )
        ).alias("__end"),
    ).select(key, first, last, "__end.*")
    sums = (
        readings.join(reached, [key, "__day"], "left")
        .groupBy(key, first, last)
        .agg(*[F.sum(F.col(m) * F.col("__sign")).alias(m) for m in measures])
    )
    # A period that ends before it starts, or lacks an end, holds nothing.
    real = F.col(first) <= F.col(last)
    return sums.withColumns(
        {m: F.when(real, F.coalesce(m, F.lit(0))).otherwise(0).cast("long") for m in measures}
    )
