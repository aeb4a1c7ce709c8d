"""First rows of an order, with and without ties, pages, and best rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.operators.selection import Key, rows_at


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_n_with_ties(df: DataFrame, n: int, *keys: str, descending: bool = True, nullable: bool = True) -> DataFrame:
    """All rows whose key is not worse than the key of the n-th row.

    The n-th key is found with a bounded sort and becomes a constant of a
    plain filter, so any number of ties stays spread over the tasks. For one
    key without NULLs the filter also reaches the parquet scan.
    """
    order = [F.col(name).desc() if descending else F.col(name).asc() for name in keys]
    best = df.select(*keys).orderBy(*order).limit(n)
    key = F.col(keys[0]) if len(keys) == 1 and not nullable else F.struct(*keys)
    if descending:
        return df.filter(key >= best.agg(F.min(key)).scalar())
    return df.filter(key <= best.agg(F.max(key)).scalar())


def rows_on_last_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """All rows that carry one of the n highest distinct values."""
    edge = (
        df.select(column)
        .filter(F.col(column).isNotNull())
        .distinct()
        .orderBy(F.col(column).desc())
        .limit(n)
        .agg(F.min(column))
        .scalar()
    )
    return df.filter(F.col(column) >= edge)


def page(df: DataFrame, number: int, size: int, *order: str | Key) -> DataFrame:
    """Page ``number`` (from 1) of ``size`` rows; give a total order.

    Found by counting at any depth: nothing is stored, and only rows near the page are sorted.
    """
    if number < 1 or size < 1:
        raise ValueError("page number and size start at 1")
    return rows_at(df, (number - 1) * size, size, *order)


def best_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows of every key.

    The filter on the row number lets Spark cut every group to n rows before
    the shuffle, so a hot key sends n rows per task and no more.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).filter(F.col("__rank") <= n).drop("__rank")


def apply_best(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, order: Sequence[Column], n: int,
    keep_empty: bool = False,
) -> DataFrame:
    """For every row of ``left``, the first n rows of ``right`` with its key.

    Evaluated once for all keys: ``right`` is cut to n rows per key before it
    is joined. With ``keep_empty`` a row without matches stays, with NULLs.
    """
    best = best_per_key(right, [right_key], order, n)
    return left.join(best, F.col(left_key) == F.col(right_key), "left" if keep_empty else "inner")


def best_per_key_with_ties(df: DataFrame, keys: Sequence[str], value: str, n: int) -> DataFrame:
    """Rows with fewer than n rows of a greater ``value`` in their group.

    The n-th value of every group is one row of a small table; the rows are
    filtered against it, so tied rows of a group need not meet in a task. A
    row whose value or group is NULL has no greater rows and stays. Give a
    stored table: it is read twice.
    """
    known = df.select(*keys, value).filter(F.col(value).isNotNull())
    cuts = best_per_key(known, keys, [F.desc(value)], n).groupBy(*keys).agg(F.min(value).alias("__cut"))
    kept = F.col(value).isNull() | F.col("__cut").isNull() | (F.col(value) >= F.col("__cut"))
    return df.join(cuts, list(keys), "left").filter(kept).select(*df.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` values of every key, as one
    aggregate: no sort, and only one row per key and task is shuffled."""
    rest = [name for name in df.columns if name not in keys and name not in order]
    row = F.max(F.struct(*order, *rest)).alias("__row")
    return df.groupBy(*keys).agg(row).select(*keys, "__row.*").select(*df.columns)
