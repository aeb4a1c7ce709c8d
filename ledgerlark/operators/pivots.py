"""Counting pivots with given or data-dependent columns, and unpivots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class NoPivotColumns(ValueError):
    """The list of columns for a pivot came out empty."""


def pivot_columns(names: DataFrame, column: str, limit: int = 10_000) -> list[str]:
    """The distinct names as a sorted list.

    Only names travel to the driver, and at most ``limit`` of them; a longer
    list is refused, never cut.
    """
    found = names.select(column).filter(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"more than {limit} pivot columns")
    if not found:
        raise NoPivotColumns("no names for pivot columns")
    return sorted(row[0] for row in found)


def count_pivot(df: DataFrame, rows: str, column: str, names: Sequence[str], count: str) -> DataFrame:
    """Counts per row and named column, 0 for an empty cell.

    ``count`` holds pre-aggregated counts. A row whose values all lie outside
    ``names`` stays, with zeros.
    """
    wide = df.groupBy(rows).pivot(column, list(names)).agg(F.sum(count))
    cells = [F.coalesce(wide[_quoted(name)], F.lit(0)).cast("long").alias(name) for name in names]
    return wide.select(rows, *cells)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def unpivot_known(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """One row per non-NULL cell of ``columns``."""
    long = df.unpivot(list(ids), list(columns), name, value)
    return long.filter(F.col(value).isNotNull())
