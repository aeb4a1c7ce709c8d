"""Exact sums of money and quantities.

Tables store them as doubles with two decimals. A sum is taken over whole
hundredths in 64-bit integers: exact, independent of the order of rows, and
several times cheaper than decimal arithmetic. A value with more decimals stops
the job, and so does a sum above 9e16 units (``prepare`` sets the ANSI mode,
in which integers do not wrap). Products are taken in ``wide`` numbers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def money(column: str | Column) -> Column:
    """The decimal form, for text files and messages."""
    return _column(column).cast("decimal(18,2)")


def hundredths(column: str | Column, scale: int = 2) -> Column:
    """The value in whole units of its last decimal; more decimals are an error."""
    exact = _column(column) * 10**scale
    whole = F.rint(exact)
    wrong = F.abs(exact - whole) > 1e-5 + F.abs(exact) * 1e-15
    refused = F.raise_error(F.lit(f"a value has more than {scale} decimals")).cast("long")
    return F.when(wrong, refused).otherwise(whole.cast("long"))


def total(column: str | Column, scale: int = 2) -> Column:
    """Aggregate: the sum in hundredths."""
    return F.sum(hundredths(column, scale))


def wide(column: str | Column) -> Column:
    """For products: 38 digits."""
    return _column(column).cast("decimal(38,0)")


def units(column: str | Column) -> Column:
    """Report form of a number of hundredths."""
    return _column(column).cast("double") / 100


def number(column: str | Column) -> Column:
    """Report form of a decimal."""
    return _column(column).cast("double")


def mean(total_hundredths: Column, rows: Column) -> Column:
    """An average out of a sum and a count, which can both be re-aggregated."""
    return units(total_hundredths) / rows
