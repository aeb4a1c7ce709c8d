"""Range buckets over ordered boundaries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket_right(column: Column, boundaries: Sequence[dt.date]) -> Column:
    """Number of the bucket, from 1; a boundary value opens the bucket on its
    right and NULL falls into the first. Plain comparisons keep this inside
    generated code."""
    steps = [F.coalesce((column >= F.lit(bound)).cast("int"), F.lit(0)) for bound in sorted(boundaries)]
    return reduce(lambda left, right: left + right, steps, F.lit(1))


def year_starts(first: int, last: int) -> list[dt.date]:
    return [dt.date(year, 1, 1) for year in range(first, last + 1)]
