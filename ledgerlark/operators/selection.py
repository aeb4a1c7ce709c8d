"""Rows at given places of an order, found by counting instead of sorting.

A sample of the order's keys gives bounds that the wanted places should lie
between; one pass counts how many rows come before each bound. Where the bounds
hold, the rest of the table is out. What is left in the end is sorted: little
more than the page.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Keys that a pass samples, rows that are sorted at once, and passes at most; ties may need more rows sorted.
SAMPLE = 4_000
SORTED_ROWS = 100_000
PASSES = 20


class Key(NamedTuple):
    name: str
    descending: bool = False

    def column(self) -> Column:
        return F.col(self.name).desc_nulls_last() if self.descending else F.col(self.name).asc_nulls_first()


def _literal(value, kind: T.DataType) -> Column:
    if isinstance(value, (dt.datetime, dt.date)):
        return F.lit(str(value)).cast(kind)
    return F.lit(value).cast(kind)


def comes_before(keys: Sequence[Key], values: Sequence, schema: T.StructType) -> Column:
    """Whether a row comes before ``values`` in the order of ``keys``; NULL is the least value."""
    found = F.lit(False)
    for key, value in reversed(list(zip(keys, values, strict=True))):
        column, other = F.col(key.name), _literal(value, schema[key.name].dataType)
        if key.descending:
            less = column.isNotNull() if value is None else F.coalesce(column > other, F.lit(False))
        else:
            less = F.lit(False) if value is None else F.coalesce(column < other, F.lit(True))
        same = column.isNull() if value is None else F.coalesce(column == other, F.lit(False))
        found = less | (same & found)
    return found


def rows_at(df: DataFrame, skip: int, size: int, *order: str | Key) -> DataFrame:
    """The ``size`` rows after the first ``skip`` of an order; give an order without ties.

    Every pass reads the columns of the order alone and moves no rows but a sample of about
    ``SAMPLE`` keys. The counts are exact, so the sample decides how many passes there are, never
    which rows are returned.
    """
    keys = [Key(k) if isinstance(k, str) else k for k in order]
    names = list(dict.fromkeys(k.name for k in keys))
    narrow = df.select(*names)
    part, inside = narrow, F.lit(True)
    before, rows = 0, narrow.count()
    for turn in range(PASSES):
        if rows <= SORTED_ROWS:
            break
        sample = part.sample(min(1.0, SAMPLE / rows), seed=turn).orderBy(*[k.column() for k in keys]).collect()
        if not sample:
            continue
        # Three standard deviations of a sampled rank at most.
        slack = 1.5 * len(sample) ** 0.5 + 1
        first = int((skip - before) * len(sample) / rows - slack)
        last = int((skip + size - before) * len(sample) / rows + slack) + 1
        bounds = {}
        if first >= 0:
            bounds["low"] = [sample[min(first, len(sample) - 1)][k.name] for k in keys]
        if last < len(sample):
            bounds["high"] = [sample[last][k.name] for k in keys]
        if not bounds:
            break
        tests = {name: comes_before(keys, values, df.schema) for name, values in bounds.items()}
        counts = part.agg(*[F.count_if(test).alias(name) for name, test in tests.items()]).first()
        low = counts["low"] if "low" in tests else 0
        high = counts["high"] if "high" in tests else rows
        cut = F.lit(True)
        if "low" in tests and before + low <= skip:
            cut &= ~tests["low"]
        else:
            low = 0
        if "high" in tests and before + high >= skip + size:
            cut &= tests["high"]
        else:
            high = rows
        if high - low == rows:
            continue
        part, inside = part.filter(cut), inside & cut
        before, rows = before + low, high - low
    return df.filter(inside).orderBy(*[k.column() for k in keys]).offset(skip - before).limit(size)
