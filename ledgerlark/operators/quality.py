"""Integrity rules as queries that return the rows breaking them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str], primary: bool = False) -> DataFrame:
    """Keys held by several rows, with their number.

    A unique key may hold NULL once; a primary key may not hold it at all.
    Only one row per key and task is shuffled.
    """
    counted = df.groupBy(*keys).agg(F.count("*").alias("copies"))
    wrong = F.col("copies") > 1
    if primary:
        for key in keys:
            wrong = wrong | F.col(key).isNull()
    return counted.filter(wrong)


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent, with the number of child rows.

    One aggregate over the keys of both sides: every task shrinks its rows to distinct keys
    before the shuffle, so nothing is sorted and a key that most rows have is one row a task.
    """
    kind = child.schema[child_key].dataType
    rows = child.select(F.col(child_key).alias("missing_key"), F.lit(True).alias("is_child")).unionByName(
        parent.select(F.col(parent_key).alias("missing_key"), F.lit(False).alias("is_child"))
    )
    return (
        rows.filter(F.col("missing_key").isNotNull())
        .groupBy("missing_key")
        .agg(F.count_if("is_child").alias("child_rows"), F.bool_and("is_child").alias("missing"))
        .filter("missing")
        .select(F.col("missing_key").cast(kind).alias("missing_key"), "child_rows")
    )


def is_padded_or_blank(column: Column) -> Column:
    """True for text that is empty, only blanks, or starts or ends with a
    blank; NULL passes the rule."""
    trimmed = F.trim(column)
    return F.coalesce((F.length(trimmed) == 0) | (column != trimmed), F.lit(False))


def is_negative(column: Column) -> Column:
    """True for a negative number; NULL passes the rule."""
    return F.coalesce(column, F.lit(0)) < 0


def with_default_now(df: DataFrame, column: str, now: Column | None = None) -> DataFrame:
    """Fill a missing time with the current one (or a given clock)."""
    clock = F.current_timestamp() if now is None else now
    return df.withColumn(column, F.coalesce(F.col(column), clock))


class Reference(NamedTuple):
    """Rows of ``child`` point at rows of ``parent``."""

    child: str
    child_key: str
    parent: str
    parent_key: str
    cascades: bool = True


class BlockedDelete(ValueError):
    """A row to be deleted is still in use and the rule forbids to follow."""


class BlockedChange(ValueError):
    """A key to be changed is still in use and the rule forbids to follow."""


def cascade_flags(
    tables: dict[str, DataFrame], references: Sequence[Reference], root: str, condition: Column
) -> dict[str, DataFrame]:
    """``root`` and all that points at it, every row with ``__gone``: whether a
    delete from ``root`` takes it along.

    A reference that does not cascade stops the job when a row it protects
    would go. A table is joined once with the keys that go of each parent.
    """
    flagged = {root: tables[root].withColumn("__gone", F.coalesce(condition, F.lit(False)))}
    for name in _parents_first(references, root):
        if name == root:
            continue
        found = tables[name]
        marks = []
        for ref in references:
            if ref.child != name or ref.parent not in flagged:
                continue
            gone = flagged[ref.parent].filter("__gone").select(F.col(ref.parent_key).alias("__key")).distinct()
            if not ref.cascades:
                if not tables[name].join(gone, F.col(ref.child_key) == F.col("__key"), "left_semi").isEmpty():
                    raise BlockedDelete(f"{ref.child}.{ref.child_key} still uses {ref.parent}")
                continue
            mark = f"__gone_{len(marks)}"
            keys = gone.select(F.col("__key").alias(f"__key_{mark}"), F.lit(True).alias(mark))
            found = found.join(keys, F.col(ref.child_key) == F.col(f"__key_{mark}"), "left")
            marks.append(mark)
        if marks:
            hit = reduce(lambda a, b: a | b, [F.coalesce(mark, F.lit(False)) for mark in marks])
            flagged[name] = found.select(*tables[name].columns, hit.alias("__gone"))
    return flagged


def cascade_delete(
    tables: dict[str, DataFrame], references: Sequence[Reference], root: str, condition: Column
) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Delete from ``root`` and, table by table, from all that points at it.

    Returns (kept, deleted) for every table.
    """
    return {
        name: (rows.filter("NOT __gone").drop("__gone"), rows.filter("__gone").drop("__gone"))
        for name, rows in cascade_flags(tables, references, root, condition).items()
    }


def cascade_key_change(
    tables: dict[str, DataFrame], references: Sequence[Reference], root: str, key: str, new_keys: DataFrame
) -> dict[str, DataFrame]:
    """Give rows of ``root`` new keys and let references to them follow.

    ``new_keys`` has old_key and new_key. A reference that does not cascade
    stops the job when it holds a key that would change. Where a changed
    column is itself referenced, the change travels on. An old key may be
    listed once.
    """
    if not duplicate_keys(new_keys, ["old_key"]).isEmpty():
        raise ValueError("an old key has several new keys")
    result = dict(tables)
    waiting = [(root, key)]
    seen = set(waiting)
    while waiting:
        table, column = waiting.pop()
        result[table] = _with_new_keys(result[table], column, new_keys)
        for ref in references:
            if (ref.parent, ref.parent_key) != (table, column) or (ref.child, ref.child_key) in seen:
                continue
            if not ref.cascades:
                old = new_keys.select(F.col("old_key").alias(ref.child_key))
                if tables[ref.child].join(old, ref.child_key, "left_semi").limit(1).count():
                    raise BlockedChange(f"{ref.child}.{ref.child_key} still uses {ref.parent}")
                continue
            seen.add((ref.child, ref.child_key))
            waiting.append((ref.child, ref.child_key))
    return result


def _with_new_keys(df: DataFrame, column: str, new_keys: DataFrame) -> DataFrame:
    kind = df.schema[column].dataType
    changed = F.coalesce("new_key", F.col(column)).cast(kind)
    return (
        df.join(new_keys, F.col(column) == F.col("old_key"), "left")
        .withColumn(column, changed)
        .select(*df.columns)
    )


def _parents_first(references: Sequence[Reference], root: str) -> list[str]:
    """Tables reachable from ``root``, each after all of its parents."""
    reach = {root}
    # Rows of such a table would have to be followed to any depth.
    if any(ref.child == ref.parent for ref in references):
        raise ValueError("a table refers to itself")
    grown = True
    while grown:
        more = {ref.child for ref in references if ref.parent in reach} - reach
        reach |= more
        grown = bool(more)
    done: list[str] = []
    while len(done) < len(reach):
        ready = [
            name
            for name in sorted(reach)
            if name not in done
            and all(
                ref.parent in done or ref.parent == name
                for ref in references
                if ref.child == name and ref.parent in reach
            )
        ]
        if not ready:
            raise ValueError("references form a circle")
        done += ready
    return done
