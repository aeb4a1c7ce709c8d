"""Inserts, deletes, updates and merges as functions from tables to tables.

Every function returns the new state and a log of what it did; nothing is
changed in place.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators.position import with_position
from ledgerlark.session import stage

Match = Callable[[Column], Column]


class Change(NamedTuple):
    table: DataFrame
    log: DataFrame


class AmbiguousMerge(ValueError):
    """A target row would be changed by more than one source row."""


def number_after(rows: DataFrame, order: Sequence[Column], key: str, target: DataFrame) -> DataFrame:
    """Give new rows the ids that follow the highest id of ``target``."""
    highest = target.agg(F.coalesce(F.max(key), F.lit(0))).scalar()
    placed = with_position(rows, order, "__n")
    return placed.withColumn(key, (F.col("__n") + highest).cast("long")).drop("__n")


def same(key: Column) -> Column:
    """Keys as they are; ``text.any_case`` and the like compare otherwise."""
    return key


def with_known(target: DataFrame, source: DataFrame, key: str, match: Match = same) -> DataFrame:
    """The source with ``__known``: whether the target holds its key.

    The only step of a merge that compares the source with the target's keys;
    the result is stored, since all others read it.
    """
    held = target.select(match(F.col(key)).alias("__match")).distinct().withColumn("__known", F.lit(True))
    return stage(
        source.withColumn("__match", match(F.col(key)))
        .join(held, "__match", "left")
        .select(*source.columns, F.coalesce("__known", F.lit(False)).alias("__known")),
        "merge-source",
    )


def with_new_ids(target: DataFrame, source: DataFrame, key: str, id_column: str, match: Match = same) -> DataFrame:
    """Number the source rows that a merge on ``key`` would insert; the others
    get NULL. Carries ``__known`` on to the merge."""
    flagged = with_known(target, source, key, match)
    fresh, known = flagged.filter("NOT __known"), flagged.filter("__known")
    # The hash spreads rows that share a key, or lack one, over several ranges.
    numbered = number_after(fresh, [F.col(key), F.xxhash64(*source.columns)], id_column, target)
    return numbered.unionByName(known, allowMissingColumns=True)


def insert(target: DataFrame, new_rows: DataFrame) -> Change:
    """Append; columns that ``new_rows`` lacks are NULL. The log is the inserted rows."""
    added = target.limit(0).unionByName(new_rows, allowMissingColumns=True).select(*target.columns)
    return Change(target.unionByName(added), added)


def delete(target: DataFrame, condition: Column) -> Change:
    """Rows for which ``condition`` is true go to the log."""
    hit = F.coalesce(condition, F.lit(False))
    return Change(target.filter(~hit), target.filter(hit))


def is_last(target: DataFrame, key: str) -> Column:
    """Condition for the row with the highest key."""
    return F.col(key) == target.agg(F.max(key)).scalar()


def update(target: DataFrame, condition: Column, values: dict[str, Column], key: str) -> Change:
    """Set columns where ``condition`` holds; the log has key, new_x, old_x."""
    hit = F.coalesce(condition, F.lit(False))
    table = target.withColumns({name: F.when(hit, new).otherwise(F.col(name)) for name, new in values.items()})
    pairs = [
        part
        for name, new in values.items()
        for part in (new.alias(f"new_{name}"), F.col(name).alias(f"old_{name}"))
    ]
    return Change(table, target.filter(hit).select(key, *pairs))


def ambiguous_keys(flagged: DataFrame, key: str, match: Match = same) -> DataFrame:
    """Keys that the target holds and several source rows have, with their number."""
    counted = flagged.filter("__known").groupBy(match(F.col(key)).alias("__match"))
    return counted.agg(F.min(key).alias(key), F.count("*").alias("source_rows")).filter("source_rows > 1").drop("__match")


def merge(
    target: DataFrame,
    source: DataFrame,
    key: str,
    on_match: dict[str, Column],
    on_insert: dict[str, Column],
    check: bool = True,
    match: Match = same,
) -> Change:
    """Upsert by ``key``.

    ``on_match`` and ``on_insert`` are written over the columns of ``source``;
    columns not named there keep the old value, or NULL for a new row. ``match``
    says how keys are compared. The log has one row per touched row: action, the
    key, and old and new values of the columns in ``on_match``. A source that
    would change a target row twice is refused.
    """
    flagged = source if "__known" in source.columns else with_known(target, source, key, match)
    if check and not ambiguous_keys(flagged, key, match).isEmpty():
        raise AmbiguousMerge(f"two source rows match one target row on {key}")
    setters = flagged.filter("__known").select(
        match(F.col(key)).alias("__key"), *[value.alias(f"__set_{name}") for name, value in on_match.items()]
    ).withColumn("__hit", F.lit(True))
    # A left join leaves Spark free to broadcast a small source, and to split
    # a hot key of the target; a full join would allow neither.
    touched = target.join(setters, match(F.col(key)) == F.col("__key"), "left")
    hit = F.col("__hit").isNotNull()

    dtypes = {field.name: field.dataType for field in target.schema.fields}

    def updated(name: str) -> Column:
        if name not in on_match:
            return F.col(name)
        return F.when(hit, F.col(f"__set_{name}").cast(dtypes[name])).otherwise(F.col(name))

    def inserted(name: str) -> Column:
        default = F.col(key) if name == key else F.lit(None)
        return on_insert.get(name, default).cast(dtypes[name])

    added = flagged.filter("NOT __known").select(*[inserted(name).alias(name) for name in target.columns])
    table = touched.select(*[updated(name).alias(name) for name in target.columns]).unionByName(added)

    def log_row(action: str, rows: DataFrame, old, new) -> DataFrame:
        return rows.select(
            F.lit(action).alias("action"),
            key,
            *[old(name).alias(f"old_{name}") for name in on_match],
            *[new(name).alias(f"new_{name}") for name in on_match],
        )

    nothing = lambda name: F.lit(None).cast(dtypes[name])
    log = log_row("UPDATE", touched.filter(hit), F.col, updated).unionByName(
        log_row("INSERT", added, nothing, F.col)
    )
    return Change(table, log)
