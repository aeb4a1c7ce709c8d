"""What hangs together over references, to any depth: trees, and circles too.

Only keys travel. Each round follows the references from the keys that the round
before it found, and drops those known already; so a key is followed once, and a
circle ends when it closes.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators.quality import BlockedDelete, Reference
from ledgerlark.session import stage, unstage


def closure(
    tables: dict[str, DataFrame],
    keys: dict[str, str],
    references: Sequence[Reference],
    start: dict[str, DataFrame],
    up: bool = False,
) -> dict[str, DataFrame]:
    """Keys of all rows that are reached from ``start``, those included, by table.

    ``keys`` names the key of every table; references point at keys. From a row
    they lead down to the rows that refer to it, or with ``up`` to the rows it refers
    to. A table may refer to itself, and references may form a circle. NULL refers to nothing.
    """
    for ref in references:
        if ref.parent_key != keys[ref.parent]:
            raise ValueError(f"{ref.child}.{ref.child_key} does not point at the key of {ref.parent}")
    steps: dict[str, list[DataFrame]] = {name: [] for name in tables}
    edge = {name: stage(rows.select(F.col(rows.columns[0]).alias("key")).distinct(), "reached") for name, rows in start.items()}
    while edge:
        for name, rows in edge.items():
            steps[name].append(rows)
        found: dict[str, list[DataFrame]] = {}
        for ref in references:
            here, there = (ref.child, ref.parent) if up else (ref.parent, ref.child)
            if here not in edge:
                continue
            child, own = F.col(ref.child_key), F.col(keys[ref.child])
            links = tables[ref.child].filter(child.isNotNull()).select(
                (own if up else child).alias("key"), (child if up else own).alias("next")
            )
            found.setdefault(there, []).append(links.join(edge[here], "key").select(F.col("next").alias("key")))
        edge = {}
        for name, parts in found.items():
            new = reduce(DataFrame.unionByName, parts).distinct()
            for known in steps[name]:
                new = new.join(known, "key", "left_anti")
            rows = stage(new, "reached")
            if rows.isEmpty():
                unstage(rows)
            else:
                edge[name] = rows
    return {name: reduce(DataFrame.unionByName, parts) for name, parts in steps.items() if parts}


def cascade_closure(
    tables: dict[str, DataFrame], keys: dict[str, str], references: Sequence[Reference], root: str, condition: Column
) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Delete from ``root`` and from all that hangs on it, whatever the shape of the references.

    Returns (kept, deleted) for every table that loses rows. A reference that does not cascade
    stops the job when a row it protects would go, as in ``cascade_delete``.
    """
    first = tables[root].filter(F.coalesce(condition, F.lit(False))).select(keys[root])
    gone = closure(tables, keys, [r for r in references if r.cascades], {root: first})
    for ref in references:
        if not ref.cascades and ref.parent in gone:
            used = gone[ref.parent].withColumnRenamed("key", ref.child_key)
            if not tables[ref.child].join(used, ref.child_key, "left_semi").isEmpty():
                raise BlockedDelete(f"{ref.child}.{ref.child_key} still uses {ref.parent}")
    result = {}
    for name, found in gone.items():
        same = F.col(keys[name]) == F.col("__key")
        hit = found.withColumnRenamed("key", "__key")
        result[name] = (tables[name].join(hit, same, "left_anti"), tables[name].join(hit, same, "left_semi"))
    return result
