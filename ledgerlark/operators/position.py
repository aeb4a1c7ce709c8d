"""Row positions and neighbours in one order over the whole table.

A window without a partition key would pull the table into one task. Here the
rows are range-partitioned and sorted once; a small table with one row per
partition then turns places inside a partition into places in the whole order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.session import stage

# monotonically_increasing_id keeps the partition number above this bit and
# the place in the partition below it.
ROW_BITS = 33

CHUNK_ROWS = 500_000


def with_position(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Add the place of every row, from 1, in the given order.

    Give an order without ties where the places must be repeatable; it also
    lets a value that many rows share spread over several ranges.
    """
    # Without a number, Spark joins small ranges; they stay in order.
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(sorted_rows.withColumn("__id", F.monotonically_increasing_id()), "placed")
    slot = F.shiftright("__id", ROW_BITS)
    in_slot = F.col("__id").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    # One row per range: at most spark.sql.shuffle.partitions rows.
    before = Window.orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(slot.alias("__slot"))
        .agg(F.count("*").alias("__rows"))
        .select("__slot", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    )
    return (
        placed.withColumn("__slot", slot)
        .join(F.broadcast(offsets), "__slot")
        .withColumn(name, F.col("__before") + in_slot + 1)
        .select(*df.columns, name)
    )


def with_neighbours(
    df: DataFrame, position: str, wanted: dict[str, tuple[str, int, object]], chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Add values of rows a fixed number of places away.

    ``wanted`` maps a new column to (column, places, default); negative places
    look back. ``position`` must run from 1 without gaps. The order is cut
    into equal chunks, and the few rows at a chunk's edges are also sent to the
    chunk next to it, so no window is larger than a chunk.
    """
    reach = max(abs(places) for _, places, _ in wanted.values())
    if chunk_rows <= reach:
        raise ValueError("a chunk must be longer than the farthest neighbour")
    at = F.col(position) - 1
    chunk = F.floor(at / chunk_rows).cast("long")
    place = at - chunk * chunk_rows
    copies = F.array_compact(
        F.array(
            chunk,
            F.when(place < reach, chunk - 1),
            F.when(place >= chunk_rows - reach, chunk + 1),
        )
    )
    sent = df.withColumn("__home", chunk).withColumn("__chunk", F.explode(copies))
    order = Window.partitionBy("__chunk").orderBy(position)
    for name, (column, places, default) in wanted.items():
        look = F.lag(column, -places, default) if places < 0 else F.lead(column, places, default)
        sent = sent.withColumn(name, look.over(order))
    return sent.filter(F.col("__chunk") == F.col("__home")).drop("__home", "__chunk")


def tile(position: Column, rows: Column, tiles: int) -> Column:
    """Group number when ``rows`` places are dealt into ``tiles`` groups whose
    sizes differ by one at most, larger groups first."""
    size = F.floor(rows / tiles)
    extra = rows % tiles
    in_large = extra * (size + 1)
    return (
        F.when(position <= in_large, F.floor((position - 1) / (size + 1)) + 1)
        .otherwise(extra + F.floor((position - 1 - in_large) / F.greatest(size, F.lit(1))) + 1)
        .cast("int")
    )
