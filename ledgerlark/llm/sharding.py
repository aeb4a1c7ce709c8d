"""Placement of rows on shards by a permutation-filled lookup table.

Every shard prefers the slots of a prime-sized table in an order of its own.
The shards take turns; each claims its first preference that is still free,
until the table is full. The table is small and bounded by its size argument;
a broadcast of it places a row with one hash and one probe. Adding or removing
a shard moves few slots, and no shard has more than one slot above another.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bound of the table, and so of what is broadcast: about 16 bytes a slot.
MOST_SLOTS = 1_000_003


def hash63(text: str) -> int:
    """The first 15 hex digits of the MD5 of ``text``, as a number."""
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: list[str], slots: int) -> list[int]:
    """The shard number of every slot."""
    if not is_prime(slots) or slots > MOST_SLOTS:
        raise ValueError(f"the table size must be a prime up to {MOST_SLOTS}, not {slots}")
    if not 0 < len(shards) <= slots or len(set(shards)) < len(shards):
        raise ValueError("shards must be distinct, at least one, and no more than the slots")
    at = [hash63(f"{name}:offset") % slots for name in shards]
    step = [hash63(f"{name}:skip") % (slots - 1) + 1 for name in shards]
    table = [-1] * slots
    free = slots
    while free:
        for shard in range(min(len(shards), slots)):
            while table[at[shard]] >= 0:
                at[shard] = (at[shard] + step[shard]) % slots
            table[at[shard]] = shard
            free -= 1
            if not free:
                break
    return table


def slot_of(key: Column, slots: int) -> Column:
    """The slot of a key; a null key has slot 0."""
    number = F.conv(F.substring(F.md5(key.cast("string")), 1, 15), 16, 10).cast("long")
    return F.coalesce((number % F.lit(slots)).cast("int"), F.lit(0))


def table_frame(spark: SparkSession, shards: list[str], slots: int) -> DataFrame:
    """The lookup table as rows of ``slot`` and ``shard``."""
    filled = ",".join(map(str, lookup_table(shards, slots)))
    return spark.range(1).select(F.posexplode(F.split(F.lit(filled), ",")).alias("slot", "number")).select(
        "slot", F.col("number").cast("int").alias("shard")
    )


def place(docs: DataFrame, shards: list[str], slots: int, key: Column, shard: str = "shard", slot: str = "slot"):
    """``docs`` with two more columns, the slot of ``key`` and the number of its shard.

    Every row is placed: null keys go to slot 0, equal keys to one shard, and
    repeated rows stay. Columns of ``docs`` that are called like the new ones
    are replaced. Rows do not move: the join is a probe of the broadcast table,
    so a frequent key is no hot spot here.
    """
    lookup = table_frame(docs.sparkSession, shards, slots)
    kept = [c for c in docs.columns if c not in (shard, slot)]
    rows = docs.select(F.struct(*kept).alias("doc"), slot_of(key, slots).alias("slot"))
    return rows.join(F.broadcast(lookup), "slot").select(
        "doc.*", F.col("slot").alias(slot), F.col("shard").alias(shard)
    )
