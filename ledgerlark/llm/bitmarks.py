"""A bounded set of bits that says which keys may be wanted, sent to all tasks.

A key sets one bit. Where the bit of a key is not set, the key is not in the set;
where it is, the key may be another one, so what passes is checked again by a
join or a count. Eight megabytes, however many keys there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.arrays import U64

MARKS = 1 << 26
# Words of 64 bits that are gathered in one row.
PIECE = 1 << 13
# Bits of a hash that keys are counted by.
KEY_BITS = 40
# Keys that a task gathers before it sends them on.
GATHERED = 2_000_000


def marks_of(keys: DataFrame, key: str):
    """The bits of all keys as a broadcast array; the driver holds the array alone."""
    slot = F.col(key).bitwiseAND(F.lit(MARKS - 1))
    bits = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))
    return _sent(keys.select(F.shiftright(slot, 6).alias("place"), bits.alias("bits")))


def _sent(bits: DataFrame):
    """All bits (``place``, ``bits``) as one array; the driver gets them in pieces of 64 KB."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[int, np.ndarray] = {}
        for batch in batches:
            place, found = (batch.column(i).to_numpy() for i in range(2))
            for piece in np.unique(place // PIECE).tolist():
                mine = place // PIECE == piece
                held = pieces.setdefault(piece, np.zeros(PIECE, U64))
                np.bitwise_or.at(held, place[mine] % PIECE, found[mine].view(U64))
        columns = [pa.array(list(pieces), pa.int64()), pa.array([held.tobytes() for held in pieces.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["piece", "held"])

    dealt = bits.repartition(F.floor(F.col("place") / PIECE))
    marks = np.zeros(MARKS // 64, U64)
    for row in dealt.mapInArrow(gather, "piece long, held binary").collect():
        marks[row["piece"] * PIECE : (row["piece"] + 1) * PIECE] |= np.frombuffer(row["held"], U64)
    return bits.sparkSession.sparkContext.broadcast(marks)


def counts_of(counted: DataFrame, slots: int):
    """The sums of ``n`` for all ``slots`` as a broadcast array of 32 bits, where they stop; the driver gets them in pieces of 32 KB."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[int, np.ndarray] = {}
        for batch in batches:
            slot, n = (batch.column(i).to_numpy() for i in range(2))
            for piece in np.unique(slot // PIECE).tolist():
                mine = slot // PIECE == piece
                held = pieces.setdefault(piece, np.zeros(PIECE, np.int64))
                np.add.at(held, slot[mine] % PIECE, n[mine])
        most = np.iinfo(np.int32).max
        held = [np.minimum(n, most).astype(np.int32).tobytes() for n in pieces.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(pieces), pa.int64()), pa.array(held, pa.binary())], ["piece", "held"])

    dealt = counted.select("slot", "n").repartition(F.floor(F.col("slot") / PIECE))
    counts = np.zeros(-(-slots // PIECE) * PIECE, np.int32)
    for row in dealt.mapInArrow(gather, "piece long, held binary").collect():
        counts[row["piece"] * PIECE : (row["piece"] + 1) * PIECE] = np.frombuffer(row["held"], np.int32)
    return counted.sparkSession.sparkContext.broadcast(counts[:slots])


def marked(marks: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys may be in the set."""
    slot = keys & U64(MARKS - 1)
    return (marks[(slot >> U64(6)).astype(np.int64)] >> (slot & U64(63))) & U64(1) == 1


def keep_marked(rows: DataFrame, key: str, marks) -> DataFrame:
    """The rows whose bit is set, and so some others; null keys go."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(key))
            known = keys.is_valid().to_numpy(zero_copy_only=False)
            good = marked(marks.value, keys.fill_null(0).to_numpy().view(U64)) & known
            yield batch.filter(pa.array(good))

    return rows.mapInArrow(keep, rows.schema)


def short_key(hashes: np.ndarray) -> np.ndarray:
    """The first bits of a hash. Two hashes with one short key are counted together, so counts are upper bounds."""
    return hashes >> U64(64 - KEY_BITS)


def _packed(keys: np.ndarray, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Ascending keys as differences, byte by byte, in a row for each range of keys that has some."""
    bucket = (keys * U64(buckets) >> U64(KEY_BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    steps = np.diff(keys, prepend=U64(0))
    steps[first] = keys[first]
    ends = np.append(first[1:], len(keys))
    rows = [steps[a:b].view(np.uint8).reshape(-1, 8).T.tobytes() for a, b in zip(first, ends, strict=True)]
    times = [counts[a:b].astype(np.uint8).tobytes() for a, b in zip(first, ends, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(bucket[first]), pa.array(rows, pa.binary()), pa.array(times, pa.binary())], ["bucket", "keys", "counts"])


def _unpacked(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps = np.ascontiguousarray(np.frombuffer(keys, np.uint8).reshape(8, -1).T).view(U64).ravel()
    return np.cumsum(steps, dtype=U64), np.frombuffer(counts, np.uint8).astype(np.int64)


def _added(parts: list[tuple[np.ndarray, np.ndarray]], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all parts with the sums of their counts, which stop at ``least``."""
    keys, counts = (np.concatenate(side) for side in zip(*parts, strict=True))
    # One number of key and count sorts faster than an order of the keys; stable, as it merges ascending runs.
    both = np.sort(keys << U64(8) | counts.astype(U64), kind="stable")
    keys, counts = both >> U64(8), (both & U64(255)).astype(np.int64)
    first = np.flatnonzero(np.diff(keys, prepend=keys[:1] + U64(1))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.minimum(np.add.reduceat(counts, first), least) if len(keys) else counts


def often(rows: DataFrame, keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], least: int):
    """The bits of all short keys that occur ``least`` times or more, as a broadcast array.

    ``keys_of`` gives the hashes that a batch of ``rows`` holds. Each task sends sorted runs of its
    distinct keys, some three bytes a key, cut by range; a range is merged in one task. The counts
    need only be right up to ``least``, at most 255.
    """
    spark = rows.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for hashes in keys_of(batch):
                keys, counts = np.unique(short_key(hashes), return_counts=True)
                parts.append((keys, np.minimum(counts, least)))
                size += len(keys)
                if size >= GATHERED:
                    parts = [_added(parts, least)]
                    if len(parts[0][0]) >= GATHERED // 2:
                        yield _packed(*parts[0], buckets)
                        parts = []
                    size = len(parts[0][0]) if parts else 0
        if size:
            yield _packed(*_added(parts, least), buckets)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(parts):
            keys, counts = _added(parts, least)
            slot = keys[counts >= least] & U64(MARKS - 1)
            bits = (U64(1) << (slot & U64(63))).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array((slot >> U64(6)).astype(np.int64)), pa.array(bits)], ["place", "bits"])

        now, parts = None, []
        for batch in batches:
            for bucket, keys, counts in zip(*(batch.column(i) for i in range(3)), strict=True):
                if bucket.as_py() != now and parts:
                    yield found(parts)
                    parts = []
                now = bucket.as_py()
                parts.append(_unpacked(keys.as_buffer(), counts.as_buffer()))
        if parts:
            yield found(parts)

    runs = rows.mapInArrow(send, "bucket long, keys binary, counts binary")
    # Without a number Spark brings small partitions together.
    merged = runs.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(merge, "place long, bits long")
    return _sent(merged)
