"""Near-duplicate lines across a corpus by MinHash.

A line is the set of its runs of eight characters, after letters are lowered
and white space is one space. One hash per run gives a signature of forty
components (each keeps the smallest hash of the runs that fall on it; empty ones
borrow from the next). Lines that share a band of four are compared by their
exact Jaccard similarity; links are joined to components by union-find over
tables, and of each component one line of the corpus stays, the first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.arrays import U64, fold, mix64
from ledgerlark.llm.bitmarks import marked, marks_of, often, short_key
from ledgerlark.llm.buckets import FACT_TYPES, crowded, facts, settle
from ledgerlark.llm.near_duplicates import text_key
from ledgerlark.session import stage, unstage

CHARS = 8
SIMILARITY = 0.8
# A pair at the threshold shares none of the bands with probability 0.005.
BANDS, ROWS = 10, 4
# Rounds of cheap comparisons in large buckets, before all that is left is compared.
ROUNDS = 2
SLICE_CHARS = 1_000_000
# Characters whose arrays are worked on at once: they stay in a core's cache.
BLOCK_CHARS = 50_000
# Bits of a run's hash that lines are compared by.
HASH_BITS = 55

_BASE = 0x9E3779B97F4A7C15
_BORROW = 0xD1B54A32D192ED03


# White space other than the space and the line end.
_ODD_SPACES = "\t\v\f\r\x1c\x1d\x1e\x1f"
_FAR_SPACES = "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))


def normal(line: str) -> str:
    return " ".join(line.split()).lower()


def normal_lines(text: str) -> list[str]:
    """All lines in normal form; in one go where only single spaces stand between words."""
    odd = _ODD_SPACES if text.isascii() else _ODD_SPACES + _FAR_SPACES
    if "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " " or any(c in text for c in odd):
        return [normal(line) for line in text.split("\n")]
    # Of bytes, letters are lowered several times faster.
    low = text.encode("ascii").lower().decode("ascii") if text.isascii() else text.lower()
    return low.split("\n")


def _windows(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the eight characters from every place on, over line ends too, and the length of every line, filled up to eight."""
    filled = [line.ljust(CHARS) for line in lines]
    text = "".join(filled)
    coded = np.frombuffer(text.encode("ascii"), np.uint8) if text.isascii() else np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    data = coded.astype(U64)
    for step in (1, 2, 4):
        later = data[step:]
        data = data[:-step] * U64(pow(_BASE, step, 1 << 64))
        data += later
    return mix64(data), np.fromiter(map(len, filled), np.int64, len(filled))


def _over(lengths: np.ndarray) -> np.ndarray:
    """The places from which eight characters run over a line end."""
    return (np.cumsum(lengths)[:-1, None] - np.arange(1, CHARS)).ravel()


def runs(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and line number of all runs of eight characters; a shorter line is filled up."""
    found, lengths = _windows(lines)
    whole = np.ones(len(found), bool)
    whole[_over(lengths)] = False
    return found[whole], np.repeat(np.arange(len(lines)), lengths - (CHARS - 1))


def signatures(lines: list[str]) -> np.ndarray:
    """Band hashes of every line."""
    ends = np.cumsum([max(len(line), CHARS) for line in lines], dtype=np.int64)
    cuts = np.flatnonzero(np.diff(ends // BLOCK_CHARS, prepend=0)).tolist()
    edges = [0, *(at for at in cuts if at), len(lines)]
    return np.concatenate([_signed(lines[a:b]) for a, b in zip(edges, edges[1:], strict=False)])


def _signed(lines: list[str]) -> np.ndarray:
    size = BANDS * ROWS
    empty = np.iinfo(np.uint64).max
    found, lengths = _windows(lines)
    found[_over(lengths)] = empty
    slot = ((found >> U64(32)) * U64(size)) >> U64(32)
    slot += np.repeat(np.arange(len(lines), dtype=U64) * U64(size), lengths)[: len(found)]
    least = np.full(len(lines) * size, empty, U64)
    np.minimum.at(least, slot.view(np.int64), found)
    least = least.reshape(len(lines), size)
    short = np.flatnonzero((least == empty).any(axis=1))
    least[short] = _filled(least[short], empty)
    parts = least.reshape(len(lines), BANDS, ROWS)
    return fold([parts[:, :, j] for j in range(ROWS)]) ^ mix64(np.arange(1, BANDS + 1, dtype=U64))


def _filled(least: np.ndarray, empty: int) -> np.ndarray:
    """Empty components borrow from the next one that is not, marked by the distance."""
    size = least.shape[1]
    at = np.where(least != empty, np.arange(size), 2 * size)
    at = np.concatenate([at, at + size], axis=1)  # once more round the end
    at = np.minimum.accumulate(at[:, ::-1], axis=1)[:, ::-1][:, :size]
    step = (at - np.arange(size)).astype(U64)
    return np.take_along_axis(least, at % size, axis=1) + step * U64(_BORROW)


def _line_hash(lines: list[str]) -> np.ndarray:
    """One hash of all characters of each line."""
    digests = [hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest() for line in lines]
    return np.frombuffer(b"".join(digests), U64)


def _sliced(texts) -> Iterator[tuple[np.ndarray, np.ndarray, list[str]]]:
    """Text numbers, places and normal forms of all lines that are not blank, in
    slices of about a million characters; a long text fills several."""
    numbers, spots, held, size = [], [], [], 0
    for number, text in enumerate(texts):
        lines = normal_lines(text or "")
        step = len(lines) if len(text or "") <= SLICE_CHARS else 100
        for start in range(0, len(lines), step):
            found = [(place, line) for place, line in enumerate(lines[start : start + step], start) if line]
            if found:
                places, kept = zip(*found, strict=True)
                numbers += [number] * len(kept)
                spots += places
                held += kept
                size += sum(map(len, kept))
            if size >= SLICE_CHARS:
                yield np.array(numbers), np.array(spots), held
                numbers, spots, held, size = [], [], [], 0
    if held:
        yield np.array(numbers), np.array(spots), held


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every line, and one with place -1 for every document, with the places of its lines.

    Of equal lines of a slice the first carries the bands, eight bytes each.
    """
    names = ["id", "t", "place", "line", "bands", "places"]
    for batch in batches:
        own = [batch.column(0), batch.column(1)]
        counts, spots = np.zeros(len(batch), np.int64), []
        for numbers, places, held in _sliced(batch.column(2).to_pylist()):
            hashes = _line_hash(held)
            first = np.sort(np.unique(hashes, return_index=True)[1])
            rows = signatures([held[i] for i in first])
            ends = np.zeros(len(held) + 1, np.int32)
            ends[first + 1] = rows.itemsize * BANDS
            np.cumsum(ends, out=ends)
            signs = np.zeros(len(held), bool)
            signs[first] = True
            null = pa.py_buffer(np.packbits(signs, bitorder="little").tobytes())
            bands = pa.Array.from_buffers(pa.binary(), len(held), [null, pa.py_buffer(ends.tobytes()), pa.py_buffer(rows.tobytes())])
            counts += np.bincount(numbers, minlength=len(batch))
            spots.append(places.astype(np.int32))
            of = pa.array(numbers)
            columns = [column.take(of) for column in own]
            columns += [pa.array(spots[-1]), pa.array(hashes.view(np.int64)), bands, pa.nulls(len(held), pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names)
        ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        lined = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*spots, np.zeros(0, np.int32)])))
        columns = [*own, pa.array(np.full(len(batch), -1, np.int32)), pa.nulls(len(batch), pa.int64()), pa.nulls(len(batch), pa.binary()), lined]
        yield pa.RecordBatch.from_arrays(columns, names)


def _lines(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    yield batch.column(0).to_numpy().view(U64)


def _met(again, linked):
    """The rows whose line may have several rows (``again``) or be linked (``linked``), by its bits."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = batch.column(batch.schema.get_field_index("line")).to_numpy().view(U64)
            yield batch.filter(pa.array(marked(again.value, short_key(lines)) | marked(linked.value, lines)))

    return keep


def _texts(wanted):
    """Hash and text of the lines of a batch whose bits are set in ``wanted``, each once in a slice."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, held in _sliced(batch.column(0).to_pylist()):
                hashes = _line_hash(held)
                kept = np.flatnonzero(marked(wanted.value, hashes))
                hashes, first = np.unique(hashes[kept], return_index=True)
                lines = pa.array([held[i] for i in kept[first]], pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), lines], ["t", "line"])

    return find


def _distinct(lines: list[str]) -> np.ndarray:
    """Number of the line and 55 bits of a hash, as one ascending number, for all its runs, each once. Up to 512 lines."""
    found, owner = runs(lines)
    keys = owner.astype(U64) << U64(HASH_BITS) | found >> U64(64 - HASH_BITS)
    # Lines ascend, so some of them are sorted at a time.
    edges = np.searchsorted(owner, np.arange(0, len(lines), 64)).tolist()
    for a, b in zip(edges, [*edges[1:], len(keys)], strict=True):
        keys[a:b].sort()
    return keys[np.diff(keys, prepend=~keys[:1]) != 0]


def _owner(keys: np.ndarray) -> np.ndarray:
    return (keys >> U64(HASH_BITS)).astype(np.int64)


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for start in range(0, len(batch), 500):
            part = batch.iloc[start : start + 500]
            a, b = _distinct(part["line_a"].tolist()), _distinct(part["line_b"].tolist())
            both = np.sort(np.concatenate([a, b]), kind="stable")  # two ascending runs: one merge
            common = np.bincount(_owner(both[1:][both[1:] == both[:-1]]), minlength=len(part))
            union = np.bincount(_owner(both), minlength=len(part)) - common
            yield part.loc[common >= SIMILARITY * union, ["a", "b"]]


def _elements(batch: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]]:
    """The runs of every line, each once."""
    for start in range(0, len(batch), 500):
        part = batch.iloc[start : start + 500]
        keys = _distinct(part["line"].tolist())
        yield part, _owner(keys), keys & U64((1 << HASH_BITS) - 1), np.ones(len(keys), np.int64)


def _known(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The facts of every line."""
    for batch in batches:
        for part, owner, found, weight in _elements(batch):
            yield part[["t"]].reset_index(drop=True).assign(**facts(owner, found, weight, len(part)))


def decide(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Which lines of every document go.

    One row per row of ``docs``: ``doc_id``, ``t`` (a hash of the text),
    ``copy`` (from 1 among rows equal in id and text), ``n_lines`` (lines that
    are not blank), ``dropped`` (their places from 0, ascending) and ``kept`` (for each
    of them the document and place of the line that stays for its component).

    Of a component the line stays whose document has the smallest id (a null
    id is the smallest, then the smaller text hash), and in it the first. Rows equal
    in id and text are copies: the second and later ones lose all their lines. Blank
    lines are no lines and are never dropped. A null or empty text has no
    lines. An empty table gives no rows. Other columns are not read.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("id"), text_key(F.col(text)).alias("t"), F.col(text).alias("text"))
    signed = stage(
        rows.mapInArrow(_sign, f"id {kind}, t bigint, place int, line bigint, bands binary, places array<int>"), "lines"
    )
    again = often(signed.filter("place >= 0").select("line"), _lines, 2)
    shared = crowded(signed.filter("bands IS NOT NULL").select(F.col("line").alias("t"), "bands"), again)
    wanted = stage(shared.select("t").distinct(), "candidates")
    # Bits of the hashes let a task drop most other lines; the join drops the rest.
    lines = rows.select("text").mapInArrow(_texts(marks_of(wanted, "t")), "t bigint, line string")
    kept = stage(lines.join(wanted, "t", "left_semi").dropDuplicates(["t"]), "candidate-lines")
    known = stage(kept.mapInPandas(_known, f"t bigint, {FACT_TYPES}"), "facts")

    def verify(pairs: DataFrame) -> DataFrame:
        one = kept.select(F.col("t").alias("a"), F.col("line").alias("line_a"))
        two = kept.select(F.col("t").alias("b"), F.col("line").alias("line_b"))
        return pairs.join(one, "a").join(two, "b").mapInPandas(_verify, "a bigint, b bigint")

    labels = settle(shared, verify, kept, known, _elements, SIMILARITY, ROUNDS).withColumnRenamed("node", "line")
    unstage(shared, wanted, kept, known)
    # A line of one row without links stays, whatever the others do: most lines go no further.
    spots = signed.filter("place >= 0").select("id", "t", "place", "line")
    spots = spots.mapInArrow(_met(again, marks_of(labels, "line")), spots.schema)
    named = stage(
        spots.join(labels, "line", "left").select("id", "t", "place", F.coalesce("label", "line").alias("label")), "named"
    )
    heads = named.groupBy("label").agg(F.min(F.struct("id", "t", "place")).alias("head"))
    gone = (
        named.join(heads, "label")
        .filter(~F.struct("id", "t", "place").eqNullSafe(F.col("head")))
        .select("id", "t", "place", F.struct(F.col("head.id").alias("doc_id"), F.col("head.place").alias("place")).alias("head"))
    )
    # Of a document come its row, with the places of all its lines, and its lines that go, each with what stays for it.
    found = (
        signed.filter("place < 0")
        .select("id", "t", "places", F.lit(None).cast("int").alias("place"), F.lit(None).cast(gone.schema["head"].dataType).alias("head"))
        .unionByName(gone.withColumn("places", F.lit(None).cast("array<int>")))
        .groupBy("id", "t")
        .agg(
            F.count("places").alias("copies"),
            F.first("places", ignorenulls=True).alias("places"),
            F.collect_set(F.when(F.col("head").isNotNull(), F.struct("place", F.col("head").alias("kept")))).alias("gone"),
        )
    )
    # A second or later copy loses its other lines too, to the first.
    stays = F.array_except("places", F.transform("gone", lambda x: x["place"]))
    own = F.transform(stays, lambda p: F.struct(p.alias("place"), F.struct(F.col("id").alias("doc_id"), p.alias("place")).alias("kept")))
    lost = F.sort_array(F.when(F.col("copy") > 1, F.concat("gone", own)).otherwise(F.col("gone")))
    return (
        found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .withColumn("lost", lost)
        .select(
            F.col("id").alias("doc_id"),
            "t",
            "copy",
            F.size("places").alias("n_lines"),
            F.transform("lost", lambda x: x["place"]).alias("dropped"),
            F.transform("lost", lambda x: x["kept"]).alias("kept"),
        )
    )


def clean(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` of every row, without the lines that go. Null texts are empty."""
    found = decide(docs, doc_id, text).select(F.col("doc_id").alias("of"), F.col("t").alias("of_t"), "copy", "dropped")
    once = (
        docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .withColumn("t", text_key(F.col("text")))
        .dropDuplicates(["doc_id", "t"])
    )
    lines = F.filter(F.split("text", "\n"), lambda line, at: ~F.array_contains(F.col("dropped"), at))
    return found.join(once, (F.col("t") == F.col("of_t")) & F.col("doc_id").eqNullSafe(F.col("of"))).select(
        "doc_id", F.concat_ws("\n", lines).alias("text")
    )


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: lines, lines that go, their places, and where the line stands that stays for each."""
    return decide(docs, doc_id, text).select(
        "doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.size("dropped").cast("long").alias("n_dropped"),
        "dropped",
        F.transform("kept", lambda x: x["doc_id"]).alias("kept_doc_ids"),
        F.transform("kept", lambda x: x["place"]).alias("kept_places"),
    )
