"""Delimited files of wide characters, read in byte ranges by many tasks.

Spark cuts a file at any byte and gives each task the lines that begin in its range.
A quoted value may hold line ends, so a range may begin inside one. A first pass counts
the quotes of every range; from these it is known which ranges begin inside a value. A second
pass puts lines together to records, range by range. What is left open at the ends of
ranges, two pieces each at most, is joined afterwards.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Bytes of a character's unit by encoding, in a stated order of bytes.
UNITS = {"UTF-16LE": 2, "UTF-16BE": 2}
# Order of the pieces of a range: what continues a record comes before what opens one.
WHOLE, CONTINUED, OPENED = 0, 1, 2


class CutCharacter(ValueError):
    """The bytes of a line end stand across two characters, so ranges cannot be told apart."""


def _raw_lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """Bytes of all lines with their file and the start of the range they were read in."""
    lines = spark.read.option("encoding", encoding).option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("line"),
    )


def _begin_inside(lines: DataFrame, encoding: str) -> tuple[set[tuple[str, int]], bool]:
    """The ranges that begin inside a quoted value, and whether any value is open at the end of a range.

    One row a range is looked at.
    """
    quote = F.lit('"'.encode(encoding).hex().upper())
    text = F.decode("line", encoding)
    quotes = F.length(text) - F.length(F.replace(text, F.lit('"')))
    counted = lines.groupBy("file", "block").agg(
        F.sum(F.when(F.contains(F.hex("line"), quote), quotes).otherwise(0)).alias("quotes"),
        F.sum((F.octet_length("line") % UNITS[encoding] != 0).cast("int")).alias("torn"),
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("quotes").over(earlier), F.lit(0))
    states = counted.select(
        "file", "block", "torn", (before % 2 == 1).alias("inside"), ((before + F.col("quotes")) % 2 == 1).alias("open")
    )
    found = states.filter(F.col("inside") | F.col("open") | (F.col("torn") > 0)).collect()
    if any(row["torn"] for row in found):
        raise CutCharacter("a line end stands across two characters; load this file without cutting it")
    return {(row["file"], row["block"]) for row in found if row["inside"]}, bool(found)


def _assembled(inside: set[tuple[str, int]], encoding: str):
    mark = codecs.BOM_UTF16_LE.decode("utf-16-le")

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, open_, continued = None, [], False, False

        def rest():
            # A range that never leaves the value it began in continues it as a whole.
            return [(*now, CONTINUED if continued else OPENED, "\n".join(held))] if held else []

        for batch in batches:
            out = []
            for file, block, line in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if (file, block) != now:
                    if now:
                        out += rest()
                    now, held = (file, block), []
                    open_ = continued = now in inside
                    first = block == 0
                text = line.decode(encoding)
                if first:
                    text, first = text.removeprefix(mark), False
                held.append(text)
                if text.count('"') % 2:
                    open_ = not open_
                if not open_:
                    record = held[0] if len(held) == 1 else "\n".join(held)
                    out.append((file, block, CONTINUED if continued else WHOLE, record))
                    held, continued = [], False
            yield _batch(out)
        if now:
            yield _batch(rest())

    return assemble


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["file", "block", "kind", "record"])


def records(spark: SparkSession, path: str, encoding: str = "UTF-16LE") -> DataFrame:
    """``record``: the text of every record below ``path``, line ends inside quoted values included.

    Quotes stand only around values, and are doubled inside, as ``export`` writes them. A file that
    ends inside a value gives that value's rest as one record. Blank lines are no records. The bytes of
    a line end inside two characters are refused, never misread.
    """
    if encoding.upper() not in UNITS:
        raise ValueError(f"only {' and '.join(UNITS)} are read in ranges")
    lines = _raw_lines(spark, path, encoding.upper())
    inside, open_ = _begin_inside(lines, encoding.upper())
    pieces = lines.mapInArrow(_assembled(inside, encoding.upper()), "file string, block long, kind int, record string")
    whole = pieces.filter(F.col("kind") == WHOLE).select("record")
    if not open_:
        return whole.filter(F.col("record") != "")
    # Pieces of one file are few: two a range at most.
    order = Window.partitionBy("file").orderBy("block", "kind")
    number = F.sum((F.col("kind") == OPENED).cast("int")).over(order)
    joined = (
        pieces.filter(F.col("kind") != WHOLE)
        .withColumn("number", number)
        .groupBy("file", "number")
        .agg(F.array_sort(F.collect_list(F.struct("block", "kind", "record"))).alias("parts"))
        .select(F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))
    )
    return whole.unionByName(joined).filter(F.col("record") != "")
