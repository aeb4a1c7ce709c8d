"""Delimited text: export, load with a declared schema, quarantine and reconciliation."""

from __future__ import annotations

import re
from functools import reduce
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.session import stage
from ledgerlark.sources.ranges import records

NULL_MARK = "\\N"
BAD_LINE = "bad_line"

# A quoted value may hold a line end, so one task reads one file from its start
# unless the caller lets it be cut; exports are therefore cut into files of
# bounded length.
ROWS_PER_FILE = 1_000_000


def _texts(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema.fields if isinstance(field.dataType, T.StringType)]


def _marked(df: DataFrame) -> DataFrame:
    """Text that reads like the mark for NULL gets one more backslash."""
    return df.withColumns({name: F.regexp_replace(name, r"^(\\+N)$", r"\\$1") for name in _texts(df)})


def _unmarked(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.regexp_replace(name, r"^\\(\\+N)$", "$1") for name in _texts(df)})


def export(df: DataFrame, path: str, separator: str = "|", encoding: str = "UTF-16LE") -> None:
    """Write without a header. A value that holds the separator is quoted, and
    NULL and the empty string stay apart."""
    (
        _marked(df)
        .write.option("sep", separator)
        .option("encoding", encoding)
        .option("lineSep", "\n")
        .option("nullValue", NULL_MARK)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .csv(path)
    )


def _rows(
    spark: SparkSession, path: str, schema: T.StructType, separator: str, encoding: str, cut_files: bool, **mode: str
) -> DataFrame:
    options = {
        "sep": separator,
        "lineSep": "\n",
        "nullValue": NULL_MARK,
        "quote": '"',
        "escape": '"',
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        **mode,
    }
    if cut_files and encoding.upper().startswith(("UTF-16", "UTF-32", "UTF16", "UTF32")):
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parsed = F.from_csv("record", ddl, {**options, "multiLine": "true"})
        return records(spark, path, encoding).select(parsed.alias("row")).select("row.*")
    reader = spark.read.schema(schema).option("encoding", encoding).option("multiLine", not cut_files)
    return reader.options(**options).csv(path)


def load(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    separator: str = "|",
    encoding: str = "UTF-16LE",
    cut_files: bool = False,
) -> DataFrame:
    """Load strictly: the first line that does not fit stops the job.

    ``cut_files`` lets many tasks share a large file. One of narrow characters is read
    line by line then, so no value may hold a line end; one of wide characters is read in
    byte ranges, where values may hold line ends.
    """
    return _unmarked(_rows(spark, path, schema, separator, encoding, cut_files, mode="FAILFAST"))


def load_with_quarantine(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    separator: str = "|",
    encoding: str = "UTF-16LE",
    cut_files: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(good rows, lines that do not fit the schema).

    The text is parsed once; both results read the stored outcome.
    """
    wide = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])
    permissive = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE}
    rows = stage(_rows(spark, path, wide, separator, encoding, cut_files, **permissive), "parsed-text")
    good = _unmarked(rows.filter(F.col(BAD_LINE).isNull()).drop(BAD_LINE))
    bad = rows.filter(F.col(BAD_LINE).isNotNull()).select(BAD_LINE)
    return good, bad


class LoadError(NamedTuple):
    code: str
    message: str


def try_load(
    spark: SparkSession, path: str, schema: T.StructType, target: str, **options
) -> tuple[DataFrame | None, LoadError | None]:
    """Load strictly into the new table folder ``target``.

    (rows, None), or (None, error) when the file is missing or a line does not
    fit; nothing is left in ``target`` to read then.
    """
    try:
        load(spark, path, schema, **options).write.parquet(target)
        return spark.read.schema(schema).parquet(target), None
    except (PySparkException, Py4JJavaError) as error:
        return None, _described(error)


def _described(error: Exception) -> LoadError:
    """Spark puts the error's name in brackets before its text."""
    found = re.search(r"\[([A-Z][A-Z0-9_.]+)\]\s*(.*)", str(error))
    if found:
        return LoadError(*found.groups())
    return LoadError(type(error).__name__, str(error))


def reconcile(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Row counts of source and loaded table, and their difference."""
    rows = [
        source.agg(F.count("*").alias("source_rows"))
        .withColumn("loaded_rows", loaded.agg(F.count("*")).scalar())
        .select(
            F.lit(name).alias("table_name"),
            "source_rows",
            "loaded_rows",
            (F.col("source_rows") - F.col("loaded_rows")).alias("difference"),
        )
        for name, (source, loaded) in pairs.items()
    ]
    return reduce(DataFrame.unionByName, rows)
