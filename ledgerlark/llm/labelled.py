"""Bounded samples of labelled rows, and the folds that ids fall into."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold_of(doc_id: Column, folds: int) -> Column:
    """CRC-32 of the id as text, modulo ``folds``; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(-1))


CELLS = 1 << 20


def sample(rows: DataFrame, most: int, *by: Column) -> DataFrame:
    """At most about ``most`` distinct rows, chosen by a hash of ``by``; all, if there are fewer rows.

    Rows that are equal in ``by`` are one, so a row with any number of copies counts once; give
    columns that tell rows with one id apart. Run again, it gives the same rows. The draw is a
    filter before rows meet, so what meets is the sample, whatever key is hot.
    """
    count = rows.count()
    picked = rows.withColumn("__key", F.xxhash64(*by, F.lit("sample")))
    if count > most:
        picked = picked.filter(F.pmod("__key", F.lit(CELLS)) < most * CELLS // count)
    return picked.dropDuplicates(["__key"]).drop("__key")
