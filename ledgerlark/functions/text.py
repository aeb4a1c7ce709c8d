"""Text predicates and small text functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as blank when a split part is trimmed.
BLANKS = (
    "\t\n\v\f\r \u0085  "
    "           "
    "    　"
)


def contains(column: Column, part: str) -> Column:
    """Any letter case; every character of ``part`` stands for itself."""
    return F.lower(column).contains(F.lower(F.lit(part)))


def begins(column: Column, part: str) -> Column:
    """Any letter case; every character of ``part`` stands for itself."""
    return F.lower(column).startswith(F.lower(F.lit(part)))


def any_case(column: Column) -> Column:
    """For ``==``, grouping and partitioning without regard to letter case."""
    return F.collate(column, "UTF8_LCASE")


def any_case_padded(column: Column) -> Column:
    """As ``any_case``, and trailing blanks do not count either."""
    return F.collate(column, "UTF8_LCASE_RTRIM")


def first_letter(column: Column) -> Column:
    return F.left(column, F.lit(1))


def strip_chars(column: Column, chars: str) -> Column:
    """Remove leading and trailing characters out of the set ``chars``."""
    return F.btrim(column, F.lit(chars))


def length_unpadded(column: Column) -> Column:
    """Length without trailing blanks."""
    return F.length(F.rtrim(column))


def replace_at(column: Column, start: int, count: int, new: str) -> Column:
    """Put ``new`` in place of ``count`` characters from position ``start``."""
    return F.overlay(column, F.lit(new), F.lit(start), F.lit(count))


def parts(column: Column, delimiters: str) -> Column:
    """Split at any one of the ``delimiters``; empty parts are dropped before
    the others are trimmed, so a part of blanks only stays as ''. Without
    delimiters it is split at white space."""
    pieces = F.split(column, "[" + re.escape(delimiters or BLANKS) + "]", -1)
    kept = F.filter(pieces, lambda piece: piece != "")
    return F.transform(kept, lambda piece: F.btrim(piece, F.lit(BLANKS)))


def quoted(name: str) -> str:
    """A column name quoted for SQL text."""
    return "`" + name.replace("`", "``") + "`"
