"""Calendar attributes and day ranges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Russian month names, January first.
MONTHS_RU = (
    "Январь", "Февраль", "Март", "Апрель", "Май", "Июнь",
    "Июль", "Август", "Сентябрь", "Октябрь", "Ноябрь", "Декабрь",
)


def _day(value: str | dt.date) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def _midnight(value: dt.date) -> Column:
    return F.lit(dt.datetime.combine(value, dt.time())).cast("timestamp_ntz")


def days_from_to(column: Column, first: str | dt.date, last: str | dt.date) -> Column:
    """Both days included. Compares the stored value itself with two constants,
    which the parquet scan can use; a date function around it could not."""
    after = _day(last) + dt.timedelta(days=1)
    return (column >= _midnight(_day(first))) & (column < _midnight(after))


def days_from_until(column: Column, first: str | dt.date, end: str | dt.date) -> Column:
    """``first`` included, ``end`` excluded."""
    return (column >= _midnight(_day(first))) & (column < _midnight(_day(end)))


def days_since(column: Column, first: str | dt.date) -> Column:
    return column >= _midnight(_day(first))


def micros(time: Column) -> Column:
    """Microseconds since 1970 of a time without zone, whatever the zone of the session."""
    day = F.unix_date(time.cast("date")).cast("bigint")
    second = (F.extract(F.lit("SECOND"), time) * 1_000_000).cast("bigint")
    return ((day * 24 + F.hour(time)) * 60 + F.minute(time)) * 60_000_000 + second


def iso(day: Column) -> Column:
    """A day as text for reports."""
    return F.date_format(day, "yyyy-MM-dd")


def day_first(day: Column) -> Column:
    return F.date_format(day, "dd.MM.yyyy")


def parse_day_first(text: Column) -> Column:
    """NULL for text that is not a day."""
    return F.try_to_timestamp(text, F.lit("dd.MM.yyyy")).cast("date")


def month_name(day: Column) -> Column:
    return F.date_format(day, "MMMM")


def month_name_ru(day: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in MONTHS_RU]), F.month(day))


def month_number(day: Column) -> Column:
    """201504 for April 2015."""
    return F.lit(100) * F.year(day) + F.month(day)


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def quarter_text(day: Column) -> Column:
    return F.quarter(day).cast("string")


def part_of_year(day: Column, months: int) -> Column:
    """Number of the ``months``-long part of the year, from 1."""
    return F.floor((F.month(day) - 1) / months).cast("int") + 1


def third_by_case(day: Column) -> Column:
    month = F.month(day)
    return F.when(month <= 4, 1).when(month <= 8, 2).otherwise(3)


def day_gap(earlier: Column, later: Column) -> Column:
    """Day boundaries crossed from ``earlier`` to ``later``."""
    return F.datediff(later, earlier)
