"""Month calendars, zero-filled reports and running totals by month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.functions.money import total


def month_calendar(days: DataFrame, day: str, year: str = "year", month: str = "month") -> DataFrame:
    """Twelve months for every year that occurs in ``days``."""
    years = days.select(F.year(day).alias(year)).filter(F.col(year).isNotNull()).distinct()
    return years.select(year, F.explode(F.sequence(F.lit(1), F.lit(12))).alias(month))


def item_months(
    items: DataFrame, facts: DataFrame, item: str, days: DataFrame, day: str, measures: list[str]
) -> DataFrame:
    """Every item in every month of every year that occurs in ``days``, with the
    measures of that month, or NULLs.

    ``facts`` has year, month, the item and the measures. The months of an item
    are one map, as long as the calendar at most; items meet them once and are
    expanded after, so nothing that is shuffled holds an empty month.
    """
    years = days.select(F.year(day).alias("y")).filter(F.col("y").isNotNull())
    year_list = years.agg(F.collect_set("y")).scalar()
    entry = F.struct((F.col("year") * 100 + F.col("month")).alias("key"), F.struct(*measures).alias("value"))
    dated = facts.filter(F.col("year").isNotNull())
    sold = dated.groupBy(item).agg(F.map_from_entries(F.collect_list(entry)).alias("__sold"))
    wide = items.join(sold, item, "left")
    every = wide.withColumn("year", F.explode(year_list)).withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
    found = F.try_element_at("__sold", F.col("year") * 100 + F.col("month"))
    return every.select(*items.columns, "year", "month", found.alias("__found")).select(
        *items.columns, "year", "month", *[F.col(f"__found.{m}").alias(m) for m in measures]
    )


def zero_filled(grid: DataFrame, facts: DataFrame, keys: list[str], defaults: dict[str, object]) -> DataFrame:
    """All grid rows, with a default where a fact is missing."""
    joined = grid.join(facts, keys, "left")
    for name, value in defaults.items():
        joined = joined.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    return joined


def running_month_totals(df: DataFrame, month: Column, amount: str, month_name: str = "month_number") -> DataFrame:
    """One row per month with the total of that and all earlier months, both in
    hundredths.

    The window runs over month totals only; the calendar bounds their number
    (twelve for every year of data), whatever the size of ``df``.
    """
    totals = df.groupBy(month.alias(month_name)).agg(total(amount).alias("month_total"))
    upto = Window.orderBy(month_name).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return totals.withColumn("running_total", F.sum(F.col("month_total").cast("decimal(20,0)")).over(upto))
