"""Sales by month: totals, thresholds, zero-filled calendars, low sellers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions import calendar as cal
from ledgerlark.functions.money import hundredths, mean, number, total, units
from ledgerlark.operators.months import item_months, month_calendar, zero_filled
from ledgerlark.plans.registry import plan
from ledgerlark.session import stage
from ledgerlark.tables import Warehouse


def order_totals(w: Warehouse) -> DataFrame:
    """Lines summed (in hundredths) per order, before they meet the order's date: an order
    with very many lines is one row per task when it is shuffled."""
    return w.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        total("l_extendedprice").alias("amount"), F.count("*").alias("lines")
    )


def by_month(w: Warehouse) -> DataFrame:
    day = F.to_date("o_orderdate")
    return (
        w.orders.select("o_orderkey", "o_orderdate")
        .join(order_totals(w), "o_orderkey")
        .groupBy(F.year(day).alias("year"), F.month(day).alias("month"))
        .agg(F.sum("amount").alias("amount"), F.sum("lines").alias("lines"))
        .select(
            "year",
            "month",
            mean(F.col("amount"), F.col("lines")).alias("average_amount"),
            units("amount").alias("total_amount"),
        )
    )


BY_MONTH_SQL = """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS average_amount,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    GROUP BY ALL
"""

CALENDAR_SQL = """
    (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(m AS INTEGER) AS month
     FROM orders, range(1, 13) t(m))
"""


@plan("sales_by_month", BY_MONTH_SQL)
def sales_by_month(w: Warehouse) -> DataFrame:
    return by_month(w).orderBy("year", "month")


@plan(
    "months_over_threshold",
    """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
           CAST(sum(CAST(l_quantity AS DECIMAL(12,2)) * CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
    GROUP BY ALL
    HAVING sum(CAST(l_quantity AS DECIMAL(12,2)) * CAST(p_retailprice AS DECIMAL(18,2))) > 17500000
    """,
)
def months_over_threshold(w: Warehouse) -> DataFrame:
    """Months whose quantity times list price exceeds a sum."""
    day = F.to_date("o_orderdate")
    per_order = (
        w.lineitem.join(w.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum(hundredths("l_quantity").cast("decimal(19,0)") * hundredths("p_retailprice")).alias("amount"))
    )
    return (
        w.orders.select("o_orderkey", "o_orderdate")
        .join(per_order, "o_orderkey")
        .groupBy(F.year(day).alias("year"), F.month(day).alias("month"))
        .agg(F.sum("amount").alias("amount"))
        .filter(F.col("amount") > 17_500_000 * 100 * 100)
        .select("year", "month", (number("amount") / 10_000).alias("total_amount"))
        .orderBy("year", "month")
    )


@plan(
    "calendar_zero_fill",
    f"""
    SELECT c.year, c.month, coalesce(s.average_amount, 0) AS average_amount, coalesce(s.total_amount, 0) AS total_amount
    FROM {CALENDAR_SQL} c LEFT JOIN ({BY_MONTH_SQL}) s ON s.year = c.year AND s.month = c.month
    """,
)
def calendar_zero_fill(w: Warehouse) -> DataFrame:
    filled = zero_filled(
        month_calendar(w.orders, "o_orderdate"),
        by_month(w),
        ["year", "month"],
        {"average_amount": 0.0, "total_amount": 0.0},
    )
    return filled.orderBy("year", "month")


def by_month_and_item(w: Warehouse) -> DataFrame:
    """Amount, first day and quantity per month and item; sums in hundredths."""
    return (
        w.lineitem.join(w.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.year("o_orderdate").alias("year"),
            F.month("o_orderdate").alias("month"),
            F.col("l_partkey").alias("p_partkey"),
            "l_extendedprice",
            "l_quantity",
            "o_orderdate",
        )
        .groupBy("year", "month", "p_partkey")
        .agg(
            total("l_extendedprice").alias("amount"),
            F.min("o_orderdate").alias("first_day"),
            total("l_quantity").alias("quantity"),
        )
    )


LOW_SELLER = 50

MONTH_ITEM_SQL = """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
           l_partkey AS p_partkey,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount,
           strftime(min(o_orderdate), '%Y-%m-%d') AS first_day,
           CAST(sum(l_quantity) AS DOUBLE) AS quantity
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    GROUP BY ALL
"""


def _shown(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "amount": units("amount"),
            "first_day": cal.iso(F.col("first_day")),
            "quantity": units("quantity"),
        }
    )


@plan(
    "monthly_item_low_sellers",
    f"""
    SELECT s.year, s.month, p_partkey, p_name, s.amount, s.first_day, s.quantity
    FROM ({MONTH_ITEM_SQL}) s JOIN part USING (p_partkey) WHERE s.quantity < {LOW_SELLER}
    """,
)
def monthly_item_low_sellers(w: Warehouse) -> DataFrame:
    low = by_month_and_item(w).filter(units("quantity") < LOW_SELLER)
    named = low.join(w.part.select("p_partkey", "p_name"), "p_partkey")
    return _shown(named.select("year", "month", "p_partkey", "p_name", "amount", "first_day", "quantity"))


@plan(
    "calendar_zero_fill_items",
    f"""
    SELECT c.year, c.month, coalesce(p_name, '-') AS p_name, s.p_partkey, coalesce(s.amount, 0) AS amount,
           s.first_day, coalesce(s.quantity, 0) AS quantity
    FROM {CALENDAR_SQL} c
    LEFT JOIN ({MONTH_ITEM_SQL}) s ON s.year = c.year AND s.month = c.month
    LEFT JOIN part p ON p.p_partkey = s.p_partkey
    WHERE coalesce(s.quantity, 0) < {LOW_SELLER}
    """,
)
def calendar_zero_fill_items(w: Warehouse) -> DataFrame:
    """Low sellers, and a '-' row for a month without any sale.

    A month without low sellers but with sales has no row, so the calendar is
    filled from all sold months; the facts need not be joined to it.
    """
    sold = stage(by_month_and_item(w), "sold")
    low = sold.filter(units("quantity") < LOW_SELLER).join(w.part.select("p_partkey", "p_name"), "p_partkey", "left")
    months = sold.select("year", "month").distinct()
    idle = month_calendar(w.orders, "o_orderdate").join(months, ["year", "month"], "left_anti")
    return _shown(
        low.withColumn("p_name", F.coalesce("p_name", F.lit("-")))
        .select("year", "month", "p_name", "p_partkey", "amount", "first_day", "quantity")
        .unionByName(idle.withColumn("p_name", F.lit("-")), allowMissingColumns=True)
        .withColumns(
            {
                "amount": F.coalesce("amount", F.lit(0)),
                "quantity": F.coalesce("quantity", F.lit(0)),
            }
        )
    )


@plan(
    "calendar_item_zero_fill",
    f"""
    SELECT c.year, c.month, p.p_partkey, p_name, coalesce(s.amount, 0) AS amount, s.first_day,
           coalesce(s.quantity, 0) AS quantity
    FROM {CALENDAR_SQL} c CROSS JOIN part p
    LEFT JOIN ({MONTH_ITEM_SQL}) s ON s.year = c.year AND s.month = c.month AND s.p_partkey = p.p_partkey
    WHERE coalesce(s.quantity, 0) < {LOW_SELLER}
    """,
)
def calendar_item_zero_fill(w: Warehouse) -> DataFrame:
    """Every item in every month, where it sold little or nothing."""
    items = w.part.select("p_partkey", "p_name")
    measures = ["amount", "first_day", "quantity"]
    every = item_months(items, by_month_and_item(w), "p_partkey", w.orders, "o_orderdate", measures)
    filled = every.withColumns({name: F.coalesce(name, F.lit(0)) for name in ("amount", "quantity")})
    low = filled.filter(units("quantity") < LOW_SELLER)
    return _shown(low.select("year", "month", "p_partkey", "p_name", "amount", "first_day", "quantity"))
