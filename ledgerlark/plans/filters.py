"""Filters, calendar attributes, paging, first rows and point lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions import calendar as cal
from ledgerlark.functions import text
from ledgerlark.operators.topk import page, rows_on_last_values, top_n, top_n_with_ties
from ledgerlark.plans.registry import plan
from ledgerlark.tables import Warehouse


@plan(
    "filter_like_or",
    """
    SELECT p_partkey, p_name FROM part
    WHERE p_name ILIKE '%RING%' OR p_name ILIKE 'RED%'
    """,
)
def filter_like_or(w: Warehouse) -> DataFrame:
    name = F.col("p_name")
    return w.part.filter(text.contains(name, "RING") | text.begins(name, "RED")).select("p_partkey", "p_name")


@plan(
    "suppliers_without_orders",
    """
    SELECT s_suppkey, s_name FROM supplier
    LEFT JOIN (SELECT DISTINCT l_suppkey FROM lineitem) ON l_suppkey = s_suppkey WHERE l_suppkey IS NULL
    """,
)
def suppliers_without_orders(w: Warehouse) -> DataFrame:
    keys = w.lineitem.select(F.col("l_suppkey").alias("s_suppkey")).distinct()
    return w.supplier.join(keys, "s_suppkey", "left_anti").select("s_suppkey", "s_name")


@plan(
    "customers_without_orders",
    """
    SELECT c_custkey, c_name FROM customer
    LEFT JOIN (SELECT DISTINCT o_custkey FROM orders) ON o_custkey = c_custkey WHERE o_custkey IS NULL
    """,
)
def customers_without_orders(w: Warehouse) -> DataFrame:
    keys = w.orders.select(F.col("o_custkey").alias("c_custkey")).distinct()
    return w.customer.join(keys, "c_custkey", "left_anti").select("c_custkey", "c_name")


@plan(
    "suppliers_idle_for_two_weeks",
    """
    SELECT s_suppkey, s_name FROM supplier
    LEFT JOIN (SELECT DISTINCT l_suppkey FROM lineitem
               WHERE l_shipdate >= DATE '1995-01-01' AND l_shipdate < DATE '1995-01-15') ON l_suppkey = s_suppkey
    WHERE l_suppkey IS NULL
    """,
)
def suppliers_idle_for_two_weeks(w: Warehouse) -> DataFrame:
    """Suppliers that shipped nothing in the first two weeks of 1995."""
    active = w.lineitem.filter(cal.days_from_until(F.col("l_shipdate"), "1995-01-01", "1995-01-15"))
    keys = active.select(F.col("l_suppkey").alias("s_suppkey")).distinct()
    return w.supplier.join(keys, "s_suppkey", "left_anti").select("s_suppkey", "s_name")


@plan(
    "suppliers_without_region_year",
    """
    SELECT s_suppkey, s_name, r_regionkey, year FROM supplier, region,
           (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)
    WHERE NOT EXISTS (SELECT 1 FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
                      JOIN nation ON n_nationkey = c_nationkey
                      WHERE l_suppkey = s_suppkey AND n_regionkey = r_regionkey AND year(o_orderdate) = year
                        AND o_orderpriority = '1-URGENT' AND l_quantity > 45)
    """,
)
def suppliers_without_region_year(w: Warehouse) -> DataFrame:
    """Regions and years in which a supplier sold nothing large that was urgent.

    The grid is expanded from a list of pairs (a region has one row, a year one of
    the calendar), and what was sold shrinks to keys before it meets the grid.
    """
    urgent = w.orders.filter(F.col("o_orderpriority") == "1-URGENT").withColumn("year", F.year("o_orderdate"))
    homes = w.customer.join(w.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_regionkey")
    sold = (
        w.lineitem.filter(F.col("l_quantity") > 45)
        .join(urgent, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(homes, F.col("o_custkey") == F.col("c_custkey"))
        .select(F.col("l_suppkey").alias("s_suppkey"), F.col("n_regionkey").alias("r_regionkey"), "year")
        .distinct()
    )
    years = w.orders.agg(F.collect_set(F.year("o_orderdate"))).scalar()
    regions = w.region.agg(F.collect_set("r_regionkey")).scalar()
    grid = (
        w.supplier.select("s_suppkey", "s_name")
        .withColumn("r_regionkey", F.explode(regions))
        .withColumn("year", F.explode(years))
    )
    return grid.join(sold, ["s_suppkey", "r_regionkey", "year"], "left_anti")


LINE_ID = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def order_lines_with_calendar(w: Warehouse) -> DataFrame:
    """Order lines that are expensive, or large and of a finished order, with
    calendar attributes of the order. One row per line."""
    day = F.to_date("o_orderdate")
    chosen = (F.col("p_retailprice") > 990) | ((F.col("l_quantity") > 40) & (F.col("o_orderstatus") == "F"))
    return (
        w.lineitem.join(w.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(w.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .filter(chosen)
        .join(w.customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey"),
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            cal.day_first(day).alias("order_day"),
            cal.month_name(day).alias("month_name"),
            cal.month_name_ru(day).alias("month_name_ru"),
            F.quarter(day).alias("quarter_number"),
            cal.quarter_text(day).alias("quarter_text"),
            cal.part_of_year(day, 3).alias("quarter_by_months"),
            cal.part_of_year(day, 4).alias("third_of_year"),
            cal.third_by_case(day).alias("third_by_case"),
            F.col("c_name").alias("customer_name"),
            day.alias("order_date"),
        )
    )


ATTRIBUTES_SQL = """
    SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey,
           strftime(o_orderdate, '%d.%m.%Y') AS order_day,
           monthname(o_orderdate) AS month_name,
           list_extract(['Январь','Февраль','Март','Апрель','Май','Июнь','Июль','Август','Сентябрь','Октябрь',
                         'Ноябрь','Декабрь'], month(o_orderdate)) AS month_name_ru,
           CAST(quarter(o_orderdate) AS INTEGER) AS quarter_number,
           CAST(quarter(o_orderdate) AS VARCHAR) AS quarter_text,
           CAST((month(o_orderdate) - 1) // 3 + 1 AS INTEGER) AS quarter_by_months,
           CAST((month(o_orderdate) - 1) // 4 + 1 AS INTEGER) AS third_of_year,
           CASE WHEN month(o_orderdate) BETWEEN 1 AND 4 THEN 1
                WHEN month(o_orderdate) BETWEEN 5 AND 8 THEN 2 ELSE 3 END AS third_by_case,
           c_name AS customer_name
    FROM orders
    JOIN lineitem ON l_orderkey = o_orderkey
    JOIN part ON p_partkey = l_partkey
    JOIN customer ON c_custkey = o_custkey
    WHERE p_retailprice > 990 OR (l_quantity > 40 AND o_orderstatus = 'F')
"""

REPORT_ORDER = ("quarter_number", "third_of_year", "order_date", "o_orderkey", *LINE_ID[1:])


@plan("orders_calendar_attrs", ATTRIBUTES_SQL)
def orders_calendar_attrs(w: Warehouse) -> DataFrame:
    return order_lines_with_calendar(w).orderBy(*REPORT_ORDER).drop("order_date")


@plan(
    "orders_page_11",
    ATTRIBUTES_SQL
    + """
    ORDER BY quarter_number, third_of_year, o_orderdate, o_orderkey, l_linenumber, l_partkey, l_suppkey
    LIMIT 100 OFFSET 1000
    """,
)
def orders_page_11(w: Warehouse) -> DataFrame:
    return page(order_lines_with_calendar(w), 11, 100, *REPORT_ORDER).drop("order_date")


@plan(
    "orders_page_by_position",
    ATTRIBUTES_SQL
    + """
    ORDER BY quarter_number, third_of_year, o_orderdate, o_orderkey, l_linenumber, l_partkey, l_suppkey
    LIMIT 100 OFFSET 5000
    """,
)
def orders_page_by_position(w: Warehouse) -> DataFrame:
    """Page 51."""
    return page(order_lines_with_calendar(w), 51, 100, *REPORT_ORDER).drop("order_date")


@plan(
    "items_by_name_any_case",
    """
    SELECT lower(name) AS name, count(*) AS items, count(DISTINCT name) AS spellings
    FROM (SELECT CASE WHEN p_type = 'PROMO' THEN upper(p_name) ELSE p_name END AS name FROM part) GROUP BY lower(name)
    """,
)
def items_by_name_any_case(w: Warehouse) -> DataFrame:
    """Items by name without regard to letter case."""
    spelled = F.when(F.col("p_type") == "PROMO", F.upper("p_name")).otherwise(F.col("p_name"))
    grouped = (
        w.part.select(spelled.alias("spelling"))
        .groupBy(text.any_case(F.col("spelling")).alias("key"), "spelling")
        .agg(F.count("*").alias("items"))
        .groupBy("key")
        .agg(
            F.min(F.lower("spelling")).alias("name"),
            F.sum("items").alias("items"),
            F.count("*").alias("spellings"),
        )
    )
    return grouped.drop("key")


@plan(
    "filter_between_or_eq",
    """
    SELECT o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS order_day, c_name, n_name
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-01-31'
      AND o_orderstatus = 'F' AND (o_orderpriority = '1-URGENT' OR o_orderpriority = '2-HIGH')
    """,
)
def filter_between_or_eq(w: Warehouse) -> DataFrame:
    priority = F.col("o_orderpriority")
    return (
        w.orders.filter(cal.days_from_to(F.col("o_orderdate"), "1998-01-01", "1998-01-31"))
        .filter((F.col("o_orderstatus") == "F") & ((priority == "1-URGENT") | (priority == "2-HIGH")))
        .join(w.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(w.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderpriority", cal.iso(F.col("o_orderdate")).alias("order_day"), "c_name", "n_name")
    )


def sales_list(orders: DataFrame, w: Warehouse) -> DataFrame:
    """Orders with customer name and day; the join comes after the cut."""
    return orders.join(w.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", cal.iso(F.col("o_orderdate")).alias("order_day"), F.col("c_name").alias("customer_name")
    )


SALES_SQL = """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day, c_name AS customer_name
    FROM orders JOIN customer ON c_custkey = o_custkey
"""


@plan("last10_orders", SALES_SQL + " ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10")
def last10_orders(w: Warehouse) -> DataFrame:
    return sales_list(top_n(w.orders, 10, F.desc("o_orderdate"), F.desc("o_orderkey")), w)


@plan(
    "last10_orders_with_ties",
    SALES_SQL + " WHERE o_orderdate >= (SELECT o_orderdate FROM orders ORDER BY o_orderdate DESC LIMIT 1 OFFSET 9)",
)
def last10_orders_with_ties(w: Warehouse) -> DataFrame:
    return sales_list(top_n_with_ties(w.orders, 10, "o_orderdate", nullable=False), w)


@plan(
    "last10_picked_with_ties",
    """
    SELECT o_orderkey, order_day, priority, customer_name FROM (
        SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day, o_orderpriority AS priority,
               c_name AS customer_name,
               rank() OVER (ORDER BY o_orderdate DESC, o_orderpriority DESC NULLS LAST) AS place
        FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'F')
    WHERE place <= 10
    """,
)
def last10_picked_with_ties(w: Warehouse) -> DataFrame:
    """Ties on two keys."""
    picked = top_n_with_ties(w.orders.filter(F.col("o_orderstatus") == "F"), 10, "o_orderdate", "o_orderpriority")
    return picked.join(w.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        cal.iso(F.col("o_orderdate")).alias("order_day"),
        F.col("o_orderpriority").alias("priority"),
        F.col("c_name").alias("customer_name"),
    )


@plan(
    "last10_picked",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day, o_orderpriority AS priority,
           c_name AS customer_name
    FROM orders JOIN customer ON c_custkey = o_custkey
    WHERE o_orderstatus = 'F'
    ORDER BY o_orderdate DESC, o_orderpriority DESC, o_orderkey DESC LIMIT 10
    """,
)
def last10_picked(w: Warehouse) -> DataFrame:
    picked = w.orders.filter(F.col("o_orderstatus") == "F")
    last = top_n(picked, 10, F.desc("o_orderdate"), F.desc("o_orderpriority"), F.desc("o_orderkey"))
    return last.join(w.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        cal.iso(F.col("o_orderdate")).alias("order_day"),
        F.col("o_orderpriority").alias("priority"),
        F.col("c_name").alias("customer_name"),
    )


@plan(
    "orders_on_last10_dates",
    SALES_SQL + " WHERE o_orderdate IN (SELECT DISTINCT o_orderdate FROM orders ORDER BY o_orderdate DESC LIMIT 10)",
)
def orders_on_last10_dates(w: Warehouse) -> DataFrame:
    return sales_list(rows_on_last_values(w.orders, "o_orderdate", 10), w)


@plan(
    "buyers_of_item",
    """
    SELECT DISTINCT c_custkey, c_name, c_mktsegment
    FROM part JOIN lineitem ON l_partkey = p_partkey JOIN orders ON o_orderkey = l_orderkey
    JOIN customer ON c_custkey = o_custkey
    WHERE lower(p_name) = 'red widget'
    """,
)
def buyers_of_item(w: Warehouse) -> DataFrame:
    """Customers who bought an item of that name, in any letter case.

    Semi-joins ask for existence only, so no row is multiplied on the way.
    """
    wanted = w.part.filter(text.any_case(F.col("p_name")) == "Red Widget")
    lines = w.lineitem.join(wanted, F.col("l_partkey") == F.col("p_partkey"), "left_semi")
    bought = w.orders.join(
        lines.select(F.col("l_orderkey").alias("o_orderkey")).distinct(), "o_orderkey", "left_semi"
    )
    buyers = bought.select(F.col("o_custkey").alias("c_custkey")).distinct()
    return w.customer.join(buyers, "c_custkey", "left_semi").select("c_custkey", "c_name", "c_mktsegment")


@plan(
    "point_lookup",
    """
    SELECT 'item by key' AS lookup, p_partkey AS item, p_name AS found FROM part WHERE p_partkey = 7
    UNION ALL
    SELECT 'line by item and supplier', l_partkey, CAST(l_orderkey AS VARCHAR) FROM lineitem
    WHERE l_partkey = 10 AND l_suppkey = (SELECT min(l_suppkey) FROM lineitem WHERE l_partkey = 10)
    """,
)
def point_lookup(w: Warehouse) -> DataFrame:
    by_key = w.part.filter(F.col("p_partkey") == 7).select(
        F.lit("item by key").alias("lookup"), F.col("p_partkey").alias("item"), F.col("p_name").alias("found")
    )
    of_item = w.lineitem.filter(F.col("l_partkey") == 10)
    by_pair = of_item.filter(F.col("l_suppkey") == of_item.agg(F.min("l_suppkey")).scalar()).select(
        F.lit("line by item and supplier").alias("lookup"),
        F.col("l_partkey").alias("item"),
        F.col("l_orderkey").cast("string").alias("found"),
    )
    return by_key.unionByName(by_pair)


@plan(
    "existence_probe",
    """
    SELECT probe, EXISTS (SELECT 1 FROM part WHERE lower(p_name) = probe) AS found
    FROM (VALUES ('red widget'), ('no such item')) t(probe)
    """,
)
def existence_probe(w: Warehouse) -> DataFrame:
    """Asks for one matching row at most."""

    def probe(name: str) -> Column:
        hit = w.part.filter(text.any_case(F.col("p_name")) == name).limit(1)
        return F.struct(F.lit(name).alias("probe"), (hit.agg(F.count("*")).scalar() > 0).alias("found"))

    names = ["red widget", "no such item"]
    return w.spark.range(1).select(F.inline(F.array(*[probe(name) for name in names])))


@plan(
    "count_filtered",
    """
    SELECT count(*) AS lines, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS returned_lines,
           count(DISTINCT l_suppkey) AS suppliers
    FROM lineitem WHERE l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '1997-01-01' AND l_quantity = 30
    """,
)
def count_filtered(w: Warehouse) -> DataFrame:
    """Counts over a half-open range of days; the filter sees stored values."""
    lines = w.lineitem.filter(
        cal.days_from_until(F.col("l_shipdate"), "1996-01-01", "1997-01-01") & (F.col("l_quantity") == 30)
    )
    return lines.agg(
        F.count("*").alias("lines"),
        F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("returned_lines"),
        F.countDistinct("l_suppkey").alias("suppliers"),
    )


@plan(
    "outer_join_demoted",
    """
    SELECT p_partkey, p_name, l_orderkey, CAST(l_quantity AS DOUBLE) AS quantity
    FROM part LEFT JOIN lineitem ON l_partkey = p_partkey WHERE l_returnflag = 'R' AND l_quantity > 45
    """,
)
def outer_join_demoted(w: Warehouse) -> DataFrame:
    """A filter on the optional side makes the outer join an inner join."""
    return (
        w.part.join(w.lineitem, F.col("p_partkey") == F.col("l_partkey"), "left")
        .filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45))
        .select("p_partkey", "p_name", "l_orderkey", F.col("l_quantity").alias("quantity"))
    )


@plan(
    "orders_by_text_date",
    """
    SELECT o_orderkey, strftime(strptime(strftime(o_orderdate, '%d.%m.%Y'), '%d.%m.%Y'), '%Y-%m-%d') AS order_day
    FROM orders
    """,
)
def orders_by_text_date(w: Warehouse) -> DataFrame:
    """Days that arrive as text, day first, read as dates."""
    arriving = w.orders.select("o_orderkey", cal.day_first(F.to_date("o_orderdate")).alias("day_text"))
    return arriving.select("o_orderkey", cal.iso(cal.parse_day_first(F.col("day_text"))).alias("order_day"))
