"""Anti- and semi-joins, scalar and quantified comparisons, correlated lookups, fan-out reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions import calendar as cal
from ledgerlark.functions.money import hundredths, number, total, units, wide
from ledgerlark.operators.lookups import equal_to_least, not_above_any, with_match_count
from ledgerlark.operators.topk import top_n, top_n_with_ties
from ledgerlark.plans.registry import plan
from ledgerlark.session import stage
from ledgerlark.tables import Warehouse


@plan(
    "salespeople_no_sale_on_day",
    """
    SELECT s_suppkey, s_name FROM supplier
    WHERE s_acctbal > 0 AND NOT EXISTS (
        SELECT 1 FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        WHERE l_suppkey = s_suppkey AND o_orderdate = TIMESTAMP '1997-07-04 00:00:00')
    """,
)
def salespeople_no_sale_on_day(w: Warehouse) -> DataFrame:
    on_day = w.orders.filter(cal.days_from_to(F.col("o_orderdate"), "1997-07-04", "1997-07-04"))
    lines = w.lineitem.join(on_day, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    sellers = lines.select(F.col("l_suppkey").alias("s_suppkey")).distinct()
    return w.supplier.filter(F.col("s_acctbal") > 0).join(sellers, "s_suppkey", "left_anti").select("s_suppkey", "s_name")


PRICE_SQL = "SELECT p_partkey, p_name, CAST(p_retailprice AS DOUBLE) AS price FROM part WHERE p_retailprice "


def _priced(items: DataFrame) -> DataFrame:
    return items.select("p_partkey", "p_name", F.col("p_retailprice").alias("price"))


@plan("min_price_items", PRICE_SQL + "= (SELECT min(p_retailprice) FROM part)")
def min_price_items(w: Warehouse) -> DataFrame:
    return _priced(equal_to_least(w.part, "p_retailprice"))


@plan("min_price_items_all", PRICE_SQL + "<= ALL (SELECT p_retailprice FROM part)")
def min_price_items_all(w: Warehouse) -> DataFrame:
    return _priced(not_above_any(w.part, "p_retailprice", w.part, "p_retailprice"))


@plan(
    "in_top5_payments",
    """
    SELECT c_custkey, c_name FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5)
    """,
)
def in_top5_payments(w: Warehouse) -> DataFrame:
    """Each customer once, even with two of the payments."""
    best = top_n(w.orders, 5, F.desc("o_totalprice"), F.asc("o_orderkey"))
    return w.customer.join(best, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@plan(
    "top5_payments",
    """
    SELECT c_custkey, c_name, CAST(o_totalprice AS DOUBLE) AS amount FROM customer
    JOIN (SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5) ON o_custkey = c_custkey
    """,
)
def top5_payments(w: Warehouse) -> DataFrame:
    """One row per payment."""
    best = top_n(w.orders, 5, F.desc("o_totalprice"), F.asc("o_orderkey"))
    paid = w.customer.join(best, F.col("c_custkey") == F.col("o_custkey"))
    return paid.select("c_custkey", "c_name", F.col("o_totalprice").alias("amount")).orderBy(F.desc("amount"))


@plan(
    "top5_customers_total",
    """
    SELECT c_custkey, c_name, total FROM customer JOIN (
        SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
        FROM orders GROUP BY o_custkey ORDER BY total DESC, o_custkey LIMIT 5) ON o_custkey = c_custkey
    """,
)
def top5_customers_total(w: Warehouse) -> DataFrame:
    totals = w.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(total("o_totalprice").alias("total"))
    best = top_n(totals, 5, F.desc("total"), F.asc("c_custkey"))
    return (
        w.customer.join(best, "c_custkey")
        .select("c_custkey", "c_name", units("total").alias("total"))
        .orderBy(F.desc("total"))
    )


@plan(
    "top3_price_ties",
    PRICE_SQL + ">= (SELECT p_retailprice FROM part ORDER BY p_retailprice DESC LIMIT 1 OFFSET 2)",
)
def top3_price_ties(w: Warehouse) -> DataFrame:
    return _priced(top_n_with_ties(w.part, 3, "p_retailprice", nullable=False))


@plan(
    "star_join_cities",
    """
    SELECT DISTINCT n_nationkey, n_name, s_name
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey JOIN supplier ON s_suppkey = l_suppkey
    WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_retailprice >=
                        (SELECT p_retailprice FROM part ORDER BY p_retailprice DESC LIMIT 1 OFFSET 2))
    """,
)
def star_join_cities(w: Warehouse) -> DataFrame:
    """Where the dearest items went and who sold them. Rows are made distinct
    after every step that drops a key, so later joins see few of them."""
    dear = top_n_with_ties(w.part, 3, "p_retailprice", nullable=False).select(F.col("p_partkey").alias("l_partkey"))
    lines = w.lineitem.join(dear, "l_partkey", "left_semi").select("l_orderkey", "l_suppkey").distinct()
    pairs = (
        lines.join(w.orders, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "l_suppkey").distinct()
    )
    places = (
        pairs.join(w.customer, F.col("o_custkey") == F.col("c_custkey"))
        .select("c_nationkey", "l_suppkey")
        .distinct()
    )
    return (
        places.join(w.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(w.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select("n_nationkey", "n_name", "s_name")
        .distinct()
    )


BIG_ORDER = 500_000

PICKED_SQL = f"""
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day, c_name AS customer_name,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)))
                FILTER (l_linestatus = 'F' AND o_orderstatus = 'F') AS DOUBLE) AS picked_amount
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey
    GROUP BY o_orderkey, o_orderdate, c_name
    HAVING sum(CAST(l_extendedprice AS DECIMAL(18,2))) > {BIG_ORDER}
"""


@plan("invoice_totals_over", PICKED_SQL)
def invoice_totals_over(w: Warehouse) -> DataFrame:
    """Orders above a total, and what was picked of the finished ones. Both
    sums come from one pass over the lines."""
    picked = F.when(F.col("l_linestatus") == "F", hundredths("l_extendedprice"))
    totals = (
        w.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(total("l_extendedprice").alias("total"), F.sum(picked).alias("picked"))
        .filter(units("total") > BIG_ORDER)
    )
    return (
        w.orders.join(totals, "o_orderkey")
        .join(w.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .select(
            "o_orderkey",
            cal.iso(F.col("o_orderdate")).alias("order_day"),
            F.col("c_name").alias("customer_name"),
            units("total").alias("total_amount"),
            F.when(F.col("o_orderstatus") == "F", units("picked")).alias("picked_amount"),
        )
        .orderBy(F.desc("total_amount"))
    )


@plan("invoice_picked_totals_correlated", PICKED_SQL)
def invoice_picked_totals_correlated(w: Warehouse) -> DataFrame:
    """The same report with correlated subqueries, which Catalyst turns into
    grouped left joins."""
    return w.spark.sql(
        """
        SELECT o_orderkey, date_format(o_orderdate, 'yyyy-MM-dd') AS order_day,
               (SELECT max(c_name) FROM {customer} WHERE c_custkey = o.o_custkey) AS customer_name,
               CAST(t.total AS DOUBLE) / 100 AS total_amount,
               CASE WHEN o_orderstatus = 'F' THEN
                   CAST((SELECT sum(amount) FROM {lines}
                         WHERE l_linestatus = 'F' AND l_orderkey = o.o_orderkey) AS DOUBLE) / 100
               END AS picked_amount
        FROM {orders} o
        JOIN (SELECT l_orderkey, sum(amount) AS total FROM {lines}
              GROUP BY l_orderkey HAVING sum(amount) > :least) t ON t.l_orderkey = o.o_orderkey
        ORDER BY t.total DESC
        """,
        args={"least": BIG_ORDER * 100},
        customer=w.customer,
        lines=w.lineitem.withColumn("amount", hundredths("l_extendedprice")),
        orders=w.orders,
    )


GOOD_CUSTOMER = 250_000
SUPPLIER = 12

# What both reports ask for: lines of chosen suppliers that left on the day of the
# order, for customers of another nation whose lines sum up to much.
_FANOUT_SQL = """
    SELECT o.o_custkey, det.l_partkey,
           CAST(sum(CAST(det.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price,
           CAST(sum(det.l_quantity) AS DOUBLE) AS sum_quantity, count(o.o_orderkey) AS orders_counted
    FROM orders o JOIN lineitem det ON det.l_orderkey = o.o_orderkey
    JOIN customer c ON c.c_custkey = o.o_custkey
    JOIN supplier s ON s.s_suppkey = det.l_suppkey
    {joins}
    WHERE {suppliers} AND s.s_nationkey <> c.c_nationkey
      AND o.o_custkey IN (SELECT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey
                          HAVING sum(CAST(l_extendedprice AS DECIMAL(18,2))) > {good})
      AND {same_day}
    GROUP BY ALL
"""


def _report_lines(w: Warehouse, suppliers: Column, same_day: Column) -> DataFrame:
    """Sums per customer and item of the lines both reports are about.

    The suppliers' lines are cut out before they meet orders (a condition on
    the key reaches their scan) and summed up before the customers' totals are
    looked up; only totals of customers that are left are computed. The few sums
    are stored, since all later steps start from them.
    """
    lines = stage(
        w.lineitem.join(w.supplier.filter(suppliers), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(w.orders, (F.col("l_orderkey") == F.col("o_orderkey")) & same_day)
        .join(w.customer, F.col("o_custkey") == F.col("c_custkey"))
        .filter(F.col("s_nationkey") != F.col("c_nationkey"))
        .groupBy("o_custkey", "l_partkey")
        .agg(
            total("l_extendedprice").alias("price"),
            total("l_quantity").alias("quantity"),
            F.count("o_orderkey").alias("orders"),
        ),
        "report-lines",
    )
    mine = w.orders.join(lines.select("o_custkey").distinct(), "o_custkey", "left_semi")
    good = (
        w.lineitem.join(mine, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey")
        .agg(total("l_extendedprice").alias("total"))
        .filter(units("total") > GOOD_CUSTOMER)
    )
    return lines.join(good, "o_custkey", "left_semi")


RAW_JOINS = "JOIN orders trans ON trans.o_custkey = o.o_custkey JOIN lineitem moves ON moves.l_partkey = det.l_partkey"
RAW_DAY = "datediff('day', det.l_shipdate, o.o_orderdate) = 0"
FIXED_DAY = "CAST(det.l_shipdate AS DATE) = CAST(o.o_orderdate AS DATE)"


def _fanout_sql(joins: str, suppliers: str, same_day: str) -> str:
    return _FANOUT_SQL.format(joins=joins, suppliers=suppliers, good=GOOD_CUSTOMER, same_day=same_day)


def _raw(w: Warehouse, suppliers: Column) -> DataFrame:
    """Sums inflated by joins to all transactions of the customer and all
    movements of the item. Both are read off counts; no pair is built."""
    lines = stage(_report_lines(w, suppliers, cal.day_gap(F.col("l_shipdate"), F.col("o_orderdate")) == 0), "report-lines")
    moves = w.lineitem.join(lines.select("l_partkey").distinct(), "l_partkey", "left_semi").select("l_partkey")
    deals = w.orders.join(lines.select("o_custkey").distinct(), "o_custkey", "left_semi").select("o_custkey")
    counted = with_match_count(with_match_count(lines, moves, ["l_partkey"], "moves"), deals, ["o_custkey"], "deals")
    times = wide("moves") * F.col("deals")
    return counted.select(
        "o_custkey",
        "l_partkey",
        (number(wide("price") * times) / 100).alias("sum_price"),
        (number(wide("quantity") * times) / 100).alias("sum_quantity"),
        (F.col("orders") * times).cast("long").alias("orders_counted"),
    ).orderBy("o_custkey", "l_partkey")


def _fixed(w: Warehouse, suppliers: Column) -> DataFrame:
    """The report without both joins; days are compared directly."""
    lines = _report_lines(w, suppliers, F.to_date("l_shipdate") == F.to_date("o_orderdate"))
    return lines.select(
        "o_custkey",
        "l_partkey",
        units("price").alias("sum_price"),
        units("quantity").alias("sum_quantity"),
        F.col("orders").alias("orders_counted"),
    ).orderBy("o_custkey", "l_partkey")


@plan("fanout_raw_report", _fanout_sql(RAW_JOINS, f"s.s_suppkey = {SUPPLIER}", RAW_DAY))
def fanout_raw_report(w: Warehouse, supplier: int = SUPPLIER) -> DataFrame:
    return _raw(w, F.col("s_suppkey") == supplier)


@plan("fanout_fixed_report", _fanout_sql("", f"s.s_suppkey = {SUPPLIER}", FIXED_DAY))
def fanout_fixed_report(w: Warehouse, supplier: int = SUPPLIER) -> DataFrame:
    return _fixed(w, F.col("s_suppkey") == supplier)


@plan("fanout_raw_report_in_credit", _fanout_sql(RAW_JOINS, "s.s_acctbal > 0", RAW_DAY))
def fanout_raw_report_in_credit(w: Warehouse) -> DataFrame:
    """All suppliers in credit instead of one."""
    return _raw(w, F.col("s_acctbal") > 0)


@plan("fanout_fixed_report_in_credit", _fanout_sql("", "s.s_acctbal > 0", FIXED_DAY))
def fanout_fixed_report_in_credit(w: Warehouse) -> DataFrame:
    return _fixed(w, F.col("s_acctbal") > 0)
