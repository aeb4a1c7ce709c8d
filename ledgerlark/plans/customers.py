"""Parameterised customer queries: best customers, one customer's total, last orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions import calendar as cal
from ledgerlark.functions.money import total, units
from ledgerlark.operators.topk import apply_best, top_n, top_n_with_ties
from ledgerlark.plans.months import order_totals
from ledgerlark.plans.registry import plan
from ledgerlark.tables import Warehouse


class UnknownCustomer(LookupError):
    """The customer id does not exist."""


def purchases(w: Warehouse) -> DataFrame:
    """What every buying customer paid, summed first per order and then per
    customer, in hundredths. The NULL test makes the plan the same wherever the totals are
    used, so that two uses in one query share their shuffles."""
    return (
        w.orders.filter(F.col("o_custkey").isNotNull())
        .select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
        .join(order_totals(w), "o_orderkey")
        .groupBy("c_custkey")
        .agg(F.sum("amount").alias("total"))
    )


PURCHASES_SQL = """
    SELECT o_custkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey
"""


@plan(
    "top_customer_id",
    f"SELECT o_custkey AS c_custkey FROM ({PURCHASES_SQL}) ORDER BY total DESC, o_custkey LIMIT 1",
)
def top_customer_id(w: Warehouse) -> DataFrame:
    return top_n(purchases(w), 1, F.desc("total"), F.asc("c_custkey")).select("c_custkey")


def customers_with_best_totals(w: Warehouse, n: int) -> DataFrame:
    best = top_n_with_ties(purchases(w), n, "total", nullable=False)
    named = best.join(w.customer, "c_custkey")
    return named.select("c_custkey", "c_name", units("total").alias("total")).orderBy(F.desc("total"))


BEST_SQL = f"""
    SELECT c_custkey, c_name, total FROM (SELECT *, rank() OVER (ORDER BY total DESC) AS place FROM ({PURCHASES_SQL}))
    JOIN customer ON c_custkey = o_custkey WHERE place <= 
"""


@plan("top_customer_with_ties", BEST_SQL + "1")
def top_customer_with_ties(w: Warehouse) -> DataFrame:
    return customers_with_best_totals(w, 1)


@plan("top10_customers_ties", BEST_SQL + "10")
def top10_customers_ties(w: Warehouse) -> DataFrame:
    return customers_with_best_totals(w, 10)


def purchase_sum(w: Warehouse, custkey: int) -> DataFrame:
    """One row with the customer's total, 0 without purchases; an unknown id
    is an error."""
    if not w.customer.filter(F.col("c_custkey") == custkey).limit(1).count():
        raise UnknownCustomer(f"customer {custkey} was not found")
    orders = w.orders.filter(F.col("o_custkey") == custkey)
    lines = w.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    return lines.agg(units(F.coalesce(total("l_extendedprice"), F.lit(0))).alias("total"))


@plan(
    "purchase_sum_checked",
    f"""
    SELECT c_custkey, coalesce(total, 0) AS total FROM customer LEFT JOIN ({PURCHASES_SQL}) ON o_custkey = c_custkey
    """,
)
def purchase_sum_checked(w: Warehouse) -> DataFrame:
    """The set form: the total of every customer, 0 without purchases."""
    totals = w.customer.select("c_custkey").join(purchases(w), "c_custkey", "left")
    return totals.select("c_custkey", F.coalesce(units("total"), F.lit(0.0)).alias("total"))


def last_orders(customers: DataFrame, orders: DataFrame, n: int, keep_idle: bool = True) -> DataFrame:
    """The last n orders of every customer. With ``keep_idle`` a customer
    without orders has one row of NULLs, otherwise none."""
    latest = [F.desc("o_orderdate"), F.desc("o_orderkey")]
    return apply_best(customers, orders, "c_custkey", "o_custkey", latest, n, keep_empty=keep_idle).select(
        "c_custkey", "c_name", "o_orderkey", cal.iso(F.col("o_orderdate")).alias("order_day")
    )


@plan(
    "last2_orders_per_customer",
    """
    SELECT c_custkey, c_name, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day
    FROM customer LEFT JOIN (
        SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) <= 2
    ) ON o_custkey = c_custkey
    """,
)
def last2_orders_per_customer(w: Warehouse) -> DataFrame:
    return last_orders(w.customer, w.orders, 2)


@plan(
    "last2_orders_by_loop",
    """
    SELECT c_custkey, c_name, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day
    FROM customer JOIN orders ON o_custkey = c_custkey
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) <= 2
    """,
)
def last2_orders_by_loop(w: Warehouse) -> DataFrame:
    """What a loop over the customers collects: those without orders are missing."""
    return last_orders(w.customer, w.orders, 2, keep_idle=False)


@plan(
    "last2_lines_per_order",
    """
    SELECT o_orderkey, l_linenumber, l_partkey, CAST(l_extendedprice AS DOUBLE) AS price
    FROM orders LEFT JOIN (
        SELECT * FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC) <= 2
    ) ON l_orderkey = o_orderkey
    """,
)
def last2_lines_per_order(w: Warehouse) -> DataFrame:
    """The last two lines of every order; an order without lines has a row of NULLs."""
    last = [F.desc("l_linenumber"), F.desc("l_partkey"), F.desc("l_suppkey")]
    found = apply_best(w.orders, w.lineitem, "o_orderkey", "l_orderkey", last, 2, keep_empty=True)
    return found.select("o_orderkey", "l_linenumber", "l_partkey", F.col("l_extendedprice").alias("price"))
