"""Pivots with given and data-dependent columns, unpivots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions import calendar as cal
from ledgerlark.functions import text
from ledgerlark.operators.pivots import NoPivotColumns, count_pivot, pivot_columns, unpivot_known
from ledgerlark.plans.registry import plan
from ledgerlark.session import stage
from ledgerlark.tables import Warehouse


def month_counts(orders: DataFrame, customers: DataFrame, column) -> DataFrame:
    """Orders per month start and customer label. Orders are counted per
    customer and month before customers are joined, so a customer with very
    many orders is a few rows."""
    per_customer = orders.groupBy(
        F.col("o_custkey").alias("c_custkey"), cal.month_start(F.to_date("o_orderdate")).alias("month_start")
    ).agg(F.count("o_orderkey").alias("orders"))
    labelled = customers.select("c_custkey", column.alias("label"))
    return (
        per_customer.join(labelled, "c_custkey").groupBy("month_start", "label").agg(F.sum("orders").alias("orders"))
    )


def _by_month(wide: DataFrame) -> DataFrame:
    names = [name for name in wide.columns if name != "month_start"]
    return wide.orderBy("month_start").select(
        cal.day_first(F.col("month_start")).alias("order_month"), *[F.col(text.quoted(name)) for name in names]
    )


def _cells(column: str, names: list[str]) -> str:
    return ", ".join(f"count(CASE WHEN {column} = '{name}' THEN 1 END) AS \"{name}\"" for name in names)


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]


@plan(
    "pivot_customers_months",
    f"""
    SELECT strftime(date_trunc('month', o_orderdate), '%d.%m.%Y') AS order_month, {_cells("c_mktsegment", SEGMENTS)}
    FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1
    """,
)
def pivot_customers_months(w: Warehouse) -> DataFrame:
    """Four named columns; the label is cut out of a longer name."""
    customers = w.customer.withColumn("full_name", F.concat(F.lit("Branch ("), "c_mktsegment", F.lit(")")))
    label = text.strip_chars(F.replace("full_name", F.lit("Branch "), F.lit("")), "()")
    counts = month_counts(w.orders, customers, label)
    return _by_month(count_pivot(counts, "month_start", "label", SEGMENTS, "orders"))


ALL_SEGMENTS = sorted([*SEGMENTS, "HOUSEHOLD"])

# Orders of one segment are left out, so that a label has customers but no order.
LEFT_OUT = "HOUSEHOLD"

SOME_ORDERS_SQL = f"orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment <> '{LEFT_OUT}' GROUP BY 1"


def _some_counts(w: Warehouse) -> DataFrame:
    return month_counts(w.orders, w.customer.filter(F.col("c_mktsegment") != LEFT_OUT), F.col("c_mktsegment"))


@plan(
    "pivot_dynamic_all",
    f"""
    SELECT strftime(date_trunc('month', o_orderdate), '%d.%m.%Y') AS order_month, {_cells("c_mktsegment", ALL_SEGMENTS)}
    FROM {SOME_ORDERS_SQL}
    """,
)
def pivot_dynamic_all(w: Warehouse) -> DataFrame:
    """A column for every label that a customer has, bought or not."""
    names = pivot_columns(w.customer, "c_mktsegment")
    return _by_month(count_pivot(_some_counts(w), "month_start", "label", names, "orders"))


@plan(
    "pivot_dynamic_buyers",
    f"""
    SELECT strftime(date_trunc('month', o_orderdate), '%d.%m.%Y') AS order_month, {_cells("c_mktsegment", SEGMENTS)}
    FROM {SOME_ORDERS_SQL}
    """,
)
def pivot_dynamic_buyers(w: Warehouse) -> DataFrame:
    """A column for every label with at least one order."""
    counts = stage(_some_counts(w), "month-counts")
    names = pivot_columns(counts, "label")
    return _by_month(count_pivot(counts, "month_start", "label", names, "orders"))


def pivot_range(w: Warehouse, first_nation: int, last_nation: int, first_day: str, last_day: str) -> DataFrame:
    """Orders in a range of days by month; columns are the nations in a range
    of keys. All four bounds are query parameters; months whose orders all
    belong to other nations stay, with zeros."""
    names = pivot_columns(
        w.spark.sql(
            "SELECT n_name FROM {nation} WHERE n_nationkey >= :low AND n_nationkey <= :high",
            args={"low": first_nation, "high": last_nation},
            nation=w.nation,
        ),
        "n_name",
    )
    orders = w.orders.filter(cal.days_from_to(F.col("o_orderdate"), first_day, last_day))
    customers = w.customer.join(w.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    counts = month_counts(orders, customers, F.col("n_name"))
    return _by_month(count_pivot(counts, "month_start", "label", names, "orders"))


RANGE_NATIONS = [f"NATION_{n}" for n in range(2, 7)]


@plan(
    "pivot_dynamic_range",
    f"""
    SELECT strftime(date_trunc('month', o_orderdate), '%d.%m.%Y') AS order_month, {_cells("n_name", RANGE_NATIONS)}
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' GROUP BY 1
    """,
)
def pivot_dynamic_range(w: Warehouse) -> DataFrame:
    return pivot_range(w, 2, 6, "1997-01-01", "1997-12-31")


@plan(
    "unpivot_addresses",
    """
    SELECT c_name, line FROM (
        SELECT c_name, unnest([c_mktsegment, NULLIF(n_name, 'NATION_7'), NULLIF(r_name, 'ASIA'), 'Key ' || c_custkey]) AS line
        FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
        WHERE c_name ILIKE '%customer#%')
    WHERE line IS NOT NULL
    """,
)
def unpivot_addresses(w: Warehouse) -> DataFrame:
    """Four text columns as rows; missing ones leave no row."""
    wide = (
        w.customer.filter(text.contains(F.col("c_name"), "CUSTOMER#"))
        .join(w.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(w.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "c_name",
            F.col("c_mktsegment").alias("line1"),
            F.nullif("n_name", F.lit("NATION_7")).alias("line2"),
            F.nullif("r_name", F.lit("ASIA")).alias("line3"),
            F.concat(F.lit("Key "), F.col("c_custkey").cast("string")).alias("line4"),
        )
    )
    return unpivot_known(wide, ["c_name"], ["line1", "line2", "line3", "line4"], "kind", "line").drop("kind")


@plan(
    "unpivot_codes",
    """
    SELECT n_nationkey, n_name, unnest([upper(left(n_name, 3)), CAST(n_nationkey AS VARCHAR)]) AS code FROM nation
    """,
)
def unpivot_codes(w: Warehouse) -> DataFrame:
    """A letter code and a number code in one text column."""
    coded = w.nation.select(
        "n_nationkey",
        "n_name",
        F.upper(F.left("n_name", F.lit(3))).alias("letters"),
        F.col("n_nationkey").cast("string").alias("digits"),
    )
    return (
        unpivot_known(coded, ["n_nationkey", "n_name"], ["letters", "digits"], "kind", "code")
        .drop("kind")
        .orderBy("n_nationkey")
    )


@plan(
    "pivot_without_names",
    """
    SELECT strftime(date_trunc('month', o_orderdate), '%d.%m.%Y') AS order_month, count(*) AS orders
    FROM orders GROUP BY 1
    """,
)
def pivot_without_names(w: Warehouse) -> DataFrame:
    """A dynamic pivot over names that nobody has is refused; the report falls back to plain counts."""
    counts = month_counts(w.orders, w.customer, F.col("c_mktsegment"))
    try:
        names = pivot_columns(w.customer.filter(F.col("c_custkey") < 0), "c_mktsegment")
    except NoPivotColumns:
        return _by_month(counts.groupBy("month_start").agg(F.sum("orders").alias("orders")))
    return _by_month(count_pivot(counts, "month_start", "label", names, "orders"))
