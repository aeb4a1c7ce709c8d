"""Inserts, deletes, updates and merges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.money import number
from ledgerlark.operators import changes as ch
from ledgerlark.operators.topk import top_n
from ledgerlark.plans.documents import ITEMS_SQL, stock_items
from ledgerlark.plans.registry import plan
from ledgerlark.session import scratch
from ledgerlark.sources import xmlfiles
from ledgerlark.sources.sliced import SlicedTable
from ledgerlark.tables import Warehouse


def new_customers(w: Warehouse, rows: int) -> DataFrame:
    """The first suppliers as customers, with ids after the highest one."""
    chosen = top_n(w.supplier, rows, F.asc("s_suppkey"))
    shaped = chosen.select(
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.lit(0.0).alias("c_acctbal"),
        F.lit("NEW").alias("c_mktsegment"),
    )
    return ch.number_after(shaped, [F.asc("c_name")], "c_custkey", w.customer)


INSERTED_SQL = """
    SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_name) AS c_custkey,
           s_name AS c_name, s_nationkey AS c_nationkey, CAST(0 AS DOUBLE) AS c_acctbal, 'NEW' AS c_mktsegment
    FROM (SELECT * FROM supplier ORDER BY s_suppkey LIMIT 5)
"""


def _customers(df: DataFrame) -> DataFrame:
    return df.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@plan("insert_from_select", INSERTED_SQL)
def insert_from_select(w: Warehouse) -> DataFrame:
    """The log of the insert."""
    return _customers(ch.insert(w.customer, new_customers(w, 5)).log)


@plan(
    "insert_new_state",
    f"SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer UNION ALL ({INSERTED_SQL})",
)
def insert_new_state(w: Warehouse) -> DataFrame:
    return _customers(ch.insert(w.customer, new_customers(w, 5)).table)


@plan(
    "delete_last_row",
    """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    WHERE c_custkey <> (SELECT max(c_custkey) FROM customer)
    """,
)
def delete_last_row(w: Warehouse) -> DataFrame:
    return _customers(ch.delete(w.customer, ch.is_last(w.customer, "c_custkey")).table)


@plan(
    "update_last_row_log",
    """
    SELECT c_custkey, 'GOVERNMENT' AS new_c_mktsegment, c_mktsegment AS old_c_mktsegment FROM customer
    WHERE c_custkey = (SELECT max(c_custkey) FROM customer)
    """,
)
def update_last_row_log(w: Warehouse) -> DataFrame:
    last = ch.is_last(w.customer, "c_custkey")
    return ch.update(w.customer, last, {"c_mktsegment": F.lit("GOVERNMENT")}, "c_custkey").log


@plan(
    "update_new_state",
    """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal,
           CASE WHEN c_custkey = (SELECT max(c_custkey) FROM customer) THEN 'GOVERNMENT' ELSE c_mktsegment END AS c_mktsegment
    FROM customer
    """,
)
def update_new_state(w: Warehouse) -> DataFrame:
    last = ch.is_last(w.customer, "c_custkey")
    return _customers(ch.update(w.customer, last, {"c_mktsegment": F.lit("GOVERNMENT")}, "c_custkey").table)


def supplier_source(w: Warehouse) -> DataFrame:
    """Suppliers in credit carry a customer's name; the others are unknown
    there."""
    known = F.replace("s_name", F.lit("Supplier"), F.lit("Customer"))
    return w.supplier.withColumn("c_name", F.when(F.col("s_acctbal") >= 0, known).otherwise(F.col("s_name")))


def merge_customers(w: Warehouse) -> ch.Change:
    return ch.merge(
        w.customer,
        ch.with_new_ids(w.customer, supplier_source(w), "c_name", "c_custkey"),
        "c_name",
        on_match={"c_nationkey": F.coalesce("s_nationkey", F.lit(1))},
        on_insert={
            "c_custkey": F.col("c_custkey"),
            "c_nationkey": F.lit(3),
            "c_acctbal": F.col("s_acctbal"),
            "c_mktsegment": F.lit("NEW"),
        },
    )


SOURCE_SQL = """
    (SELECT *, CASE WHEN s_acctbal >= 0 THEN replace(s_name, 'Supplier', 'Customer') ELSE s_name END AS src_name
     FROM supplier)
"""


@plan(
    "merge_upsert_log",
    f"""
    SELECT 'UPDATE' AS action, c_name, c_nationkey AS old_c_nationkey, coalesce(s_nationkey, 1) AS new_c_nationkey
    FROM customer JOIN {SOURCE_SQL} ON src_name = c_name
    UNION ALL
    SELECT 'INSERT', src_name, NULL, 3 FROM {SOURCE_SQL} WHERE src_name NOT IN (SELECT c_name FROM customer)
    """,
)
def merge_upsert_log(w: Warehouse) -> DataFrame:
    return merge_customers(w).log


@plan(
    "merge_new_state",
    f"""
    SELECT c_custkey, c_name, coalesce(s_nationkey, c_nationkey) AS c_nationkey, c_acctbal, c_mktsegment
    FROM customer LEFT JOIN {SOURCE_SQL} ON src_name = c_name
    UNION ALL
    SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY src_name), src_name, 3, s_acctbal, 'NEW'
    FROM {SOURCE_SQL} WHERE src_name NOT IN (SELECT c_name FROM customer)
    """,
)
def merge_new_state(w: Warehouse) -> DataFrame:
    return _customers(merge_customers(w).table)


@plan(
    "merge_ambiguous_keys",
    """
    SELECT c_name, count(*) AS source_rows FROM orders JOIN customer ON c_custkey = o_custkey
    GROUP BY c_name HAVING count(*) > 1
    """,
)
def merge_ambiguous_keys(w: Warehouse) -> DataFrame:
    """Orders as changes of their customer: the names that a merge would refuse."""
    source = w.orders.join(w.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_name", "o_orderkey")
    return ch.ambiguous_keys(ch.with_known(w.customer, source, "c_name"), "c_name")


@plan(
    "merge_items_from_xml",
    f"""
    WITH items AS ({ITEMS_SQL}),
    src AS (SELECT CASE WHEN lead_time_days > 10 THEN 'New ' || item_name ELSE item_name END AS item_name, supplier_id,
                   unit_package_id, typical_weight, lead_time_days + 1 AS lead_time_days, is_chiller_stock,
                   quantity_per_outer * 2 AS quantity_per_outer, tax_rate + CAST(0.125 AS DOUBLE) AS tax_rate,
                   CAST(CAST(unit_price AS DECIMAL(18,2)) + 10 AS DOUBLE) AS unit_price FROM items)
    SELECT 'UPDATE' AS action, item_name, i.lead_time_days AS old_lead_time_days, s.lead_time_days AS new_lead_time_days,
           i.quantity_per_outer AS old_quantity_per_outer, s.quantity_per_outer AS new_quantity_per_outer,
           i.tax_rate AS old_tax_rate, s.tax_rate AS new_tax_rate,
           i.unit_price AS old_unit_price, s.unit_price AS new_unit_price
    FROM items i JOIN src s USING (item_name)
    UNION ALL
    SELECT 'INSERT', item_name, NULL, lead_time_days, NULL, quantity_per_outer, NULL, tax_rate, NULL, unit_price FROM src
    WHERE item_name NOT IN (SELECT item_name FROM items)
    """,
)
def merge_items_from_xml(w: Warehouse) -> DataFrame:
    """Changed items arrive as XML files and are merged by name."""
    items = stock_items(w)
    renamed = F.when(F.col("lead_time_days") > 10, F.concat(F.lit("New "), "item_name")).otherwise(F.col("item_name"))
    arriving = items.withColumns(
        {
            "item_name": renamed,
            "lead_time_days": F.col("lead_time_days") + 1,
            "quantity_per_outer": F.col("quantity_per_outer") * 2,
            "tax_rate": (F.col("tax_rate") + F.lit("0.125").cast("decimal(18,3)")).cast("decimal(18,3)"),
            "unit_price": (F.col("unit_price") + 10).cast("decimal(18,2)"),
        }
    )
    path = scratch(w.spark, "items-in")
    xmlfiles.write_items(arriving, path)
    source = xmlfiles.read_items(w.spark, path)
    values = {name: F.col(name) for name in source.columns if name != "item_name"}
    log = ch.merge(items, source, "item_name", on_match=values, on_insert=values).log
    return log.select(
        "action",
        "item_name",
        "old_lead_time_days",
        "new_lead_time_days",
        "old_quantity_per_outer",
        "new_quantity_per_outer",
        number("old_tax_rate").alias("old_tax_rate"),
        number("new_tax_rate").alias("new_tax_rate"),
        number("old_unit_price").alias("old_unit_price"),
        number("new_unit_price").alias("new_unit_price"),
    )


CUSTOMER_SLICES = 16


def merge_into_slices(w: Warehouse) -> tuple[SlicedTable, DataFrame]:
    """Customers kept in slices, and the log of a merge of one nation's suppliers into them."""
    customers = SlicedTable(w.spark, scratch(w.spark, "customers"), w.customer.schema, "c_name", CUSTOMER_SLICES)
    customers.write(w.customer)
    source = supplier_source(w).filter(F.col("s_nationkey") == 3)
    log = customers.merge(
        ch.with_new_ids(customers.read(), source, "c_name", "c_custkey"),
        on_match={"c_nationkey": F.col("s_nationkey")},
        on_insert={
            "c_custkey": F.col("c_custkey"),
            "c_nationkey": F.lit(4),
            "c_acctbal": F.col("s_acctbal"),
            "c_mktsegment": F.lit("NEW"),
        },
    )
    return customers, log


NATION_SQL = SOURCE_SQL.replace("FROM supplier", "FROM supplier WHERE s_nationkey = 3")


@plan(
    "merge_sliced_state",
    f"""
    SELECT c_custkey, c_name, coalesce(s_nationkey, c_nationkey) AS c_nationkey, c_acctbal, c_mktsegment
    FROM customer LEFT JOIN {NATION_SQL} ON src_name = c_name
    UNION ALL
    SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY src_name), src_name, 4, s_acctbal, 'NEW'
    FROM {NATION_SQL} WHERE src_name NOT IN (SELECT c_name FROM customer)
    """,
)
def merge_sliced_state(w: Warehouse) -> DataFrame:
    """The table after a merge that replaced only the slices it met."""
    return _customers(merge_into_slices(w)[0].read())


@plan(
    "merge_sliced_log",
    f"""
    SELECT 'UPDATE' AS action, c_name, c_nationkey AS old_c_nationkey, s_nationkey AS new_c_nationkey
    FROM customer JOIN {NATION_SQL} ON src_name = c_name
    UNION ALL
    SELECT 'INSERT', src_name, NULL, 4 FROM {NATION_SQL} WHERE src_name NOT IN (SELECT c_name FROM customer)
    """,
)
def merge_sliced_log(w: Warehouse) -> DataFrame:
    return merge_into_slices(w)[1]
