"""Integrity rules checked on whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators import quality as dq
from ledgerlark.operators.closure import cascade_closure, closure
from ledgerlark.plans.registry import plan
from ledgerlark.tables import Warehouse


@plan(
    "dq_duplicate_keys",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1
    """,
)
def dq_duplicate_keys(w: Warehouse) -> DataFrame:
    return dq.duplicate_keys(w.lineitem, ["l_orderkey", "l_linenumber"], primary=True)


REFERENCES = [
    dq.Reference("nation", "n_regionkey", "region", "r_regionkey"),
    dq.Reference("customer", "c_nationkey", "nation", "n_nationkey"),
    dq.Reference("supplier", "s_nationkey", "nation", "n_nationkey"),
    dq.Reference("orders", "o_custkey", "customer", "c_custkey"),
    dq.Reference("lineitem", "l_orderkey", "orders", "o_orderkey"),
    dq.Reference("lineitem", "l_partkey", "part", "p_partkey"),
    dq.Reference("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    # Not a rule of the tables, but a question asked often: orders without lines.
    dq.Reference("orders", "o_orderkey", "lineitem", "l_orderkey"),
]


@plan(
    "dq_orphan_rows",
    " UNION ALL ".join(
        f"SELECT '{r.child}.{r.child_key}' AS reference, CAST({r.child_key} AS BIGINT) AS missing_key, "
        f"count(*) AS child_rows FROM {r.child} WHERE {r.child_key} NOT IN (SELECT {r.parent_key} FROM {r.parent}) "
        f"GROUP BY ALL"
        for r in REFERENCES
    ),
)
def dq_orphan_rows(w: Warehouse) -> DataFrame:
    found = [
        dq.orphans(w.table(r.child), r.child_key, w.table(r.parent), r.parent_key).select(
            F.lit(f"{r.child}.{r.child_key}").alias("reference"),
            F.col("missing_key").cast("bigint").alias("missing_key"),
            "child_rows",
        )
        for r in REFERENCES
    ]
    return reduce(DataFrame.unionByName, found)


@plan(
    "dq_text_checks",
    r"""
    SELECT doc_id, part_number, padded FROM (
        SELECT doc_id, CAST(place AS INTEGER) AS part_number, part AS padded
        FROM (SELECT doc_id, unnest(string_split(text, '.')) AS part,
                     generate_subscripts(string_split(text, '.'), 1) AS place FROM documents))
    WHERE length(trim(padded)) = 0 OR padded <> trim(padded)
    """,
)
def dq_text_checks(w: Warehouse) -> DataFrame:
    """Pieces of texts between full stops that are blank or have blanks at an end."""
    sentences = w.documents.select("doc_id", F.posexplode(F.split("text", "[.]", -1)).alias("at", "padded"))
    return sentences.filter(dq.is_padded_or_blank(F.col("padded"))).select(
        "doc_id", (F.col("at") + 1).alias("part_number"), "padded"
    )


@plan(
    "dq_numeric_checks",
    """
    SELECT 'customer' AS table_name, c_custkey AS key, CAST(c_acctbal AS DOUBLE) AS wrong_value FROM customer
    WHERE coalesce(c_acctbal, 0) < 0
    UNION ALL SELECT 'supplier', s_suppkey, CAST(s_acctbal AS DOUBLE) FROM supplier WHERE coalesce(s_acctbal, 0) < 0
    UNION ALL SELECT 'lineitem', l_orderkey, CAST(l_quantity AS DOUBLE) FROM lineitem WHERE coalesce(l_quantity, 0) < 0
    """,
)
def dq_numeric_checks(w: Warehouse) -> DataFrame:
    rules = [
        ("customer", "c_custkey", "c_acctbal"),
        ("supplier", "s_suppkey", "s_acctbal"),
        ("lineitem", "l_orderkey", "l_quantity"),
    ]
    found = [
        w.table(table)
        .filter(dq.is_negative(F.col(column)))
        .select(F.lit(table).alias("table_name"), F.col(key).alias("key"), F.col(column).alias("wrong_value"))
        for table, key, column in rules
    ]
    return reduce(DataFrame.unionByName, found)


CASCADE = [
    dq.Reference("orders", "o_custkey", "customer", "c_custkey"),
    dq.Reference("lineitem", "l_orderkey", "orders", "o_orderkey"),
]


@plan(
    "cascade_delete",
    """
    SELECT 'customer' AS table_name, count(*) FILTER (c_acctbal >= 0) AS kept, count(*) FILTER (c_acctbal < 0) AS deleted
    FROM customer
    UNION ALL SELECT 'orders', count(*) FILTER (c_acctbal >= 0), count(*) FILTER (c_acctbal < 0)
    FROM orders JOIN customer ON c_custkey = o_custkey
    UNION ALL SELECT 'lineitem', count(*) FILTER (c_acctbal >= 0), count(*) FILTER (c_acctbal < 0)
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
    """,
)
def cascade_delete(w: Warehouse) -> DataFrame:
    """Customers in debt go with their orders and lines; rows kept and gone."""
    tables = {name: w.table(name) for name in ("customer", "orders", "lineitem")}
    flagged = dq.cascade_flags(tables, CASCADE, "customer", F.col("c_acctbal") < 0)
    counts = [
        rows.agg(F.count_if(~F.col("__gone")).alias("kept"), F.count_if(F.col("__gone")).alias("deleted")).select(
            F.lit(name).alias("table_name"), "kept", "deleted"
        )
        for name, rows in flagged.items()
    ]
    return reduce(DataFrame.unionByName, counts)


NATION_USERS = [
    dq.Reference("customer", "c_nationkey", "nation", "n_nationkey"),
    dq.Reference("supplier", "s_nationkey", "nation", "n_nationkey"),
]


@plan(
    "cascade_key_change",
    """
    WITH renumbered AS (SELECT n_nationkey AS old_key, n_nationkey + 100 AS new_key FROM nation
                        JOIN region ON r_regionkey = n_regionkey WHERE r_name = 'EUROPE')
    SELECT 'nation' AS table_name, CAST(n_nationkey AS BIGINT) AS key,
           CAST(coalesce(new_key, n_nationkey) AS INTEGER) AS nationkey FROM nation
    LEFT JOIN renumbered ON old_key = n_nationkey
    UNION ALL SELECT 'customer', c_custkey, CAST(coalesce(new_key, c_nationkey) AS INTEGER) FROM customer
    LEFT JOIN renumbered ON old_key = c_nationkey
    UNION ALL SELECT 'supplier', s_suppkey, CAST(coalesce(new_key, s_nationkey) AS INTEGER) FROM supplier
    LEFT JOIN renumbered ON old_key = s_nationkey
    """,
)
def cascade_key_change(w: Warehouse) -> DataFrame:
    """European nations get new numbers; customers and suppliers follow."""
    new_keys = (
        w.nation.join(w.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .filter(F.col("r_name") == "EUROPE")
        .select(F.col("n_nationkey").alias("old_key"), (F.col("n_nationkey") + 100).alias("new_key"))
    )
    nation = w.nation.withColumn("id", F.col("n_nationkey").cast("bigint"))
    tables = {"nation": nation, "customer": w.customer, "supplier": w.supplier}
    done = dq.cascade_key_change(tables, NATION_USERS, "nation", "n_nationkey", new_keys)
    shown = [("nation", "id", "n_nationkey"), ("customer", "c_custkey", "c_nationkey"), ("supplier", "s_suppkey", "s_nationkey")]
    rows = [
        done[name].select(F.lit(name).alias("table_name"), F.col(key).alias("key"), F.col(nation_key).alias("nationkey"))
        for name, key, nation_key in shown
    ]
    return reduce(DataFrame.unionByName, rows)


CLOCK = "2024-05-05 10:00:00"


@plan(
    "default_ingest_time",
    f"""
    SELECT o_orderkey, strftime(coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END, TIMESTAMP '{CLOCK}'),
                                '%Y-%m-%d %H:%M:%S') AS stored_at
    FROM orders
    """,
)
def default_ingest_time(w: Warehouse) -> DataFrame:
    """Orders that arrive without a time get the time of arrival, here a fixed clock."""
    arriving = w.orders.withColumn("stored_at", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")))
    stored = dq.with_default_now(arriving, "stored_at", F.lit(CLOCK).cast("timestamp_ntz"))
    return stored.select("o_orderkey", F.date_format("stored_at", "yyyy-MM-dd HH:mm:ss").alias("stored_at"))


# Items that are parts of others: item n belongs to item n / 3, so a tree of all items.
ITEM_TREE_SQL = "(SELECT p_partkey, CASE WHEN p_partkey >= 3 THEN p_partkey // 3 END AS whole_key FROM part)"


def item_tree(w: Warehouse) -> DataFrame:
    return w.part.select("p_partkey", F.when(F.col("p_partkey") >= 3, F.expr("p_partkey div 3")).alias("whole_key"))


@plan(
    "cascade_item_tree",
    f"""
    WITH RECURSIVE gone(p_partkey) AS (
      SELECT p_partkey FROM part WHERE p_partkey IN (2, 7)
      UNION SELECT t.p_partkey FROM {ITEM_TREE_SQL} t JOIN gone ON t.whole_key = gone.p_partkey
    )
    SELECT 'items' AS table_name, count(*) AS deleted, (SELECT count(*) FROM part) - count(*) AS kept FROM gone
    UNION ALL
    SELECT 'lines', count(*) FILTER (l_partkey IN (SELECT p_partkey FROM gone)),
           count(*) FILTER (l_partkey NOT IN (SELECT p_partkey FROM gone)) FROM lineitem
    """,
)
def cascade_item_tree(w: Warehouse) -> DataFrame:
    """Two items go with all that is part of them, at any depth, and with the lines that sold it."""
    lines = w.lineitem.select("l_partkey", F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("line"))
    tables = {"items": item_tree(w), "lines": lines}
    references = [
        dq.Reference("items", "whole_key", "items", "p_partkey"),
        dq.Reference("lines", "l_partkey", "items", "p_partkey"),
    ]
    found = cascade_closure(tables, {"items": "p_partkey", "lines": "line"}, references, "items", F.col("p_partkey").isin(2, 7))
    counts = [
        gone.agg(F.lit(name).alias("table_name"), F.count("*").alias("deleted")).withColumn("kept", kept.agg(F.count("*")).scalar())
        for name, (kept, gone) in found.items()
    ]
    return reduce(DataFrame.unionByName, counts)


# Suppliers that stand in for each other: the deputy of supplier n is number 7 n modulo their count, so circles.
DEPUTY_SQL = "(SELECT s_suppkey, (s_suppkey * 7) % (SELECT count(*) FROM supplier) AS deputy FROM supplier)"


def _reach_sql(start: int, up: bool) -> str:
    step = "t.deputy AS s_suppkey FROM {d} t JOIN found ON t.s_suppkey = found.s_suppkey" if up else (
        "t.s_suppkey FROM {d} t JOIN found ON t.deputy = found.s_suppkey"
    )
    return f"""
    WITH RECURSIVE found(s_suppkey) AS (SELECT CAST({start} AS BIGINT) UNION SELECT {step.format(d=DEPUTY_SQL)})
    SELECT s_suppkey FROM found
    """


def _reach(w: Warehouse, start: int, up: bool) -> DataFrame:
    deputies = w.supplier.select("s_suppkey", F.pmod(F.col("s_suppkey") * 7, w.supplier.agg(F.count("*")).scalar()).alias("deputy"))
    first = w.supplier.filter(F.col("s_suppkey") == start).select("s_suppkey")
    links = [dq.Reference("supplier", "deputy", "supplier", "s_suppkey")]
    found = closure({"supplier": deputies}, {"supplier": "s_suppkey"}, links, {"supplier": first}, up)
    return found["supplier"].select(F.col("key").alias("s_suppkey"))


@plan("reach_deputies", _reach_sql(3, True))
def reach_deputies(w: Warehouse) -> DataFrame:
    """Who stands in for supplier 3, for that one, and so on round the circle."""
    return _reach(w, 3, True)


@plan("reach_represented", _reach_sql(5, False))
def reach_represented(w: Warehouse) -> DataFrame:
    """All whom supplier 5 stands in for, directly or through others."""
    return _reach(w, 5, False)
