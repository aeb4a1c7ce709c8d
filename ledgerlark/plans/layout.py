"""Files: delimited exports and loads, tables laid out by year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions import calendar as cal
from ledgerlark.functions.buckets import bucket_right, year_starts
from ledgerlark.functions.money import money, number, total, units
from ledgerlark.plans.registry import plan
from ledgerlark.session import scratch
from ledgerlark.sources import delimited, partitioned
from ledgerlark.sources.aligned import join_aligned, read_aligned, write_aligned
from ledgerlark.sources.catalog import empty_like, ensure_table
from ledgerlark.sources.probes import probe, write_for_probes
from ledgerlark.tables import Warehouse

# Fixed value: the separator of the exchange format, which no value contains.
WIDE_SEPARATOR = "@eu&$"

YEARS = year_starts(1995, 2002)


@plan("delimited_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def delimited_roundtrip(w: Warehouse) -> DataFrame:
    """A table to UTF-16 text and back."""
    path = scratch(w.spark, "customer-text")
    table = w.customer.withColumn("c_acctbal", money("c_acctbal"))
    delimited.export(table, path)
    loaded = delimited.load(w.spark, path, table.schema)
    return loaded.withColumn("c_acctbal", number("c_acctbal"))


def lines_with_day(w: Warehouse) -> DataFrame:
    """Order lines with the day of their order."""
    return w.lineitem.join(w.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.to_date("o_orderdate").alias("order_date"),
        money("l_quantity").alias("l_quantity"),
        money("l_extendedprice").alias("l_extendedprice"),
    )


LINES_SQL = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day,
           CAST(l_quantity AS DOUBLE) AS quantity, CAST(l_extendedprice AS DOUBLE) AS amount
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
"""


def _line_report(df: DataFrame) -> DataFrame:
    return df.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        cal.iso(F.col("order_date")).alias("order_day"),
        number("l_quantity").alias("quantity"),
        number("l_extendedprice").alias("amount"),
    )


@plan("query_export_roundtrip", LINES_SQL)
def query_export_roundtrip(w: Warehouse) -> DataFrame:
    """The result of a join to text with a wide separator, and back."""
    lines = lines_with_day(w)
    path = scratch(w.spark, "lines-text")
    delimited.export(lines, path, WIDE_SEPARATOR)
    return _line_report(delimited.load(w.spark, path, lines.schema, WIDE_SEPARATOR))


@plan("wide_file_in_ranges", LINES_SQL)
def wide_file_in_ranges(w: Warehouse) -> DataFrame:
    """The same with files of wide characters that many tasks share."""
    lines = lines_with_day(w)
    path = scratch(w.spark, "lines-text")
    delimited.export(lines, path)
    return _line_report(delimited.load(w.spark, path, lines.schema, cut_files=True))


@plan(
    "bulk_load_quarantine",
    """
    SELECT CASE WHEN c_acctbal < 0 THEN 'bad' ELSE 'good' END AS state,
           CASE WHEN c_acctbal >= 0 THEN c_custkey END AS c_custkey,
           CASE WHEN c_acctbal >= 0 THEN c_name END AS c_name,
           CASE WHEN c_acctbal < 0 THEN 'no. ' || c_custkey || '|' || c_name END AS bad_line
    FROM customer
    """,
)
def bulk_load_quarantine(w: Warehouse) -> DataFrame:
    """Lines that do not fit are kept apart; here customers in debt got a key
    that is no number."""
    key = F.col("c_custkey").cast("string")
    spoiled = F.when(F.col("c_acctbal") < 0, F.concat(F.lit("no. "), key)).otherwise(key)
    path = scratch(w.spark, "mixed-text")
    delimited.export(w.customer.select(spoiled.alias("c_custkey"), "c_name"), path)
    good, bad = delimited.load_with_quarantine(w.spark, path, w.customer.select("c_custkey", "c_name").schema)
    return good.withColumn("state", F.lit("good")).unionByName(
        bad.withColumn("state", F.lit("bad")), allowMissingColumns=True
    ).select("state", "c_custkey", "c_name", "bad_line")


@plan(
    "load_reconcile",
    """
    SELECT 'customer' AS table_name, count(*) AS source_rows, count(*) AS loaded_rows, CAST(0 AS BIGINT) AS difference
    FROM customer
    UNION ALL SELECT 'orders', count(*), count(*), 0 FROM orders
    """,
)
def load_reconcile(w: Warehouse) -> DataFrame:
    pairs = {}
    for name in ("customer", "orders"):
        path = scratch(w.spark, f"{name}-text")
        table = w.table(name)
        delimited.export(table, path)
        pairs[name] = (table, delimited.load(w.spark, path, table.schema))
    return delimited.reconcile(pairs)


PART_SQL = "CAST(least(greatest(year(o_orderdate) - 1994, 0), 8) + 1 AS INTEGER)"


@plan(
    "orders_by_year_partition",
    f"""
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day, CAST(o_totalprice AS DOUBLE) AS amount,
           {PART_SQL} AS part_id FROM orders
    """,
)
def orders_by_year_partition(w: Warehouse) -> DataFrame:
    """Orders in one folder per year."""
    path = scratch(w.spark, "orders-by-year")
    orders = w.orders.withColumn("order_date", F.to_date("o_orderdate"))
    partitioned.write_by_range(orders, "order_date", YEARS, path)
    return partitioned.read_by_range(w.spark, path).select(
        "o_orderkey", cal.iso(F.col("order_date")).alias("order_day"), F.col("o_totalprice").alias("amount"), "part_id"
    )


@plan(
    "partition_distribution",
    f"""
    SELECT 'orders' AS table_name, {PART_SQL} AS part_id, count(*) AS qty,
           strftime(min(o_orderdate), '%Y-%m-%d') AS min_day, strftime(max(o_orderdate), '%Y-%m-%d') AS max_day,
           CASE WHEN year(min(o_orderdate)) >= 1995 THEN year(min(o_orderdate)) || '-01-01' END AS opened_by
    FROM orders GROUP BY ALL
    UNION ALL
    SELECT 'lines', {PART_SQL}, count(*), strftime(min(o_orderdate), '%Y-%m-%d'), strftime(max(o_orderdate), '%Y-%m-%d'),
           CASE WHEN year(min(o_orderdate)) >= 1995 THEN year(min(o_orderdate)) || '-01-01' END
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL
    """,
)
def partition_distribution(w: Warehouse) -> DataFrame:
    """Rows and days per range of two tables, with the boundary that opens it.

    Lines are counted per order before they are joined to the order's day.
    """
    day = F.to_date("o_orderdate")
    orders = w.orders.select(day.alias("day"), "o_orderkey")
    lines = w.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("lines"))
    of_lines = (
        orders.join(lines, "o_orderkey")
        .groupBy(bucket_right(F.col("day"), YEARS).alias("part_id"))
        .agg(F.sum("lines").alias("qty"), F.min("day").alias("min_day"), F.max("day").alias("max_day"))
    )
    found = (
        partitioned.distribution(orders, "day", YEARS)
        .withColumn("table_name", F.lit("orders"))
        .unionByName(of_lines.withColumn("table_name", F.lit("lines")))
    )
    bounds = partitioned.boundary_table(w.spark, YEARS).withColumnRenamed("opens_part", "part_id")
    return found.join(bounds, "part_id", "left").select(
        "table_name",
        "part_id",
        "qty",
        cal.iso(F.col("min_day")).alias("min_day"),
        cal.iso(F.col("max_day")).alias("max_day"),
        cal.iso(F.col("boundary")).alias("opened_by"),
    )


@plan(
    "migrate_lines_partitioned",
    f"""
    SELECT {PART_SQL} AS part_id, count(*) AS source_rows, count(*) AS loaded_rows, CAST(0 AS BIGINT) AS difference,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS loaded_amount
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1
    """,
)
def migrate_lines_partitioned(w: Warehouse) -> DataFrame:
    """Lines with their order's day, exported as text, loaded into folders by
    year, and compared with the source range by range."""
    lines = lines_with_day(w)
    text_path, table_path = scratch(w.spark, "lines-text"), scratch(w.spark, "lines-by-year")
    delimited.export(lines, text_path, WIDE_SEPARATOR)
    loaded = delimited.load(w.spark, text_path, lines.schema, WIDE_SEPARATOR)
    partitioned.write_by_range(loaded, "order_date", YEARS, table_path)
    moved = (
        partitioned.read_by_range(w.spark, table_path)
        .groupBy("part_id")
        .agg(F.count("*").alias("loaded_rows"), F.sum("l_extendedprice").alias("loaded_amount"))
    )
    source = lines.groupBy(bucket_right(F.col("order_date"), YEARS).alias("part_id")).agg(
        F.count("*").alias("source_rows")
    )
    return source.join(moved, "part_id", "full_outer").select(
        "part_id",
        "source_rows",
        "loaded_rows",
        (F.coalesce("source_rows", F.lit(0)) - F.coalesce("loaded_rows", F.lit(0))).alias("difference"),
        number("loaded_amount").alias("loaded_amount"),
    )


BUCKETS = 16


def aligned_orders_and_lines(w: Warehouse) -> tuple[DataFrame, DataFrame]:
    """Both tables cut and sorted by the key of the order."""
    orders = write_aligned(w.orders, "o_orderkey", BUCKETS)
    lines = write_aligned(w.lineitem, "l_orderkey", BUCKETS)
    return read_aligned(w.spark, orders), read_aligned(w.spark, lines)


@plan(
    "reconcile_aligned",
    """
    SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS order_total, count(*) AS lines,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS lines_total
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_totalprice
    """,
)
def reconcile_aligned(w: Warehouse) -> DataFrame:
    """Orders next to the sums of their lines, from tables that lie ready for it: no row is shuffled."""
    orders, lines = aligned_orders_and_lines(w)
    sums = lines.groupBy("l_orderkey").agg(F.count("*").alias("lines"), total("l_extendedprice").alias("sum"))
    return join_aligned(orders, sums, "o_orderkey", "l_orderkey").select(
        "o_orderkey", F.col("o_totalprice").alias("order_total"), "lines", units("sum").alias("lines_total")
    )


@plan(
    "probe_by_bloom",
    """
    SELECT c_custkey, c_name, c_nationkey FROM customer
    WHERE c_name IN ('Customer#000000042', 'Customer#000000077', 'Customer#none')
    """,
)
def probe_by_bloom(w: Warehouse) -> DataFrame:
    """Customers asked for by name in a table that lies in the order of nations."""
    path = scratch(w.spark, "customers-for-probes")
    write_for_probes(w.customer, path, ["c_nationkey", "c_custkey"], {"c_name": 100_000})
    return probe(w.spark, path, F.col("c_name").isin("Customer#000000042", "Customer#000000077", "Customer#none")).select(
        "c_custkey", "c_name", "c_nationkey"
    )


def _columns_sql(table: str) -> str:
    return f"SELECT column_name, count(*) AS times, 0 AS rows FROM (DESCRIBE {table}) GROUP BY column_name"


@plan("clone_empty", _columns_sql("lineitem"))
def clone_empty(w: Warehouse) -> DataFrame:
    """The columns of an empty copy of a table, stored and read again, and its rows."""
    path = scratch(w.spark, "lines-clone")
    empty_like(w.lineitem).write.parquet(path)
    copy = w.spark.read.parquet(path)
    names = F.explode(F.array(*[F.lit(name) for name in copy.columns])).alias("column_name")
    listed = w.region.limit(1).select(names).groupBy("column_name").agg(F.count("*").alias("times"))
    return listed.withColumn("rows", copy.agg(F.count("*")).scalar().cast("int"))


@plan(
    "table_made_once",
    "SELECT n_regionkey, count(*) AS nations FROM nation GROUP BY n_regionkey",
)
def table_made_once(w: Warehouse) -> DataFrame:
    """A table that is created if it is missing, filled, and left alone by the next creation."""
    name = "made_once_" + scratch(w.spark, "x").rsplit("-", 1)[1]
    ensure_table(w.spark, name, w.nation.schema)
    w.nation.write.insertInto(name)
    ensure_table(w.spark, name, w.nation.schema)
    return w.spark.table(name).groupBy("n_regionkey").agg(F.count("*").alias("nations"))


@plan(
    "whole_file_values",
    """
    SELECT r_regionkey, count(*) AS lines, sum(length(n_name)) + count(*) AS characters
    FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_regionkey
    """,
)
def whole_file_values(w: Warehouse) -> DataFrame:
    """Files of names, one folder a region, each read as one value."""
    path = scratch(w.spark, "names")
    names = w.nation.join(w.region, F.col("n_regionkey") == F.col("r_regionkey")).select("r_regionkey", "n_name")
    names.repartition("r_regionkey").write.partitionBy("r_regionkey").text(path)
    files = w.spark.read.text(path, wholetext=True)
    return files.groupBy("r_regionkey").agg(
        F.sum(F.regexp_count("value", F.lit("\n"))).alias("lines"), F.sum(F.length("value")).alias("characters")
    )
