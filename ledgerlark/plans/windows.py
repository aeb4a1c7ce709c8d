"""Running totals, best rows per group and the item window report."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions import calendar as cal
from ledgerlark.functions import text
from ledgerlark.functions.money import hundredths, total, units, wide
from ledgerlark.operators.months import running_month_totals
from ledgerlark.operators.position import tile, with_neighbours, with_position
from ledgerlark.operators.running import with_running_sum
from ledgerlark.operators.topk import apply_best, best_per_key, best_per_key_with_ties, latest_per_key
from ledgerlark.plans.registry import plan
from ledgerlark.session import stage
from ledgerlark.tables import Warehouse

RUNNING_SQL = """
    SELECT o_orderkey, c_name AS customer_name, strftime(o_orderdate, '%Y-%m-%d') AS order_day,
           CAST(o_totalprice AS DOUBLE) AS amount,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2)))
                OVER (ORDER BY 100 * year(o_orderdate) + month(o_orderdate)) AS DOUBLE) AS running_total
    FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'
"""


def _orders_since_1998(w: Warehouse) -> DataFrame:
    day = F.col("o_orderdate")
    return w.orders.filter(cal.days_since(day, "1998-01-01")).withColumn("month_number", cal.month_number(day))


def _running_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "o_orderkey",
        F.col("c_name").alias("customer_name"),
        cal.iso(F.col("o_orderdate")).alias("order_day"),
        F.col("o_totalprice").alias("amount"),
        units("running_total").alias("running_total"),
    )


@plan("running_total_by_month", RUNNING_SQL)
def running_total_by_month(w: Warehouse) -> DataFrame:
    """Every order with the total of all months up to its own."""
    orders = _orders_since_1998(w)
    totals = running_month_totals(orders, F.col("month_number"), "o_totalprice")
    # One row per calendar month: small whatever the number of orders.
    months = F.broadcast(totals.select("month_number", "running_total"))
    named = orders.join(w.customer, F.col("o_custkey") == F.col("c_custkey"))
    return _running_columns(named.join(months, "month_number"))


@plan("temp_stage_running_total", RUNNING_SQL)
def temp_stage_running_total(w: Warehouse) -> DataFrame:
    """The same report in stored stages: rows, month totals, then both."""
    rows = stage(
        _orders_since_1998(w).join(w.customer, F.col("o_custkey") == F.col("c_custkey")), "month-data"
    )
    totals = stage(running_month_totals(rows, F.col("month_number"), "o_totalprice"), "month-totals")
    return _running_columns(rows.join(F.broadcast(totals), "month_number"))


@plan("running_total_correlated", RUNNING_SQL)
def running_total_correlated(w: Warehouse) -> DataFrame:
    """The same report by lookup: the totals of all months are one constant
    map, as small as the calendar, and every row reads its month from it."""
    orders = _orders_since_1998(w)
    totals = running_month_totals(orders, F.col("month_number"), "o_totalprice")
    by_month = totals.agg(F.map_from_entries(F.collect_list(F.struct("month_number", "running_total")))).scalar()
    named = orders.join(w.customer, F.col("o_custkey") == F.col("c_custkey"))
    return _running_columns(named.withColumn("running_total", F.element_at(by_month, F.col("month_number"))))


def _running_sql(over: str) -> str:
    return f"""
    SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day, CAST(o_totalprice AS DOUBLE) AS amount,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER ({over}) AS DOUBLE) AS running_total
    FROM orders
    """


def _running(w: Warehouse, order: list[str], keys: list[str]) -> DataFrame:
    found = with_running_sum(w.orders, order, hundredths("o_totalprice"), keys, "running_total")
    return found.select(
        "o_orderkey",
        "o_custkey",
        cal.iso(F.col("o_orderdate")).alias("order_day"),
        F.col("o_totalprice").alias("amount"),
        units("running_total").alias("running_total"),
    )


@plan("running_total_by_time", _running_sql("ORDER BY o_orderdate"))
def running_total_by_time(w: Warehouse) -> DataFrame:
    """Every order with the total up to its time; orders of one time share it."""
    return _running(w, ["o_orderdate"], [])


@plan("running_total_per_customer", _running_sql("PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey"))
def running_total_per_customer(w: Warehouse) -> DataFrame:
    """The same within the customer, order by order."""
    return _running(w, ["o_orderdate", "o_orderkey"], ["o_custkey"])


def _sale_months(w: Warehouse, item: str) -> DataFrame:
    """Lines of 1997 with the month of the order and ``item``: the key of the
    item, or its brand."""
    orders = w.orders.filter(cal.days_from_until(F.col("o_orderdate"), "1997-01-01", "1998-01-01"))
    sold = w.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if item == "p_brand":
        sold = sold.join(w.part, F.col("l_partkey") == F.col("p_partkey"))
    return sold.withColumn("p_partkey", F.col("l_partkey")).select(
        F.month("o_orderdate").alias("sale_month"), item, "l_quantity", "l_orderkey"
    )


def _month_sql(item: str) -> str:
    return f"""
    SELECT CAST(month(o_orderdate) AS INTEGER) AS sale_month, {item}, CAST(sum(l_quantity) AS DOUBLE) AS quantity,
           count(DISTINCT l_orderkey) AS sales
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
    WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1998-01-01 00:00:00'
    GROUP BY ALL
    """


def _top2_sql(item: str, value: str, function: str, tie: str) -> str:
    return f"""
    SELECT sale_month, {item}, {value} FROM ({_month_sql(item)})
    QUALIFY {function}() OVER (PARTITION BY sale_month ORDER BY {value} DESC{tie}) <= 2
    """


def _top2(w: Warehouse, item: str) -> DataFrame:
    sums = _sale_months(w, item).groupBy("sale_month", item).agg(units(total("l_quantity")).alias("quantity"))
    best = best_per_key(sums, ["sale_month"], [F.desc("quantity"), F.asc(item)], 2)
    return best.orderBy("sale_month", F.desc("quantity"))


def _top2_with_ties(w: Warehouse, item: str) -> DataFrame:
    """Fewer than two better items; ties stay. The same as counting better
    rows in a self-join, without building the pairs."""
    sums = _sale_months(w, item).groupBy("sale_month", item).agg(units(total("l_quantity")).alias("quantity"))
    best = best_per_key_with_ties(stage(sums, "item-months"), ["sale_month"], "quantity", 2)
    return best.orderBy("sale_month", F.desc("quantity"))


def _top2_by_sales(w: Warehouse, item: str) -> DataFrame:
    counts = _sale_months(w, item).groupBy("sale_month", item).agg(F.countDistinct("l_orderkey").alias("sales"))
    best = best_per_key(counts, ["sale_month"], [F.desc("sales"), F.asc(item)], 2)
    return best.orderBy("sale_month", F.desc("sales"))


@plan("top2_items_per_month", _top2_sql("p_partkey", "quantity", "row_number", ", p_partkey"))
def top2_items_per_month(w: Warehouse) -> DataFrame:
    return _top2(w, "p_partkey")


@plan("top2_brands_per_month", _top2_sql("p_brand", "quantity", "row_number", ", p_brand"))
def top2_brands_per_month(w: Warehouse) -> DataFrame:
    return _top2(w, "p_brand")


@plan("top2_by_theta_rank", _top2_sql("p_partkey", "quantity", "rank", ""))
def top2_by_theta_rank(w: Warehouse) -> DataFrame:
    return _top2_with_ties(w, "p_partkey")


@plan("top2_brands_by_theta_rank", _top2_sql("p_brand", "quantity", "rank", ""))
def top2_brands_by_theta_rank(w: Warehouse) -> DataFrame:
    return _top2_with_ties(w, "p_brand")


@plan("top2_items_by_sales_count", _top2_sql("p_partkey", "sales", "row_number", ", p_partkey"))
def top2_items_by_sales_count(w: Warehouse) -> DataFrame:
    return _top2_by_sales(w, "p_partkey")


@plan("top2_brands_by_sales_count", _top2_sql("p_brand", "sales", "row_number", ", p_brand"))
def top2_brands_by_sales_count(w: Warehouse) -> DataFrame:
    return _top2_by_sales(w, "p_brand")


@plan(
    "item_window_suite",
    """
    SELECT p_partkey, p_name, p_brand, CAST(p_retailprice AS DOUBLE) AS price,
           row_number() OVER (PARTITION BY left(p_name, 1) ORDER BY p_name, p_partkey) AS number_in_letter,
           count(*) OVER () AS items,
           count(*) OVER (PARTITION BY left(p_name, 1)) AS items_of_letter,
           lead(p_partkey) OVER (ORDER BY p_name, p_partkey) AS next_item,
           lag(p_partkey) OVER (ORDER BY p_name, p_partkey) AS previous_item,
           lag(p_name, 2, 'No items') OVER (ORDER BY p_name, p_partkey) AS name_two_before,
           CAST(ntile(30) OVER (ORDER BY p_size, p_partkey) AS INTEGER) AS size_group
    FROM part
    """,
)
def item_window_suite(w: Warehouse) -> DataFrame:
    return item_windows(w.part)


def item_windows(items: DataFrame, letter=None) -> DataFrame:
    """Numbering, counts, neighbours and size groups of items by name.

    Both orders are made of the key and the columns that the order needs; the
    full rows meet the places by their key at the end, so they are neither stored
    nor sorted. Item keys are unique.

    Nothing here collects the table, or the items of one letter, in a task:
    both orders are range-partitioned positions; the number within a letter is
    a difference of positions, since a letter is one run of the name order;
    neighbours come from chunks of fixed length.
    """
    first = text.first_letter(F.col("p_name")) if letter is None else letter
    names = items.select("p_partkey", "p_name", first.alias("letter"))
    by_name = with_position(names, [F.col("p_name"), F.col("p_partkey")], "place")
    by_size = with_position(items.select("p_partkey", "p_size"), [F.col("p_size"), F.col("p_partkey")], "size_place")
    # No name is a letter of its own, as it would be for a window.
    letters = by_name.groupBy(F.col("letter").alias("of_letter")).agg(
        F.count("*").alias("items_of_letter"), F.min("place").alias("letter_start")
    )
    seen = with_neighbours(
        by_name,
        "place",
        {
            "next_item": ("p_partkey", 1, None),
            "previous_item": ("p_partkey", -1, None),
            "name_two_before": ("p_name", -2, "No items"),
        },
    ).drop("p_name")
    places = seen.join(letters, F.col("letter").eqNullSafe(F.col("of_letter"))).join(
        by_size.select("p_partkey", "size_place"), "p_partkey"
    )
    whole = items.withColumn("items", items.agg(F.count("*")).scalar())
    return whole.join(places, "p_partkey").select(
        "p_partkey",
        "p_name",
        "p_brand",
        F.col("p_retailprice").alias("price"),
        (F.col("place") - F.col("letter_start") + 1).alias("number_in_letter"),
        "items",
        "items_of_letter",
        "next_item",
        "previous_item",
        "name_two_before",
        tile(F.col("size_place"), F.col("items"), 30).alias("size_group"),
    )


def _last_orders(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """``last_order``, the last by date and number, of every ``seller`` with lines.

    The greatest of a number needs one row for each supplier in memory, the greatest of a
    struct a sort of all lines; so date and number become one number. No date is before any.
    The hint keeps Spark from sending the orders to the lines instead.
    """
    time = F.coalesce(cal.micros(F.col("o_orderdate")), F.lit(-9 * 10**17))
    place = wide(time) * F.lit(Decimal(10**20)) + wide("o_orderkey") + F.lit(Decimal(2**63))
    dated = orders.select("o_orderkey", place.alias("place"))
    return (
        lines.select("l_orderkey", "l_suppkey")
        .join(dated.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("l_suppkey").alias("seller"))
        .agg(F.max_by("o_orderkey", "place").alias("last_order"))
    )


@plan(
    "last_customer_per_salesperson",
    """
    SELECT s_suppkey, s_name, c_custkey, c_name, strftime(o_orderdate, '%Y-%m-%d') AS order_day,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS deal_amount
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey
    JOIN customer ON c_custkey = o_custkey
    GROUP BY s_suppkey, s_name, c_custkey, c_name, o_orderdate, o_orderkey
    QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
    """,
)
def last_customer_per_salesperson(w: Warehouse) -> DataFrame:
    """Customer, day and amount of every supplier's latest deal.

    The number of the last order is found first, from keys and dates; only the
    lines of these orders are summed. It is stored, so that Spark knows its size.
    """
    last_order = stage(_last_orders(w.lineitem, w.orders), "last-orders")
    ended = (F.col("l_suppkey") == F.col("seller")) & (F.col("l_orderkey") == F.col("last_order"))
    deals = (
        w.lineitem.join(last_order, ended, "left_semi")
        .join(
            w.orders.join(last_order, F.col("o_orderkey") == F.col("last_order"), "left_semi"),
            F.col("l_orderkey") == F.col("o_orderkey"),
        )
        .groupBy("l_suppkey", "o_custkey", "o_orderdate", "o_orderkey")
        .agg(total("l_extendedprice").alias("amount"))
    )
    last = latest_per_key(deals, ["l_suppkey"], ["o_orderdate", "o_orderkey"])
    return (
        last.join(w.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(w.customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            "s_suppkey",
            "s_name",
            "c_custkey",
            "c_name",
            cal.iso(F.col("o_orderdate")).alias("order_day"),
            units("amount").alias("deal_amount"),
        )
        .orderBy("s_suppkey")
    )


LINE_TIES = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")

TOP2_SQL = """
    SELECT c_custkey, c_name, l_partkey, CAST({price} AS DOUBLE) AS price,
           strftime(o_orderdate, '%Y-%m-%d') AS order_day
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
    JOIN part ON p_partkey = l_partkey
    QUALIFY row_number() OVER (PARTITION BY c_custkey
        ORDER BY {price} DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) <= 2
"""


def _bought(w: Warehouse, lines: DataFrame, price: str) -> DataFrame:
    """Lines with the buyer and the day of the order."""
    return lines.join(w.orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_custkey", *LINE_TIES, price, "o_orderdate"
    )


def _dearest_two(w: Warehouse, lines: DataFrame, price: str) -> DataFrame:
    """Two dearest lines of every customer; names are joined to the survivors."""
    order = [F.desc(price), *[F.asc(c) for c in LINE_TIES]]
    found = apply_best(w.customer, _bought(w, lines, price), "c_custkey", "o_custkey", order, 2)
    return found.select(
        "c_custkey", "c_name", "l_partkey", F.col(price).alias("price"), cal.iso(F.col("o_orderdate")).alias("order_day")
    )


@plan("top2_items_per_customer", TOP2_SQL.format(price="l_extendedprice"))
def top2_items_per_customer(w: Warehouse) -> DataFrame:
    """By the price of the line, ranked within the customer."""
    order = [F.desc("l_extendedprice"), *[F.asc(c) for c in LINE_TIES]]
    best = best_per_key(_bought(w, w.lineitem, "l_extendedprice"), ["o_custkey"], order, 2)
    return best.join(w.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "c_custkey",
        "c_name",
        "l_partkey",
        F.col("l_extendedprice").alias("price"),
        cal.iso(F.col("o_orderdate")).alias("order_day"),
    )


@plan("apply_top2_sale_price", TOP2_SQL.format(price="l_extendedprice"))
def apply_top2_sale_price(w: Warehouse) -> DataFrame:
    """The lookup form: for every customer, the first two of an ordered list."""
    return _dearest_two(w, w.lineitem, "l_extendedprice")


@plan("apply_top2_list_price", TOP2_SQL.format(price="p_retailprice"))
def apply_top2_list_price(w: Warehouse) -> DataFrame:
    """The same by list price of the item."""
    lines = w.lineitem.join(w.part, F.col("l_partkey") == F.col("p_partkey")).select(*LINE_TIES, "p_retailprice")
    return _dearest_two(w, lines, "p_retailprice")
