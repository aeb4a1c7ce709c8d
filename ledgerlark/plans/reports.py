"""Requests for customer reports and their answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions import calendar as cal
from ledgerlark.plans.registry import plan
from ledgerlark.session import scratch, stage
from ledgerlark.streaming import reports
from ledgerlark.tables import Warehouse


def date_spans(w: Warehouse) -> DataFrame:
    """First and last order day of every customer with orders."""
    day = F.to_date("o_orderdate")
    return w.orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day")
    )


SPAN_SQL = """
    SELECT o_custkey AS customer_id, CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day
    FROM orders GROUP BY o_custkey
"""


@plan(
    "customer_date_span",
    f"""
    SELECT customer_id, strftime(first_day, '%Y-%m-%d') AS first_day, strftime(last_day, '%Y-%m-%d') AS last_day
    FROM ({SPAN_SQL})
    """,
)
def customer_date_span(w: Warehouse) -> DataFrame:
    return date_spans(w).withColumns({name: cal.iso(F.col(name)) for name in ("first_day", "last_day")})


def activity(w: Warehouse) -> DataFrame:
    """Per customer and day: orders, and orders that were invoiced.

    An order counts as invoiced once it has lines; its lines are reduced to
    one row before the join, so every order counts once.
    """
    invoiced = w.lineitem.select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("invoiced", F.lit(1))
    return (
        w.orders.join(invoiced, "o_orderkey", "left")
        .groupBy(F.col("o_custkey").alias("customer_id"), F.to_date("o_orderdate").alias("day"))
        .agg(
            F.count("invoiced").alias("orders_in_invoices"),
            F.count("o_orderkey").alias("orders_quantity"),
        )
    )


def requests(w: Warehouse) -> DataFrame:
    """One request per customer: from the first order to the last."""
    name = F.concat(F.lit("R"), F.col("customer_id").cast("string")).alias("request_id")
    return date_spans(w).select(name, "customer_id", "first_day", "last_day")


def invoices(w: Warehouse) -> DataFrame:
    return w.orders.select(F.col("o_custkey").alias("customer_id"))


REQUEST_SQL = f"""
    SELECT 'R' || customer_id AS request_id, customer_id, first_day, last_day FROM ({SPAN_SQL})
"""


@plan(
    "report_xml_message",
    f"""
    SELECT request_id, customer_id, strftime(first_day, '%Y-%m-%d') AS first_day,
           strftime(last_day, '%Y-%m-%d') AS last_day, true AS is_valid FROM ({REQUEST_SQL})
    """,
)
def report_xml_message(w: Warehouse) -> DataFrame:
    """Requests written as XML and read again."""
    messages = reports.request_messages(requests(w), invoices(w))
    return reports.read_requests(messages).select(
        "request_id",
        "customer_id",
        cal.iso(F.col("first_day")).alias("first_day"),
        cal.iso(F.col("last_day")).alias("last_day"),
        "is_valid",
    )


@plan(
    "customer_period_report",
    f"""
    SELECT request_id, customer_id, strftime(first_day, '%Y-%m-%d') AS first_day,
           strftime(last_day, '%Y-%m-%d') AS last_day,
           count(DISTINCT l_orderkey) AS orders_in_invoices, count(DISTINCT o_orderkey) AS orders_quantity
    FROM ({REQUEST_SQL})
    LEFT JOIN orders ON o_custkey = customer_id AND CAST(o_orderdate AS DATE) BETWEEN first_day AND last_day
    LEFT JOIN lineitem ON l_orderkey = o_orderkey
    GROUP BY ALL
    """,
)
def customer_period_report(w: Warehouse) -> DataFrame:
    """The stream, run over all waiting requests, and the stored answers read
    back out of their XML."""
    inbox, outbox = scratch(w.spark, "requests"), scratch(w.spark, "answers")
    reports.request_messages(requests(w), invoices(w)).write.parquet(inbox)
    reports.answer_requests(inbox, stage(activity(w), "activity"), outbox).awaitTermination()
    answers = reports.reports_table(w.spark, outbox)
    fields = F.from_xml("report_xml", reports.RESPONSE_SHAPE)
    return answers.select("request_id", fields.alias("m")).select(
        "request_id",
        F.col("m.CustomerID").alias("customer_id"),
        cal.iso(F.col("m.Period.From_this_date")).alias("first_day"),
        cal.iso(F.col("m.Period.To_this_date")).alias("last_day"),
        F.col("m.OrdersInInvoices").alias("orders_in_invoices"),
        F.col("m.OrdersQuantity").alias("orders_quantity"),
    )


@plan(
    "customer_period_report_live",
    f"""
    SELECT request_id, customer_id, strftime(first_day, '%Y-%m-%d') AS first_day,
           strftime(last_day, '%Y-%m-%d') AS last_day,
           count(DISTINCT l_orderkey) AS orders_in_invoices, count(DISTINCT o_orderkey) AS orders_quantity
    FROM ({REQUEST_SQL})
    LEFT JOIN orders ON o_custkey = customer_id AND CAST(o_orderdate AS DATE) BETWEEN first_day AND last_day
                        AND (customer_id % 2 = 1 OR o_orderkey % 2 = 0)
    LEFT JOIN lineitem ON l_orderkey = o_orderkey
    GROUP BY ALL
    """,
)
def customer_period_report_live(w: Warehouse) -> DataFrame:
    """Answers from orders that arrive while requests are answered.

    First the even orders arrive and the even customers ask, then the others. Both
    streams stop and go on in between; the second answers count all orders.
    """
    orders_in, orders_out = scratch(w.spark, "orders-in"), scratch(w.spark, "orders-out")
    inbox, outbox = scratch(w.spark, "requests"), scratch(w.spark, "answers")
    lines = w.lineitem.select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("is_invoiced", F.lit(True))
    arriving = w.orders.join(lines, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("day"),
        F.coalesce("is_invoiced", F.lit(False)).alias("is_invoiced"),
    )
    for turn in (0, 1):
        arriving.filter(F.col("order_id") % 2 == turn).write.mode("append").parquet(orders_in)
        reports.keep_activity(w.spark, orders_in, orders_out).awaitTermination()
        asking = requests(w).filter(F.col("customer_id") % 2 == turn)
        reports.request_messages(asking, invoices(w)).write.mode("append").parquet(inbox)
        reports.answer_requests(inbox, lambda: reports.activity_now(w.spark, orders_out), outbox).awaitTermination()
    answers = reports.reports_table(w.spark, outbox)
    return answers.select(
        "request_id",
        "customer_id",
        cal.iso(F.col("first_day")).alias("first_day"),
        cal.iso(F.col("last_day")).alias("last_day"),
        "orders_in_invoices",
        "orders_quantity",
    )


@plan(
    "pending_requests",
    f"SELECT request_id, customer_id FROM ({REQUEST_SQL}) WHERE customer_id % 4 = 0",
)
def pending_requests(w: Warehouse) -> DataFrame:
    """Requests that wait: sent, but without a stored report.

    The stream runs once; requests of every fourth customer arrive after it.
    """
    inbox, outbox = scratch(w.spark, "requests"), scratch(w.spark, "answers")
    late = F.col("customer_id") % 4 == 0
    reports.request_messages(requests(w).filter(~late), invoices(w)).write.parquet(inbox)
    reports.answer_requests(inbox, stage(activity(w), "activity"), outbox).awaitTermination()
    reports.request_messages(requests(w).filter(late), invoices(w)).write.mode("append").parquet(inbox)
    sent = reports.read_requests(w.spark.read.schema(reports.REQUEST_COLUMNS).parquet(inbox)).filter("is_valid")
    return reports.pending(sent, reports.reports_table(w.spark, outbox)).select("request_id", "customer_id")
