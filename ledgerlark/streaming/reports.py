"""Customers ask for a report on a period; a stream answers every request once.

A request is an XML text in a parquet folder. The stream parses it, counts the
customer's orders in the period and appends the answer to the report table.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlark.functions.documents import nested, xml_struct, xml_text
from ledgerlark.operators.lookups import counts_in_periods

REQUEST_COLUMNS = "request_id string, body string"

REPORT_COLUMNS = (
    "request_id string, report_xml string, report_time timestamp, customer_id bigint, "
    "first_day date, last_day date, orders_in_invoices bigint, orders_quantity bigint"
)

RECEIVED_COLUMNS = (
    "request_id string, body string, customer_id bigint, first_day date, last_day date, is_valid boolean"
)

# Message texts.
REQUEST_TEXT = "Требуется отчёт по данному клиенту за указанный период"
REPORT_TEXT = "Отчёт о количестве заказов данного клиента за указанный период"

REQUEST_SHAPE = "Message string, CustomerID bigint, Period struct<From_this_date: date, To_this_date: date>"
RESPONSE_SHAPE = (
    "Message string, CustomerID bigint, OrdersInInvoices bigint, OrdersQuantity bigint, "
    "Period struct<From_this_date: date, To_this_date: date>"
)


def request_messages(spans: DataFrame, invoices: DataFrame) -> DataFrame:
    """XML requests for those (request_id, customer_id, first_day, last_day)
    whose customer has an invoice."""
    wanted = spans.join(invoices.select("customer_id").distinct(), "customer_id", "left_semi")
    element = nested(
        {
            "Message": F.lit(REQUEST_TEXT),
            "CustomerID": F.col("customer_id"),
            "Period/From_this_date": F.col("first_day"),
            "Period/To_this_date": F.col("last_day"),
        }
    )
    return wanted.select("request_id", xml_text(element, "RequestMessage").alias("body"))


def read_requests(messages: DataFrame) -> DataFrame:
    """Messages with their parsed fields; ``is_valid`` is false where a
    customer or a day is missing or the text is no request."""
    fields = messages.withColumn("__m", xml_struct(F.col("body"), REQUEST_SHAPE)).select(
        "request_id",
        "body",
        F.col("__m.CustomerID").alias("customer_id"),
        F.col("__m.Period.From_this_date").alias("first_day"),
        F.col("__m.Period.To_this_date").alias("last_day"),
    )
    complete = (
        F.col("body").rlike(r"^\s*(<\?xml[^>]*>\s*)?<RequestMessage[\s>]")
        & F.col("request_id").isNotNull()
        & F.col("customer_id").isNotNull()
        & F.col("first_day").isNotNull()
        & F.col("last_day").isNotNull()
    )
    return fields.withColumn("is_valid", F.coalesce(complete, F.lit(False)))


def period_reports(requests: DataFrame, activity: DataFrame) -> DataFrame:
    """Both counts for every request.

    ``activity`` has customer_id, day and the summable measures
    orders_in_invoices and orders_quantity.
    """
    counted = counts_in_periods(
        requests, activity, "customer_id", "day", "first_day", "last_day", ["orders_in_invoices", "orders_quantity"]
    )
    return requests.join(counted, ["customer_id", "first_day", "last_day"])


def response_text() -> Column:
    return xml_text(
        nested(
            {
                "Message": F.lit(REPORT_TEXT),
                "CustomerID": F.col("customer_id"),
                "OrdersInInvoices": F.col("orders_in_invoices"),
                "OrdersQuantity": F.col("orders_quantity"),
                "Period/From_this_date": F.col("first_day"),
                "Period/To_this_date": F.col("last_day"),
            }
        ),
        "ResponseMessage",
    )


def pending(requests: DataFrame, reports: DataFrame) -> DataFrame:
    """Requests that have no report yet."""
    return requests.join(reports.select("request_id"), "request_id", "left_anti")


def reports_table(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(REPORT_COLUMNS + ", batch_id bigint").parquet(os.path.join(folder, "reports"))


def received_table(spark: SparkSession, folder: str) -> DataFrame:
    """All messages with their parsed fields; those with a false ``is_valid``
    were set aside."""
    return spark.read.schema(RECEIVED_COLUMNS + ", batch_id bigint").parquet(os.path.join(folder, "received"))


ORDER_COLUMNS = "order_id bigint, customer_id bigint, day date, is_invoiced boolean"

ACTIVITY_COLUMNS = "customer_id bigint, day date, orders_in_invoices bigint, orders_quantity bigint"


def keep_activity(
    spark: SparkSession, orders_folder: str, out_folder: str, available_now: bool = True, every: str = "10 seconds",
    files_per_batch: int = 1000, horizon: str = "90 days",
) -> StreamingQuery:
    """Start the stream that keeps daily sums of the orders that arrive.

    Every micro-batch adds its sums as a folder of its own, which it replaces if it is
    run again. An order that arrives twice within ``horizon`` counts once.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        sums = batch.groupBy("customer_id", "day").agg(
            F.count_if("is_invoiced").alias("orders_in_invoices"), F.count("*").alias("orders_quantity")
        )
        sums.write.mode("overwrite").parquet(os.path.join(out_folder, "activity", f"batch_id={batch_id}"))

    arriving = spark.readStream.schema(ORDER_COLUMNS).option("maxFilesPerTrigger", files_per_batch).parquet(orders_folder)
    stream = (
        arriving.withColumn("arrived", F.current_timestamp())
        .withWatermark("arrived", horizon)
        .dropDuplicatesWithinWatermark(["order_id"])
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", os.path.join(out_folder, "progress"))
    )
    trigger = stream.trigger(availableNow=True) if available_now else stream.trigger(processingTime=every)
    return trigger.start()


def activity_now(spark: SparkSession, folder: str) -> DataFrame:
    """Daily sums of all orders that have arrived by now. Each call lists the folder anew."""
    added = spark.read.schema(ACTIVITY_COLUMNS + ", batch_id bigint").parquet(os.path.join(folder, "activity"))
    return added.groupBy("customer_id", "day").agg(
        F.sum("orders_in_invoices").alias("orders_in_invoices"), F.sum("orders_quantity").alias("orders_quantity")
    )


def answer_requests(
    requests_folder: str, activity: DataFrame | Callable[[], DataFrame], out_folder: str, now: Column | None = None, available_now: bool = True,
    every: str = "10 seconds", files_per_batch: int = 1000, horizon: str = "90 days",
) -> StreamingQuery:
    """Start the stream that answers requests as their files arrive.

    A valid request that repeats an id within ``horizon`` of its first arrival
    is dropped by the stream's state, which holds the ids of that time and no
    more; earlier answers are not read. Every micro-batch replaces its own
    ``batch_id`` folders, so a batch that is run again after a failure leaves
    one copy. Messages that are no valid request are kept, but not answered.
    A batch reads ``activity`` for the days it asks for, so give a stored table
    of daily sums. A table is read as it was when the stream started; a function,
    such as one that calls ``activity_now``, is called by every batch, so its answers
    count what has arrived by then. An id that comes back after ``horizon`` is answered again.
    """
    current = activity if callable(activity) else lambda: activity
    spark = current().sparkSession
    clock = F.current_timestamp() if now is None else now

    def store(batch: DataFrame, batch_id: int) -> None:
        own = f"batch_id={batch_id}"
        received = os.path.join(out_folder, "received", own)
        batch.drop("arrived", "once").write.mode("overwrite").parquet(received)
        # A stream plans without adaptive execution; the stored batch is read
        # with the outer session, which has it.
        requests = spark.read.schema(RECEIVED_COLUMNS).parquet(received).filter("is_valid").drop("is_valid", "body")
        (
            period_reports(requests, current())
            .select(
                "request_id",
                response_text().alias("report_xml"),
                clock.cast("timestamp").alias("report_time"),
                "customer_id",
                "first_day",
                "last_day",
                "orders_in_invoices",
                "orders_quantity",
            )
            .write.mode("overwrite")
            .parquet(os.path.join(out_folder, "reports", own))
        )

    arriving = spark.readStream.schema(REQUEST_COLUMNS).option("maxFilesPerTrigger", files_per_batch)
    # A message that is no request is one of a kind by its id and text.
    once = F.when(F.col("is_valid"), F.concat(F.lit("id:"), "request_id")).otherwise(
        F.sha2(F.concat_ws(":", F.coalesce("request_id", F.lit("")), F.coalesce("body", F.lit(""))), 256)
    )
    stream = (
        read_requests(arriving.parquet(requests_folder))
        .withColumn("once", once)
        .withColumn("arrived", F.current_timestamp())
        .withWatermark("arrived", horizon)
        .dropDuplicatesWithinWatermark(["once"])
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", os.path.join(out_folder, "progress"))
    )
    trigger = stream.trigger(availableNow=True) if available_now else stream.trigger(processingTime=every)
    return trigger.start()
