import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlark.streaming import reports

D = dt.date
NOW = "2024-05-05 10:00:00"


@pytest.fixture
def activity(spark):
    return spark.createDataFrame(
        [(1, D(2015, 1, 1), 1, 2), (1, D(2015, 1, 31), 1, 1), (1, D(2015, 2, 1), 3, 3), (2, D(2015, 1, 1), 1, 1)],
        "customer_id long, day date, orders_in_invoices long, orders_quantity long",
    )


def spans(spark, *data):
    return spark.createDataFrame(list(data), "request_id string, customer_id long, first_day date, last_day date")


def messages(spark, activity, *data):
    return reports.request_messages(spans(spark, *data), activity)


def run(activity, inbox, outbox):
    reports.answer_requests(inbox, activity, outbox, now=F.lit(NOW)).awaitTermination()


def counts(spark, outbox):
    return {
        r.request_id: (r.customer_id, r.orders_in_invoices, r.orders_quantity)
        for r in reports.reports_table(spark, outbox).collect()
    }


JANUARY = (D(2015, 1, 1), D(2015, 1, 31))


def test_only_customers_with_invoices_are_asked(spark, activity):
    sent = messages(spark, activity, ("a", 1, *JANUARY), ("b", 77, *JANUARY))
    assert [r.request_id for r in sent.collect()] == ["a"]
    assert "<From_this_date>2015-01-01</From_this_date>" in sent.head().body


def test_every_request_is_answered_once(spark, activity, tmp_path):
    inbox, outbox = str(tmp_path / "in"), str(tmp_path / "out")
    first = messages(spark, activity, ("a", 1, *JANUARY), ("quiet", 2, D(2016, 1, 1), D(2016, 2, 1)))
    first.union(first.filter("request_id = 'a'")).write.parquet(inbox)
    run(activity, inbox, outbox)
    assert counts(spark, outbox) == {"a": (1, 2, 3), "quiet": (2, 0, 0)}

    # A second delivery repeats one request and brings a new one.
    messages(spark, activity, ("a", 1, *JANUARY), ("late", 1, D(2015, 2, 1), D(2015, 2, 1))).write.mode("append").parquet(inbox)
    run(activity, inbox, outbox)
    table = reports.reports_table(spark, outbox)
    assert table.count() == 3 and counts(spark, outbox)["late"] == (1, 3, 3)
    row = table.filter("request_id = 'late'").head()
    assert "<OrdersInInvoices>3</OrdersInInvoices>" in row.report_xml
    assert row.report_time is not None

    # Nothing new: nothing happens.
    run(activity, inbox, outbox)
    assert reports.reports_table(spark, outbox).count() == 3


def test_bad_messages_are_set_aside(spark, activity, tmp_path):
    inbox, outbox = str(tmp_path / "in"), str(tmp_path / "out")
    good = messages(spark, activity, ("ok", 1, *JANUARY))
    body = good.head().body
    bad = spark.createDataFrame(
        [
            ("broken", "<RequestMessage><CustomerID>1"),
            ("empty", None),
            ("no customer", body.replace("<CustomerID>1</CustomerID>", "")),
            ("wrong kind", body.replace("RequestMessage", "ResponseMessage")),
            (None, body),
        ],
        reports.REQUEST_COLUMNS,
    )
    good.union(bad).write.parquet(inbox)
    run(activity, inbox, outbox)
    assert counts(spark, outbox) == {"ok": (1, 2, 3)}
    assert reports.received_table(spark, outbox).filter("not is_valid").count() == 5


def test_pending(spark):
    asked = spans(spark, ("a", 1, *JANUARY), ("b", 2, *JANUARY))
    done = spans(spark, ("a", 1, *JANUARY))
    assert [r.request_id for r in reports.pending(asked, done).collect()] == ["b"]


def test_many_requests_of_one_customer(spark, activity):
    asked = spans(spark, *[(f"r{i}", 1, D(2015, 1, 1 + i % 28), D(2015, 2, 1)) for i in range(300)])
    got = reports.period_reports(asked, activity)
    assert got.count() == 300
    assert {(r.first_day.day == 1, r.orders_quantity) for r in got.collect()} == {(True, 6), (False, 4)}


def test_running_stream_picks_up_arrivals(spark, activity, tmp_path):
    inbox, outbox = str(tmp_path / "in"), str(tmp_path / "out")
    messages(spark, activity, ("a", 1, *JANUARY)).write.parquet(inbox)
    query = reports.answer_requests(inbox, activity, outbox, now=F.lit(NOW), available_now=False, every="100 milliseconds")
    try:
        query.processAllAvailable()
        messages(spark, activity, ("b", 2, *JANUARY)).write.mode("append").parquet(inbox)
        query.processAllAvailable()
    finally:
        query.stop()
    assert counts(spark, outbox) == {"a": (1, 2, 3), "b": (2, 1, 1)}


def test_batch_that_runs_again_leaves_one_copy(spark, activity, tmp_path):
    """The second run is made to repeat the last batch: its commit is lost."""
    inbox, outbox = str(tmp_path / "in"), str(tmp_path / "out")
    messages(spark, activity, ("a", 1, *JANUARY), ("b", 2, *JANUARY)).write.parquet(inbox)
    run(activity, inbox, outbox)
    commits = tmp_path / "out" / "progress" / "commits"
    for file in commits.iterdir():
        if file.name in ("0", ".0.crc"):
            file.unlink()
    run(activity, inbox, outbox)
    assert reports.reports_table(spark, outbox).count() == 2


def orders(spark, *data):
    return spark.createDataFrame(list(data), reports.ORDER_COLUMNS)


def test_answers_count_orders_that_arrive_between_batches(spark, tmp_path):
    into, kept = str(tmp_path / "orders"), str(tmp_path / "kept")
    inbox, outbox = str(tmp_path / "in"), str(tmp_path / "out")
    known = spark.createDataFrame([(1,), (2,)], "customer_id long")

    def ask(*data):
        reports.request_messages(spans(spark, *data), known).write.mode("append").parquet(inbox)
        live = lambda: reports.activity_now(spark, kept)
        reports.answer_requests(inbox, live, outbox, now=F.lit(NOW)).awaitTermination()

    first = [(10, 1, D(2015, 1, 2), True), (11, 1, D(2015, 1, 2), False), (12, 2, D(2015, 3, 1), True)]
    orders(spark, *first).write.parquet(into)
    reports.keep_activity(spark, into, kept).awaitTermination()
    ask(("a", 1, *JANUARY))
    # One order comes again, two are new.
    orders(spark, first[0], (13, 1, D(2015, 1, 2), True), (14, 1, D(2015, 1, 31), True)).write.mode("append").parquet(into)
    reports.keep_activity(spark, into, kept).awaitTermination()
    ask(("b", 1, *JANUARY), ("a", 1, *JANUARY))
    assert counts(spark, outbox) == {"a": (1, 1, 2), "b": (1, 3, 4)}
