import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlark.functions import calendar as cal
from ledgerlark.operators import months


@pytest.fixture
def sales(spark):
    data = [(dt.date(2015, 1, 5), 1, 10), (dt.date(2015, 3, 1), 1, 5), (dt.date(2015, 3, 9), 2, 7), (dt.date(2017, 12, 31), 2, 1), (None, 1, 1)]
    return spark.createDataFrame(data, "day date, item int, qty int")


def test_calendar_has_full_years_only(sales, rows):
    found = rows(months.month_calendar(sales, "day"))
    assert len(found) == 24 and {r[0] for r in found} == {2015, 2017}


def test_zero_fill(sales, rows):
    sums = sales.groupBy(F.year("day").alias("year"), F.month("day").alias("month")).agg(F.sum("qty").alias("qty"))
    filled = months.zero_filled(months.month_calendar(sales, "day"), sums, ["year", "month"], {"qty": 0})
    got = {(r.year, r.month): r.qty for r in filled.collect()}
    assert len(got) == 24 and got[(2015, 3)] == 12 and got[(2015, 2)] == 0


def test_item_months(spark, sales):
    items = spark.createDataFrame([(1,), (2,), (3,)], "item int")
    sums = sales.groupBy("item", F.year("day").alias("year"), F.month("day").alias("month")).agg(F.sum("qty").alias("qty"))
    rows = months.item_months(items, sums, "item", sales, "day", ["qty"]).collect()
    got = {(r.item, r.year, r.month): r.qty for r in rows}
    assert len(rows) == len(got) == 3 * 24
    assert {key: qty for key, qty in got.items() if qty is not None} == {
        (1, 2015, 1): 10, (1, 2015, 3): 5, (2, 2015, 3): 7, (2, 2017, 12): 1,
    }


def test_running_totals_in_hundredths(sales):
    totals = months.running_month_totals(sales.filter("day is not null"), cal.month_number(F.col("day")), "qty")
    assert {r.month_number: r.running_total for r in totals.collect()} == {201501: 1000, 201503: 2200, 201712: 2300}
