"""The last order of every supplier, found from one number of date and key."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlark.functions import calendar as cal
from ledgerlark.plans.registry import REGISTRY
from ledgerlark.plans.windows import _last_orders
from ledgerlark.tables import SCHEMAS

DAY = dt.datetime(1997, 7, 4)
ORDERS = [
    (1, 10, DAY), (2, 11, DAY), (-3, 10, DAY), (4, 10, None), (5, 10, DAY + dt.timedelta(microseconds=1)),
    (6, 12, DAY - dt.timedelta(days=20_000)), (7, 10, DAY), (7, 11, DAY - dt.timedelta(days=1)), (2**62, 11, None),
]
# Order, supplier, price.
LINES = [
    (1, 100, 1.5), (2, 100, 2.25), (2, 100, 1.0), (-3, 100, 9.0),
    (4, 101, 3.0), (2**62, 101, 4.0), (6, 102, 5.0), (4, 102, 6.0), (5, 103, 7.0), (7, 103, 8.0),
    (7, 104, 1.25), (7, 104, None), (99, 105, 1.0), (1, None, 1.0), (None, 100, 1.0), (-3, 106, None),
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("deals"))
    names = [(n,) for n in (10, 11)]
    values = {
        "orders": ("o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz", ORDERS),
        "lineitem": ("l_orderkey bigint, l_suppkey bigint, l_extendedprice double", LINES),
        "customer": ("c_custkey bigint", names),
        "supplier": ("s_suppkey bigint", [(n,) for n in range(100, 107)]),
    }
    for name, (schema, rows) in values.items():
        table = spark.createDataFrame(rows, schema)
        for field in SCHEMAS[name].split(", "):
            column, kind = field.split(" ")
            if column not in table.columns:
                table = table.withColumn(column, F.lit("n" if kind == "string" else None).cast(kind))
        table.write.parquet(f"{out}/{name}.parquet")
    return out


def test_last_deals(spark, rows, folder):
    found = REGISTRY["last_customer_per_salesperson"].run(spark, folder).select("s_suppkey", "c_custkey", "order_day", "deal_amount")
    assert rows(found) == [
        (100, 11, "1997-07-04", 3.25),
        (101, 11, None, 4.0),
        (103, 10, "1997-07-04", 7.0),
        (104, 10, "1997-07-04", 1.25),
        (106, 10, "1997-07-04", None),
    ]


def test_no_sort_by_supplier_and_no_group_for_every_deal(spark):
    """All lines were grouped by deal and sorted by supplier, in the tasks that had sorted them for the join."""
    lines = spark.createDataFrame([(1, 2)], "l_orderkey bigint, l_suppkey bigint")
    orders = spark.createDataFrame([(1, DAY)], "o_orderkey bigint, o_orderdate timestamp_ntz")
    plan = _last_orders(lines, orders)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("HashAggregate(") == 2 and plan.count("Sort [") == 2


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/New_York"])
def test_micros(spark, zone):
    """Also in hours that a zone skips or has twice, and before 1970."""
    known = [
        dt.datetime(2024, 3, 31, 2, 30), dt.datetime(2024, 3, 31, 3, 30), dt.datetime(2024, 10, 27, 2, 30),
        dt.datetime(2024, 3, 10, 2, 30), dt.datetime(1969, 12, 31, 23, 59, 59, 999_999), dt.datetime(1, 1, 1), dt.datetime(9999, 12, 31, 23, 0, 0, 1),
    ]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        found = spark.createDataFrame([(t,) for t in known], "t timestamp_ntz").select("t", cal.micros(F.col("t")).alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert {r.t: r.n for r in found} == {t: (t - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1) for t in known}
