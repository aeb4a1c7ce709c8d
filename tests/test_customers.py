import datetime as dt

import pytest

from ledgerlark.plans import customers
from ledgerlark.tables import Warehouse


@pytest.fixture(scope="module")
def warehouse(spark):
    return Warehouse(spark, "/root/testdata/sf0.001")


def test_one_customer_total(warehouse):
    every = {r.c_custkey: r.total for r in customers.purchase_sum_checked(warehouse).collect()}
    for key in list(every)[:2]:
        assert float(customers.purchase_sum(warehouse, key).head().total) == every[key]


def test_unknown_customer(warehouse):
    with pytest.raises(customers.UnknownCustomer):
        customers.purchase_sum(warehouse, -1)


def test_customer_without_orders(spark):
    people = spark.createDataFrame([(1, "busy"), (2, "idle")], "c_custkey long, c_name string")
    orders = spark.createDataFrame(
        [(10, 1, dt.datetime(2015, 1, 1)), (11, 1, dt.datetime(2015, 1, 1)), (12, 1, dt.datetime(2014, 1, 1))],
        "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz",
    )
    kept = sorted((r.c_custkey, r.o_orderkey or 0) for r in customers.last_orders(people, orders, 2).collect())
    assert kept == [(1, 10), (1, 11), (2, 0)]
    assert customers.last_orders(people, orders, 2, keep_idle=False).count() == 2
