import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import pivots
from ledgerlark.plans.pivots import month_counts


@pytest.fixture
def counts(spark):
    jan, feb, mar = (dt.date(2013, m, 1) for m in (1, 2, 3))
    data = [(jan, "a", 3), (jan, "b", 1), (feb, "a", 2), (mar, "other", 5), (feb, "a", 1)]
    return spark.createDataFrame(data, "month_start date, label string, orders long")


def test_empty_cells_are_zero_and_other_rows_stay(counts, rows):
    wide = pivots.count_pivot(counts, "month_start", "label", ["b", "a"], "orders")
    assert wide.columns == ["month_start", "b", "a"]
    assert [r[1:] for r in rows(wide)] == [(1, 3), (0, 3), (0, 0)]


def test_names_with_special_characters(spark, rows):
    df = spark.createDataFrame([(1, "a.b `c`", 2)], "m int, label string, n long")
    assert rows(pivots.count_pivot(df, "m", "label", ["a.b `c`", "x, y"], "n")) == [(1, 2, 0)]


def test_column_list(counts):
    assert pivots.pivot_columns(counts, "label") == ["a", "b", "other"]
    with pytest.raises(pivots.NoPivotColumns):
        pivots.pivot_columns(counts.limit(0), "label")


def test_too_many_columns_are_refused(spark):
    names = spark.range(6).withColumn("n", F.col("id").cast("string"))
    assert len(pivots.pivot_columns(names, "n", limit=6)) == 6
    with pytest.raises(ValueError):
        pivots.pivot_columns(names, "n", limit=5)


def test_all_customers_and_buyers_differ(spark):
    customers = spark.createDataFrame([(1, "a"), (2, "b"), (3, "idle")], "c_custkey long, name string")
    orders = spark.createDataFrame(
        [(10, 1, dt.datetime(2015, 1, 5)), (11, 1, dt.datetime(2015, 1, 9)), (12, 2, dt.datetime(2015, 2, 1))],
        "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz",
    )
    counted = month_counts(orders, customers, F.col("name"))
    assert pivots.pivot_columns(customers, "name") == ["a", "b", "idle"]
    assert pivots.pivot_columns(counted, "label") == ["a", "b"]
    wide = pivots.count_pivot(counted, "month_start", "label", ["a", "b", "idle"], "orders")
    assert sorted(tuple(r)[1:] for r in wide.collect()) == [(0, 1, 0), (2, 0, 0)]


def test_unpivot_drops_missing_cells(spark, rows):
    df = spark.createDataFrame(
        [("x", "Shop 38", None, "PO Box", None), ("y", None, None, None, None)],
        "name string, a1 string, a2 string, a3 string, a4 string",
    )
    long = pivots.unpivot_known(df, ["name"], ["a1", "a2", "a3", "a4"], "kind", "line")
    assert rows(long) == [("x", "a1", "Shop 38"), ("x", "a3", "PO Box")]
