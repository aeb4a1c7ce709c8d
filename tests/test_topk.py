import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlark.operators import topk
from ledgerlark.operators.position import tile, with_neighbours, with_position


@pytest.fixture
def prices(spark):
    data = [(1, 10, 9), (1, 11, 9), (1, 12, 9), (1, 13, 5), (2, 20, 7), (2, 21, None), (3, 30, None)]
    return spark.createDataFrame(data, "grp int, id int, price int")


def test_ties_at_the_cut(prices, rows):
    assert [r[1] for r in rows(topk.top_n_with_ties(prices, 2, "price"))] == [10, 11, 12]
    assert [r[1] for r in rows(topk.top_n_with_ties(prices, 2, "price", nullable=False))] == [10, 11, 12]
    assert topk.top_n(prices, 2, F.desc("price"), F.asc("id")).count() == 2


def test_ties_when_the_cut_is_null(prices):
    assert topk.top_n_with_ties(prices, 6, "price").count() == 7
    assert topk.top_n_with_ties(prices, 100, "price").count() == 7
    assert topk.top_n_with_ties(prices.limit(0), 3, "price").count() == 0


def test_ties_ascending(prices, rows):
    assert {r[1] for r in rows(topk.top_n_with_ties(prices, 1, "price", descending=False))} == {21, 30}


def test_rows_on_last_values(prices, rows):
    assert {r[1] for r in rows(topk.rows_on_last_values(prices, "price", 2))} == {10, 11, 12, 20}


def test_best_per_key(prices, rows):
    best = topk.best_per_key(prices, ["grp"], [F.desc("price"), F.asc("id")], 2)
    assert {r[1] for r in rows(best)} == {10, 11, 20, 21, 30}


def test_fewer_than_n_greater_rows(prices, rows):
    found = {r[1] for r in rows(topk.best_per_key_with_ties(prices, ["grp"], "price", 2))}
    data = [tuple(r) for r in prices.collect()]
    wanted = {
        i for g, i, p in data if sum(1 for h, _, q in data if h == g and q is not None and p is not None and q > p) < 2
    }
    assert found == wanted


def test_latest_per_key(spark, rows):
    deals = spark.createDataFrame(
        [(1, "2015-01-01", 5, "a"), (1, "2015-01-02", 3, "b"), (1, "2015-01-02", 4, "c"), (2, "2015-01-01", 1, "d")],
        "seller int, day string, id int, who string",
    )
    assert rows(topk.latest_per_key(deals, ["seller"], ["day", "id"])) == [
        (1, "2015-01-02", 4, "c"),
        (2, "2015-01-01", 1, "d"),
    ]


def test_pages(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    found = [tuple(r) for r in topk.page(df, 3, 50, "v", "id").collect()]
    assert found == sorted(((i, i % 7) for i in range(1000)), key=lambda r: (r[1], r[0]))[100:150]
    with pytest.raises(ValueError):
        topk.page(df, 0, 50, "v", "id")


def test_position_and_neighbours(spark):
    random.seed(3)
    # One name holds a third of the rows.
    names = ["hot"] * 400 + [f"n{random.randrange(300)}" for _ in range(800)]
    items = [(i, name, random.randrange(40)) for i, name in enumerate(names)]
    random.shuffle(items)
    df = spark.createDataFrame(items, "id int, name string, size int").repartition(5)
    placed = with_position(df, [F.col("name"), F.col("id")], "place")
    seen = with_neighbours(
        placed,
        "place",
        {"next": ("id", 1, None), "previous": ("id", -1, None), "two_before": ("name", -2, "none")},
        chunk_rows=97,
    )
    order = Window.orderBy("name", "id")
    wanted = df.select(
        "id",
        F.row_number().over(order).alias("place"),
        F.lead("id").over(order).alias("next"),
        F.lag("id").over(order).alias("previous"),
        F.lag("name", 2, "none").over(order).alias("two_before"),
    )
    columns = wanted.columns
    assert sorted(map(tuple, seen.select(columns).collect())) == sorted(map(tuple, wanted.collect()))


@pytest.mark.parametrize(("count", "tiles"), [(1, 30), (29, 30), (30, 30), (31, 30), (100, 30), (7, 3)])
def test_tile_is_ntile(spark, count, tiles):
    df = spark.range(1, count + 1).withColumn("n", F.ntile(tiles).over(Window.orderBy("id")))
    got = df.withColumn("t", tile(F.col("id"), F.lit(count), tiles))
    assert got.filter("n <> t").count() == 0


def test_item_windows_without_a_name(spark):
    from ledgerlark.plans.windows import item_windows

    data = [(1, None, "b", 3, 1.0), (2, "Apple", "b", 1, 1.0), (3, "ant", "b", 2, 1.0), (4, "Axe", "b", 2, 1.0)]
    items = spark.createDataFrame(data, "p_partkey int, p_name string, p_brand string, p_size int, p_retailprice double")
    got = {r.p_partkey: r for r in item_windows(items).collect()}
    assert len(got) == 4
    assert [got[k].number_in_letter for k in (1, 2, 4, 3)] == [1, 1, 2, 1]
    assert got[1].previous_item is None and got[3].next_item is None
    assert got[4].name_two_before is None and got[2].name_two_before == "No items"
    assert [got[k].size_group for k in (2, 3, 4, 1)] == [1, 2, 3, 4]
