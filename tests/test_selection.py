"""Rows at places of an order, and running sums, against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import selection
from ledgerlark.operators.running import running_sums, with_running_sum
from ledgerlark.operators.selection import Key, rows_at


@pytest.fixture
def few(monkeypatch):
    monkeypatch.setattr(selection, "SAMPLE", 60)
    monkeypatch.setattr(selection, "SORTED_ROWS", 40)


def test_rows_at_every_depth(spark, few):
    draw = random.Random(4)
    names = ["hot"] * 500 + [f"n{draw.randrange(200)}" for _ in range(900)] + [None] * 100
    days = [dt.datetime(2020, 1, 1) + dt.timedelta(hours=draw.randrange(500)) for _ in names]
    data = [(i, n, d, draw.random() if i % 9 else None) for i, (n, d) in enumerate(zip(names, days, strict=True))]
    draw.shuffle(data)
    df = spark.createDataFrame(data, "id int, name string, at timestamp_ntz, v double").repartition(5)
    orders = {
        ("name", "at", "id"): lambda r: (r[1] is not None, r[1] or "", r[2], r[0]),
        (Key("v", True), "id"): lambda r: (r[3] is None, -(r[3] or 0), r[0]),
        ("at", Key("id", True)): lambda r: (r[2], -r[0]),
    }
    for order, key in orders.items():
        wanted = sorted(data, key=key)
        for skip, size in ((0, 5), (3, 1), (620, 100), (1495, 20), (1600, 5)):
            assert [tuple(r) for r in rows_at(df, skip, size, *order).collect()] == wanted[skip : skip + size]


def test_rows_at_stores_and_moves_nothing_wide(spark, few, monkeypatch):
    import ledgerlark.session as session

    def refuse(*_):
        raise AssertionError("a step was stored")

    monkeypatch.setattr(session, "stage", refuse)
    df = spark.range(3000).withColumn("wide", F.lit("x"))
    found = rows_at(df, 1500, 10, Key("id", True))
    assert [r.id for r in found.collect()] == list(range(1499, 1489, -1))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_many_ties(spark, few):
    df = spark.range(500).select(F.lit(1).alias("v"), "id")
    assert rows_at(df, 100, 50, "v").count() == 50
    assert rows_at(df.limit(0), 0, 5, "v").count() == 0


def brute(data, keys, order):
    found = []
    key = lambda r, cs: tuple((r[c] is not None, r[c] if r[c] is not None else 0) for c in cs)
    for r in data:
        total = sum(o["x"] for o in data if key(o, keys) == key(r, keys) and key(o, order) <= key(r, order))
        found.append((r["id"], total))
    return sorted(found)


@pytest.mark.parametrize("ranges", [3, 30])
@pytest.mark.parametrize("keys", [[], ["k"], ["k", "j"]])
def test_running_sums(spark, ranges, keys):
    draw = random.Random(ranges)
    data = [
        {"id": i, "k": draw.choice([1, 1, 1, 2, None]), "j": draw.choice(["a", "b"]), "t": draw.choice([None, *range(30)]),
         "x": draw.randrange(-50, 90)}
        for i in range(240)
    ]
    df = spark.createDataFrame([tuple(r.values()) for r in data], "id int, k int, j string, t int, x long").repartition(4)
    settings = {"spark.sql.shuffle.partitions": str(ranges), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        found = with_running_sum(df, ["t"], F.col("x"), keys, "total")
        assert sorted((r["id"], int(r["total"])) for r in found.collect()) == brute(data, keys, ["t"])
        plan = running_sums(df, ["t"], F.col("x"), keys)._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)


def test_running_sum_of_nothing(spark):
    df = spark.createDataFrame([], "t int, x long")
    assert with_running_sum(df, ["t"], F.col("x")).collect() == []
