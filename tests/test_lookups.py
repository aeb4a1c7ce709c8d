import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import lookups


def priced(spark, values):
    return spark.createDataFrame([(v,) for v in values], "price int")


@pytest.mark.parametrize(
    ("values", "kept_by_all", "kept_by_least"),
    [([3, 1, 1, 2], 2, 2), ([], 4, 0), ([1, None], 0, 2), ([None], 0, 0)],
)
def test_compare_with_all_values(spark, values, kept_by_all, kept_by_least):
    df = priced(spark, [3, 1, 1, 2])
    others = priced(spark, values)
    assert lookups.not_above_any(df, "price", others, "price").count() == kept_by_all
    least = others.agg(F.min("price")).scalar()
    assert df.filter(F.col("price") == least).count() == kept_by_least


def test_equal_to_least_ignores_null(spark):
    assert lookups.equal_to_least(priced(spark, [2, None, 1, 1]), "price").count() == 2
    assert lookups.equal_to_least(priced(spark, []), "price").count() == 0


def test_match_count_equals_the_join(spark, rows):
    random.seed(1)
    lines = spark.createDataFrame([(i, random.randrange(5), i * 3) for i in range(40)], "id int, k int, price int")
    # One key holds a third of all rows; one key of the lines has none.
    moves = spark.createDataFrame([(0,)] * 50 + [(random.randrange(4),) for _ in range(100)], "k int")
    joined = lines.join(moves, "k").groupBy("k").agg(F.sum("price").alias("s"), F.count("*").alias("n"))
    short = (
        lookups.with_match_count(lines, moves, ["k"], "m")
        .groupBy("k")
        .agg(F.sum(F.col("price") * F.col("m")).alias("s"), F.sum("m").alias("n"))
    )
    assert rows(joined) == rows(short)


def test_counts_in_periods(spark):
    random.seed(2)
    start = dt.date(2015, 1, 1)
    # Customer 1 has a third of all facts and many overlapping periods.
    def some_day(low, high):
        return start + dt.timedelta(random.randrange(low, high))

    facts = [(1 if i % 3 == 0 else random.randrange(2, 6), some_day(0, 60), 1, i % 2) for i in range(600)]
    periods = [(random.choice([1, 1, 1, 2, 3, 4, 9]), some_day(-5, 60), some_day(-5, 70)) for _ in range(150)] + [(1, None, start), (1, start, None), (2, start, start - dt.timedelta(3))]
    got = lookups.counts_in_periods(
        spark.createDataFrame(periods, "c int, first date, last date"),
        spark.createDataFrame(facts, "c int, day date, n int, odd int"),
        "c", "day", "first", "last", ["n", "odd"],
    )
    found = {(r.c, r["first"], r["last"]): (r.n, r.odd) for r in got.collect()}
    assert set(found) == set(periods)
    for c, first, last in periods:
        hits = [f for f in facts if f[0] == c and first and last and first <= f[1] <= last]
        assert found[(c, first, last)] == (sum(f[2] for f in hits), sum(f[3] for f in hits))
