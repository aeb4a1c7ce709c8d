import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import quality as dq


def test_duplicate_keys(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c")], "id int, v string")
    assert rows(dq.duplicate_keys(df, ["id"])) == [(1, 2)]
    assert rows(dq.duplicate_keys(df, ["id"], primary=True)) == [(None, 1), (1, 2)]
    twice = df.union(spark.createDataFrame([(None, "d")], "id int, v string"))
    assert rows(dq.duplicate_keys(twice, ["id"])) == [(None, 2), (1, 2)]


def test_composite_key(spark, rows):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2)], "a int, b int")
    assert rows(dq.duplicate_keys(df, ["a", "b"])) == [(1, 2, 2)]


def test_orphans(spark, rows):
    child = spark.createDataFrame([(1,), (7,), (7,), (None,)], "parent int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    assert rows(dq.orphans(child, "parent", parent, "id")) == [(7, 2)]


def test_orphans_of_other_types_and_repeated_parents(spark, rows):
    child = spark.createDataFrame([(1,), (7,), (7,), (8,), (None,)], "parent int")
    parent = spark.createDataFrame([(1,), (1,), (8,), (None,), (2,)], "id bigint")
    found = dq.orphans(child, "parent", parent, "id")
    assert rows(found) == [(7, 2)]
    assert found.schema.simpleString() == "struct<missing_key:int,child_rows:bigint>"
    assert rows(dq.orphans(child, "parent", parent.limit(0), "id")) == [(1, 1), (7, 2), (8, 1)]


def test_orphans_sort_no_rows_and_move_each_key_once_a_task(spark):
    """Rows of the parent went to the join one by one, to be sorted there."""
    child = spark.range(100, numPartitions=2).select(F.col("id").alias("key"))
    parent = spark.range(100_000, numPartitions=2).select((F.col("id") % 50).alias("key"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = dq.orphans(child, "key", parent, "key")
        assert found.count() == 50
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "Sort" not in plan and plan.count("HashAggregate(") == 2


@pytest.mark.parametrize(
    ("value", "broken"),
    [("", True), ("   ", True), (" a", True), ("a ", True), ("a b", False), ("a", False), (None, False)],
)
def test_text_rule(spark, value, broken):
    df = spark.createDataFrame([(value,)], "name string")
    assert (df.filter(dq.is_padded_or_blank(F.col("name"))).count() == 1) is broken


def test_number_rule(spark):
    df = spark.createDataFrame([(-1,), (0,), (None,), (3,)], "q int")
    assert [r.q for r in df.filter(dq.is_negative(F.col("q"))).collect()] == [-1]


def test_default_now(spark):
    clock = F.lit(dt.datetime(2024, 1, 1))
    given = dt.datetime(2020, 5, 5)
    df = spark.createDataFrame([(1, None), (2, given)], "id int, at timestamp")
    got = {r.id: r.at for r in dq.with_default_now(df, "at", clock).collect()}
    assert got[2] == given and got[1] is not None and got[1] != given
    assert dq.with_default_now(df, "at").filter("at is null").count() == 0


# A recipe book: steps and ingredients follow a deleted recipe, a cooking log
# keeps it.
BOOK = [
    dq.Reference("ingredients", "recipe", "recipes", "id"),
    dq.Reference("steps", "recipe", "recipes", "id"),
    dq.Reference("step_ingredients", "step", "steps", "id"),
    dq.Reference("step_ingredients", "ingredient", "ingredients", "id", cascades=False),
    dq.Reference("logs", "recipe", "recipes", "id", cascades=False),
]


@pytest.fixture
def book(spark):
    def table(data, schema):
        return spark.createDataFrame(data, schema)

    return {
        "recipes": table([(1,), (2,), (3,)], "id int"),
        "ingredients": table([(10, 1), (20, 2), (30, 3)], "id int, recipe int"),
        "steps": table([(100, 1), (101, 1), (200, 2)], "id int, recipe int"),
        "step_ingredients": table([(100, 99), (200, 20), (200, 98)], "step int, ingredient int"),
        "logs": table([(1, 3), (2, None)], "id int, recipe int"),
    }


def test_cascade_follows_references(book, rows):
    done = dq.cascade_delete(book, BOOK, "recipes", F.col("id") == 1)
    assert {name: (kept.count(), gone.count()) for name, (kept, gone) in done.items()} == {
        "recipes": (2, 1), "ingredients": (2, 1), "steps": (1, 2), "step_ingredients": (2, 1),
    }
    assert rows(done["step_ingredients"][1]) == [(100, 99)]


def test_cascade_is_blocked_by_a_log(book):
    with pytest.raises(dq.BlockedDelete):
        dq.cascade_delete(book, BOOK, "recipes", F.col("id") == 3)


def test_cascade_is_blocked_further_down(book):
    with pytest.raises(dq.BlockedDelete):
        dq.cascade_delete(book, BOOK, "recipes", F.col("id") == 2)


def test_row_reached_on_two_paths_counts_once(spark):
    tables = {
        "a": spark.createDataFrame([(1,)], "id int"),
        "b": spark.createDataFrame([(1, 1)], "id int, a int"),
        "c": spark.createDataFrame([(1, 1, 1), (2, 1, None), (3, None, None)], "id int, a int, b int"),
    }
    rules = [dq.Reference("b", "a", "a", "id"), dq.Reference("c", "a", "a", "id"), dq.Reference("c", "b", "b", "id")]
    kept, gone = dq.cascade_delete(tables, rules, "a", F.lit(True))["c"]
    assert (kept.count(), gone.count()) == (1, 2)


def test_circle_is_refused(spark):
    rules = [dq.Reference("b", "a", "a", "id"), dq.Reference("a", "b", "b", "id")]
    table = spark.createDataFrame([(1, 1, 1)], "id int, a int, b int")
    with pytest.raises(ValueError):
        dq.cascade_delete({"a": table, "b": table}, rules, "a", F.lit(True))


def test_key_change_travels(spark, rows):
    tables = {
        "a": spark.createDataFrame([(1,), (2,)], "id int"),
        "b": spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "a int, v string"),
        "c": spark.createDataFrame([(1,), (2,)], "ba int"),
        "d": spark.createDataFrame([(2,)], "a int"),
    }
    rules = [
        dq.Reference("b", "a", "a", "id"),
        dq.Reference("c", "ba", "b", "a"),
        dq.Reference("d", "a", "a", "id", cascades=False),
    ]
    new = spark.createDataFrame([(1, 100)], "old_key int, new_key int")
    done = dq.cascade_key_change(tables, rules, "a", "id", new)
    assert rows(done["a"]) == [(100,), (2,)]
    assert rows(done["b"]) == [(None, "z"), (100, "x"), (2, "y")]
    assert rows(done["c"]) == [(100,), (2,)]
    with pytest.raises(dq.BlockedChange):
        dq.cascade_key_change(tables, rules, "a", "id", spark.createDataFrame([(2, 9)], "old_key int, new_key int"))


def test_reference_to_itself_is_refused(spark):
    tree = spark.createDataFrame([(1, None), (2, 1)], "id int, parent int")
    rules = [dq.Reference("tree", "parent", "tree", "id")]
    with pytest.raises(ValueError, match="itself"):
        dq.cascade_delete({"tree": tree}, rules, "tree", F.col("id") == 1)


def test_old_key_listed_twice_is_refused(spark):
    table = spark.createDataFrame([(1,)], "id int")
    new = spark.createDataFrame([(1, 8), (1, 9)], "old_key int, new_key int")
    with pytest.raises(ValueError, match="several new keys"):
        dq.cascade_key_change({"a": table}, [], "a", "id", new)
