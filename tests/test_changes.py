import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import changes as ch


@pytest.fixture
def target(spark):
    return spark.createDataFrame(
        [(1, "ann", 10), (2, "bob", 20), (3, "cyd", None), (4, None, 40), (5, None, 50)], "id long, name string, qty int"
    )


def source_of(spark, data):
    return spark.createDataFrame(data, "name string, amount int")


def test_insert_numbers_rows_after_the_highest_id(spark, target, rows):
    new = spark.createDataFrame([("zoe",), ("eve",)], "name string")
    change = ch.insert(target, ch.number_after(new, [F.asc("name")], "id", target))
    assert rows(change.log) == [(6, "eve", None), (7, "zoe", None)]
    assert change.table.count() == 7


def test_ids_follow_without_gaps(spark, target):
    new = spark.range(50).select(F.concat(F.lit("n"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("name"))
    numbered = {r.name: r.id for r in ch.number_after(new, [F.asc("name")], "id", target).collect()}
    assert numbered == {f"n{i:03d}": 6 + i for i in range(50)}


def test_insert_into_empty_table(spark, target):
    new = spark.createDataFrame([("a",)], "name string")
    assert ch.number_after(new, [F.asc("name")], "id", target.limit(0)).head().id == 1


def test_delete(target, rows):
    change = ch.delete(target, ch.is_last(target, "id"))
    assert [r[0] for r in rows(change.log)] == [5] and change.table.count() == 4
    unknown = ch.delete(target, F.col("qty") > 5)
    assert unknown.log.count() == 4 and unknown.table.count() == 1


def test_update_logs_both_values(target, rows):
    change = ch.update(target, F.col("id") == 3, {"qty": F.lit(33)}, "id")
    assert rows(change.log) == [(3, 33, None)]
    assert {r.id: r.qty for r in change.table.collect()}[3] == 33


def merge(target, source, **options):
    return ch.merge(
        target, source, "name", {"qty": F.coalesce("amount", F.lit(1))}, {"qty": F.col("amount")}, **options
    )


def test_merge(spark, target, rows):
    change = merge(target, source_of(spark, [("ann", 11), ("cyd", None), ("new", 7), (None, 9)]))
    assert sorted((r.action, str(r.name), r.old_qty, r.new_qty) for r in change.log.collect()) == [
        ("INSERT", "None", None, 9),
        ("INSERT", "new", None, 7),
        ("UPDATE", "ann", 10, 11),
        ("UPDATE", "cyd", None, 1),
    ]
    state = sorted((str(r.name), r.qty) for r in change.table.collect())
    assert state == [("None", 9), ("None", 40), ("None", 50), ("ann", 11), ("bob", 20), ("cyd", 1), ("new", 7)]


def test_merge_keeps_columns_and_types(spark, target):
    change = merge(target, source_of(spark, [("ann", 11), ("new", 7)]))
    assert change.table.dtypes == target.dtypes
    assert {r.name: r.id for r in change.table.collect()}["new"] is None


def test_merge_with_new_ids(spark, target):
    source = ch.with_new_ids(target, source_of(spark, [("ann", 11), ("new", 7), ("also", 8)]), "name", "id")
    change = ch.merge(target, source, "name", {"qty": F.col("amount")}, {"qty": F.col("amount"), "id": F.col("id")})
    assert {r.name: r.id for r in change.table.collect() if r.name in ("also", "new", "ann")} == {
        "ann": 1, "also": 6, "new": 7,
    }


def test_merge_refuses_two_rows_for_one_target(spark, target):
    with pytest.raises(ch.AmbiguousMerge):
        merge(target, source_of(spark, [("ann", 1), ("ann", 2)]))


def test_merge_allows_repeated_new_names(spark, target):
    assert merge(target, source_of(spark, [("new", 1), ("new", 2)])).log.count() == 2


def test_one_source_row_may_update_several_targets(spark, rows):
    target = spark.createDataFrame([(i, "hot", 0) for i in range(30)] + [(99, "x", 0)], "id long, name string, qty int")
    change = merge(target, source_of(spark, [("hot", 5)]))
    assert change.log.count() == 30
    assert change.table.filter("qty = 5").count() == 30


def test_merge_without_regard_to_case(spark, target):
    from ledgerlark.functions.text import any_case

    change = merge(target, source_of(spark, [("ANN", 11), ("Zed", 5)]), match=any_case)
    assert sorted((r.action, r.new_qty) for r in change.log.collect()) == [("INSERT", 5), ("UPDATE", 11)]
    with pytest.raises(ch.AmbiguousMerge):
        merge(target, source_of(spark, [("ANN", 1), ("ann", 2)]), match=any_case)


def test_ambiguous_keys(spark, target, rows):
    flagged = ch.with_known(target, source_of(spark, [("ann", 1), ("ann", 2), ("new", 1), ("new", 2)]), "name")
    assert rows(ch.ambiguous_keys(flagged, "name")) == [("ann", 2)]
