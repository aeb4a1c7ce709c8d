"""Slices, buckets and probes: what is left alone, not shuffled and not read."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerlark.functions import text
from ledgerlark.operators import changes as ch
from ledgerlark.plans.layout import aligned_orders_and_lines
from ledgerlark.sources.aligned import HotKey, join_aligned, write_aligned
from ledgerlark.sources.probes import exists, probe, write_for_probes
from ledgerlark.sources.sliced import SlicedTable
from ledgerlark.tables import Warehouse


def files(path):
    found = {}
    for folder, _, names in os.walk(path):
        found.setdefault(os.path.basename(folder), set()).update(n for n in names if n.endswith(".parquet"))
    return {folder: names for folder, names in found.items() if folder.startswith("key_slice=")}


def scanned(df, metric):
    """What the scan of a plan counted when it ran."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().get(metric).get().value()


@pytest.fixture
def table(spark, tmp_path):
    rows = spark.createDataFrame([(f"k{i}", i, "old") for i in range(400)] + [(None, -1, "none")], "name string, id int, state string")
    return SlicedTable(spark, str(tmp_path / "t"), rows.schema, "name", 8).write(rows)


def test_only_slices_of_the_source_are_rewritten(spark, table):
    before = files(table.path)
    source = spark.createDataFrame([("k5", "new"), ("k6", "new"), ("fresh", "new")], "name string, state string")
    log = table.merge(source, {"state": F.col("state")}, {"id": F.lit(1000), "state": F.col("state")})
    assert sorted((r.action, r.name, r.old_state, r.new_state) for r in log.collect()) == [
        ("INSERT", "fresh", None, "new"), ("UPDATE", "k5", "old", "new"), ("UPDATE", "k6", "old", "new"),
    ]
    after = files(table.path)
    touched = {f"key_slice={n}" for n in table.touched(source)}
    assert len(before) == 9 and 0 < len(touched) <= 3
    assert {f for f in before if before[f] != after[f]} == touched
    state = {r.name: (r.id, r.state) for r in table.read().collect()}
    assert len(state) == 402 and state["k5"] == (5, "new") and state["fresh"] == (1000, "new")
    assert state["k7"] == (7, "old") and state[None] == (-1, "none")


def test_a_change_reads_the_files_of_its_slices(spark, table):
    every = files(table.path)
    assert scanned(table.read([2, 5]), "numFiles") == len(every["key_slice=2"]) + len(every["key_slice=5"])
    assert table.merge(table.read().limit(0), {"state": F.lit("x")}, {}).count() == 0
    with pytest.raises(ch.AmbiguousMerge):
        table.merge(spark.createDataFrame([("k1", 1), ("k1", 2)], "name string, v int"), {"id": F.col("v")}, {})
    with pytest.raises(ValueError):
        table.merge(spark.createDataFrame([(None, 1)], "name string, v int"), {"id": F.col("v")}, {})
    assert table.read().count() == 401


def test_keys_in_any_case_meet_in_a_slice(spark, tmp_path):
    rows = spark.createDataFrame([("Ab", 1), ("cd", 2)], "name string, id int")
    table = SlicedTable(spark, str(tmp_path / "t"), rows.schema, "name", 4, text.any_case, F.lower).write(rows)
    table.merge(spark.createDataFrame([("aB", 9)], "name string, v int"), {"id": F.col("v")}, {"id": F.col("v")})
    assert sorted(tuple(r) for r in table.read().collect()) == [("Ab", 9), ("cd", 2)]


def test_aligned_tables_join_without_a_shuffle(spark):
    w = Warehouse(spark, "/root/testdata/sf0.001")
    orders, lines = aligned_orders_and_lines(w)
    joined = join_aligned(orders, lines, "o_orderkey", "l_orderkey")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    sums = lines.groupBy("l_orderkey").agg(F.count("*").alias("n"))
    assert "Exchange" not in sums._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == w.orders.join(w.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).count()


def test_a_hot_key_is_refused(spark):
    rows = spark.range(9000).withColumn("k", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")))
    with pytest.raises(HotKey):
        write_aligned(rows, "k", 8)


def test_absent_keys_read_no_row_group(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(20_000).select((F.col("id") % 50).alias("place"), F.col("id"), F.concat(F.lit("name-"), F.xxhash64("id").cast("string")).alias("name"))
    write_for_probes(rows, path, ["place", "id"], {"name": 20_000})
    known = rows.filter("id = 777").first().name
    assert [r.id for r in probe(spark, path, F.col("name") == known).collect()] == [777]
    absent = probe(spark, path, F.col("name") == "name-5000000000000000000")
    assert absent.collect() == [] and scanned(absent, "numOutputRows") == 0
    assert scanned(probe(spark, path, F.col("place") == 99), "numOutputRows") == 0
    assert exists(spark, path, F.col("name") == known).first().found
    assert not exists(spark, path, F.col("name") == "none").first().found
