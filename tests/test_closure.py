"""References followed to any depth against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators.closure import cascade_closure, closure
from ledgerlark.operators.quality import BlockedDelete, Reference

SELF = Reference("node", "up", "node", "id")


def brute(links, start, up):
    found, todo = set(start), list(start)
    while todo:
        one = todo.pop()
        for child, parent in links:
            here, there = (child, parent) if up else (parent, child)
            if here == one and there is not None and there not in found:
                found.add(there)
                todo.append(there)
    return sorted(found)


def keys(df):
    return sorted(r.key for r in df.collect())


@pytest.mark.parametrize("up", [False, True])
def test_trees_and_circles(spark, up):
    draw = random.Random(2)
    tree = [(i, (i - 1) // 2 if i else None) for i in range(63)]  # depth five
    circle = [(100 + i, 100 + (i + 1) % 7) for i in range(7)] + [(120, 103), (121, 120), (130, 130)]
    other = [(200 + i, draw.choice([None, 200 + draw.randrange(20)])) for i in range(20)]
    links = tree + circle + other
    nodes = spark.createDataFrame(links, "id int, up int")
    for start in ([0], [40], [4, 104], [121], [130], [203, 50], [999]):
        first = spark.createDataFrame([(s,) for s in start], "id int")
        found = closure({"node": nodes}, {"node": "id"}, [SELF], {"node": first}, up)
        assert keys(found["node"]) == brute(links, start, up)


def test_circles_over_two_tables(spark):
    a = spark.createDataFrame([(1, 10), (2, 11), (3, None), (4, 13)], "a int, of_b int")
    b = spark.createDataFrame([(10, 2), (11, 3), (12, 1), (13, None)], "b int, of_a int")
    refs = [Reference("a", "of_b", "b", "b"), Reference("b", "of_a", "a", "a")]
    start = {"a": a.filter("a = 3").select("a")}
    found = closure({"a": a, "b": b}, {"a": "a", "b": "b"}, refs, start)
    assert keys(found["a"]) == [1, 2, 3] and keys(found["b"]) == [10, 11, 12]
    back = closure({"a": a, "b": b}, {"a": "a", "b": "b"}, refs, {"b": b.filter("b = 12").select("b")}, up=True)
    assert keys(back["a"]) == [1, 2, 3] and keys(back["b"]) == [10, 11, 12]


def test_cascade_over_a_tree_with_users(spark):
    nodes = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, None), (5, 4)], "id int, up int")
    uses = spark.createDataFrame([(1, 3), (2, 5), (3, None)], "use int, node int")
    tables, own = {"node": nodes, "use": uses}, {"node": "id", "use": "use"}
    refs = [SELF, Reference("use", "node", "node", "id")]
    done = cascade_closure(tables, own, refs, "node", F.col("id") == 1)
    assert sorted(r.id for r in done["node"][0].collect()) == [4, 5]
    assert sorted(r.id for r in done["node"][1].collect()) == [1, 2, 3]
    assert [sorted(r.use for r in part.collect()) for part in done["use"]] == [[2, 3], [1]]
    kept, gone = cascade_closure(tables, own, refs, "node", F.col("id") == 77)["node"]
    assert kept.count() == 5 and gone.count() == 0
    guard = [SELF, Reference("use", "node", "node", "id", cascades=False)]
    with pytest.raises(BlockedDelete):
        cascade_closure(tables, own, guard, "node", F.col("id") == 1)
    assert cascade_closure(tables, own, guard, "node", F.col("id") == 2 + 100)["node"][1].count() == 0
    with pytest.raises(ValueError):
        closure(tables, own, [Reference("use", "node", "node", "up")], {"node": nodes.select("id")})
