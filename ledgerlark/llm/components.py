"""Connected components of links between hashed nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.session import stage, unstage


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` of every node that occurs in ``links`` (``a``, ``b``).

    Each round every node takes its smallest neighbour, or itself, as parent,
    and the links move up to the parents, until none joins two nodes. Node ids
    have to be hashes: then a round shortens any path by a constant factor.
    The smallest neighbour is an aggregate with partial results, so a node with
    most of the links is no hot task; rounds are stored in the shared folder.
    An empty table of links gives an empty table.
    """
    edges = stage(links.select("a", "b").filter("a <> b").distinct(), "links")
    steps, rounds = [], [edges]
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        lowest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        parents = stage(lowest.select("node", F.least("node", "low").alias("parent")), "parents")
        steps.append(parents)
        for end in ("a", "b"):
            up = parents.select(F.col("node").alias(end), "parent")
            edges = edges.join(up, end).drop(end).withColumnRenamed("parent", end)
        edges = stage(edges.select("a", "b").filter("a <> b").distinct(), "links")
        rounds.append(edges)
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    labels = steps[0].select("node", F.col("parent").alias("label"))
    for parents in steps[1:]:
        up = parents.select(F.col("node").alias("label"), "parent")
        labels = labels.join(up, "label", "left").select("node", F.coalesce("parent", "label").alias("label"))
    found = stage(labels, "labels")
    unstage(*steps, *rounds)
    return found
