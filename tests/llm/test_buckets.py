"""Crowded buckets: similar members that are not similar to the center."""

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import line_dedup, near_duplicates
from ledgerlark.llm.bitmarks import PIECE, counts_of
from ledgerlark.llm.buckets import FACT_TYPES, FACTS, ODD, _odd_before, crowded, facts, settle, untested
from ledgerlark.session import stage

LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789"


def family(draw, n, twins):
    """Words of ``n`` texts with one passage and a rest of their own; the first ``twins`` have a near copy."""
    passage = ["".join(draw.choices(LETTERS, k=7)) for _ in range(40)]
    texts = [passage + ["".join(draw.choices(LETTERS, k=7)) for _ in range(40)] for _ in range(n)]
    return texts + [words[:-1] + ["".join(draw.choices(LETTERS, k=7))] for words in texts[:twins]]


def linked(labels):
    groups = {}
    for node, label in labels.collect():
        groups.setdefault(label, set()).add(node)
    return sorted(tuple(sorted(group)) for group in groups.values() if len(group) > 1)


@pytest.mark.parametrize("rounds", [1, 5])
def test_twins_in_one_bucket_meet(spark, rounds):
    texts = family(random.Random(5), 600, 40)
    rows = spark.createDataFrame([(i * 7919 % 1_000_003, " ".join(words)) for i, words in enumerate(texts)], "t bigint, line string")
    spread = rows.select("t", F.array(F.lit(1).cast("long")).alias("bands"))
    want = sorted(tuple(sorted((i * 7919 % 1_000_003, (600 + i) * 7919 % 1_000_003))) for i in range(40))

    def verify(pairs):
        one = rows.select(F.col("t").alias("a"), F.col("line").alias("line_a"))
        two = rows.select(F.col("t").alias("b"), F.col("line").alias("line_b"))
        return pairs.join(one, "a").join(two, "b").mapInPandas(line_dedup._verify, "a bigint, b bigint")

    known = rows.mapInPandas(line_dedup._known, f"t bigint, {FACT_TYPES}")
    found = settle(crowded(spread), verify, rows, known, line_dedup._elements, line_dedup.SIMILARITY, rounds)
    assert linked(found) == want

    texts = rows.withColumn("id", F.col("t")).withColumnRenamed("line", "text").select("id", "t", "text")
    sketches = stage(texts.mapInPandas(near_duplicates._sketch, near_duplicates.SKETCH), "sketches")
    links = lambda pairs: near_duplicates._links(pairs, sketches)
    sets, known = sketches.select("t", "e", "w"), sketches.select("t", *FACTS)
    found = settle(crowded(spread), links, sets, known, near_duplicates._elements, near_duplicates.SIMILARITY, rounds, True)
    assert linked(found) == want


@pytest.mark.parametrize("width", [1000, 12])
def test_weights_and_sizes_against_all_pairs(spark, width):
    """Few words, so that elements are shared by texts that are not similar; weights and lengths differ.

    All texts are one bucket, or every twelve are.
    """
    draw = random.Random(9)
    texts = []
    for _ in range(60):
        words = [draw.choice("abcdefgh") for _ in range(draw.randrange(8, 40))]
        texts += [words, words + words[: draw.randrange(12)], words * draw.randrange(1, 4), words[draw.randrange(4) :]]
    rows = spark.createDataFrame([(i, i, " ".join(words)) for i, words in enumerate(texts)], "id bigint, t bigint, text string")
    sketches = stage(rows.mapInPandas(near_duplicates._sketch, near_duplicates.SKETCH), "sketches")
    held = {r.t: (r.e, r.w) for r in sketches.collect()}
    near = [
        (a, b)
        for a, b in combinations(held, 2)
        if a // width == b // width and max(near_duplicates.similarity(*held[a], *held[b])) >= near_duplicates.SIMILARITY
    ]
    parent = {t: t for t in held}

    def top(t):
        while parent[t] != t:
            t = parent[t]
        return t

    for a, b in near:
        parent[top(a)] = top(b)
    groups = {}
    for t in held:
        groups.setdefault(top(t), set()).add(t)
    want = sorted(tuple(sorted(group)) for group in groups.values() if len(group) > 1)
    links = lambda pairs: near_duplicates._links(pairs, sketches)
    sets, known = sketches.select("t", "e", "w"), sketches.select("t", *FACTS)
    spread = rows.select("t", F.array(F.xxhash64(F.floor(F.col("t") / width))).alias("bands"))
    found = settle(crowded(spread), links, sets, known, near_duplicates._elements, near_duplicates.SIMILARITY, 1, True)
    assert linked(found) == want and len(want) > 20


def test_counts_reach_the_driver_in_pieces(spark, monkeypatch):
    """Two million rows of slot and count took the driver some hundred megabytes."""
    slots = 2 * PIECE + 5
    counted = spark.createDataFrame([(0, 3), (0, 4), (PIECE, 2**31), (slots - 1, 9)], "slot long, n long").repartition(3)
    rows = []
    collect = type(counted).collect
    monkeypatch.setattr(type(counted), "toPandas", lambda self: pytest.fail("all slots as rows"))
    monkeypatch.setattr(type(counted), "collect", lambda self: rows.extend(found := collect(self)) or found)
    counts = counts_of(counted, slots).value
    assert len(counts) == slots and {int(i): int(counts[i]) for i in np.flatnonzero(counts)} == {0: 7, PIECE: 2**31 - 1, slots - 1: 9}
    assert len(rows) == 3 and not counts_of(counted.limit(0), slots).value.any()


def test_slots_of_the_elements_from_one_on():
    """What stands before the first common element is apart as a whole; its slots were counted by whether they are odd."""
    draw = np.random.default_rng(3)
    n = [0, 1, 30, 400, 0, 7]
    owner = np.repeat(np.arange(len(n)), n)
    found = draw.integers(1, 2**63, len(owner)).astype(np.uint64)
    begin = (np.cumsum(n) - n)[owner]
    kept = draw.random(len(owner)) < 0.4
    whole = facts(owner, found, np.ones(len(owner), np.int64), len(n))
    before = _odd_before(found, begin, kept)
    for at, place in enumerate(np.flatnonzero(kept)):
        rest = found[place : begin[place] + n[owner[place]]]
        want = facts(np.zeros(len(rest), np.int64), rest, np.ones(len(rest), np.int64), 1)
        assert all(whole[c][owner[place]] ^ before[c][at] == want[c][0] for c in ODD)


def test_similar_sets_are_joined_and_others_are_not(spark):
    """A pair that shares rare elements but has too many of its own before them was compared."""
    common, near, far = ([[f"{kind}{i:07d}" for i in range(n)] for kind, n in (("c", 40), ("n", 4), ("f", 60))])
    lines = ["".join(common), "".join(common[:39] + near[:1]), "".join(common[:20] + far[:20]), "".join(far[30:] + common[10:20])]
    sets = stage(spark.createDataFrame(list(enumerate(lines)), "t bigint, line string"), "sets")
    nodes = sets.select("t", F.col("t").alias("label"))
    elements = line_dedup._elements
    pairs = {(r.a, r.b) for r in untested(nodes, sets, elements, line_dedup.SIMILARITY, False).collect()}
    assert pairs == {(0, 1)}
