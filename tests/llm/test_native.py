"""Mixing, shards and decontamination on small tables."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import decontamination as dc
from ledgerlark.llm import mixing, sharding


def taken(docs, **options):
    return mixing.mix(docs, **options).collect()


def words(n, word="w"):
    return " ".join([word] * n)


def test_targets_fill_up_to_the_cap(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1000), ("c", 400), (None, 500)], "source string, source_size long")
    got = {r.source: (r.weight, r.target) for r in mixing.targets(sizes).collect()}
    # 3000 words: a (5) is full at 200, the others share the rest 2 : 1 : 5, null is full at 1000.
    assert got["a"] == (5, 200) and got[None] == (5, 1000)
    assert got["c"] == (1, pytest.approx(600)) and got["b"] == (2, pytest.approx(1200))


def test_mix_takes_the_targets(table):
    draw = random.Random(1)
    rows = [(i, words(draw.randrange(0, 300)), "hot" if i % 3 else f"s{i % 7}") for i in range(400)]
    got = taken(table(*rows), block_tokens=16)
    assert Counter(r.doc_id for r in got) == Counter(i for i, _, _ in rows)
    assert all(r["size"] == len(re.findall(r"\S+", rows[r.doc_id][1])) and 0 <= r.taken <= 2 * r["size"] for r in got)
    for source in {r.source for r in got}:
        mine = [r for r in got if r.source == source]
        assert mine[0].source_size == sum(r["size"] for r in mine)
        assert sum(r.taken for r in mine) == int(mine[0].target)
    assert sum(r.taken for r in got) == pytest.approx(1.5 * sum(r["size"] for r in got), abs=10)


def test_mix_does_not_depend_on_layout_or_blocks(table):
    docs = table(*[(i, words(i % 40), f"s{i % 3}") for i in range(90)])
    first = sorted(map(tuple, taken(docs, block_tokens=8)))
    assert first == sorted(map(tuple, taken(docs.repartition(7), block_tokens=8)))
    assert first == sorted(map(tuple, taken(docs, block_tokens=1000)))


def test_mix_edges(table):
    odd = table((1, None, "a"), (2, "", None), (None, "x y", None), (4, "x y", "a"), (4, "x y", "a"), (5, words(5000), "b"))
    got = taken(odd, block_tokens=64)
    assert len(got) == 6 and all(r.taken <= 2 * r["size"] for r in got)
    assert {r["size"] for r in got if r.source is None} == {0, 2}
    assert taken(odd.limit(0)) == []
    assert taken(table((1, None, None), (2, " \n", "a")))[0].taken == 0
    kept = mixing.apply_mix(odd)
    assert kept.columns == odd.columns and kept.count() >= 4


def test_schedule_is_a_spread_permutation(spark):
    plan = spark.createDataFrame([(0, 500), (1, 300), (2, 200), (3, 0)], "source_no int, quota long")
    rows = mixing.schedule(plan, 1, slots_per_range=64).orderBy("slot").collect()
    assert [r.slot for r in rows] == list(range(1000))
    for source, quota in ((0, 500), (1, 300), (2, 200)):
        mine = [r for r in rows if r.source_no == source]
        assert [r.block for r in mine] == list(range(quota))
        # Low discrepancy: any start of the schedule holds nearly its share.
        for cut in range(50, 1000, 50):
            assert abs(sum(r.slot < cut for r in mine) - cut * quota / 1000) <= 5
    assert mixing.schedule(plan.limit(0), 1).collect() == []


@pytest.mark.parametrize(("shards", "slots"), [(1, 7), (3, 7), (16, 2053), (7, 7)])
def test_table_is_full_and_even(shards, slots):
    names = [f"s{i}" for i in range(shards)]
    counts = Counter(sharding.lookup_table(names, slots))
    assert sum(counts.values()) == slots and max(counts.values()) - min(counts.values()) <= 1


def test_table_moves_little_and_checks_its_arguments():
    names = [f"s{i}" for i in range(16)]
    before, after = sharding.lookup_table(names, 2053), sharding.lookup_table(names[:-1], 2053)
    moved = sum(a != b for a, b in zip(before, after, strict=True) if a != 15)
    assert moved < 0.15 * 2053
    for wrong in ((names, 2048), ([], 7), (names, 13), (["a", "a"], 7), (names, 1_000_003 + 30)):
        with pytest.raises(ValueError):
            sharding.lookup_table(*wrong)


def test_place(spark):
    docs = spark.createDataFrame([(1, "a", 9), (1, "a", 9), (None, None, 9), (2, "b", 9)], "doc_id long, text string, shard int")
    got = sharding.place(docs, ["x", "y", "z"], 101, F.col("doc_id"))
    assert got.columns == ["doc_id", "text", "slot", "shard"]
    rows = got.collect()
    lookup = sharding.lookup_table(["x", "y", "z"], 101)
    for r in rows:
        slot = sharding.hash63(str(r.doc_id)) % 101 if r.doc_id is not None else 0
        assert (r.slot, r.shard) == (slot, lookup[slot])
    assert len(rows) == 4 and sharding.place(docs.limit(0), ["x"], 7, F.col("doc_id")).count() == 0


def brute(text, items):
    """The contract of the report, word by word."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    doc, hit, found = split(text), set(), set()
    for item, item_text in items:
        w = split(item_text)
        span = min(10, len(w))
        windows = {tuple(w[i : i + span]) for i in range(len(w) - span + 1)} if w else set()
        for at in range(len(doc) - span + 1):
            if tuple(doc[at : at + span]) in windows:
                hit.update(range(at, at + span))
                found.add("" if item is None else str(item))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(doc), len(hit), len(found), digest, bool(hit)


def test_decontamination_against_brute_force(spark, table):
    draw = random.Random(3)
    vocabulary = ["Ab", "cd", "É1", "x-y", "42", "ee"]
    text = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate((0, 1, 3, 3, 9, 10, 11, 30, 40))] + [(None, text(12)), (3, text(10)), (99, None)]
    long = items[7][1]
    rows = [(i, text(draw.randrange(60)), "s") for i in range(60)]
    rows += [(100, f"Start. {long.upper()}! end", "s"), (101, long + " " + long, "s"), (102, None, "s"), (103, "", "s")]
    rows += [(104, long, "s")] * 3 + [(None, long, "s"), (105, text(5000), "s")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for some in (items, items[6:8]):
        part = bench.filter(F.col("item_id").isin([i for i, _ in some])) if len(some) == 2 else bench
        wanted = Counter((i, *brute(t, some)) for i, t, _ in rows)
        assert Counter(map(tuple, dc.report(table(*rows), part).collect())) == wanted
        # Beyond the bound of the broadcast the join is Spark's own.
        assert Counter(map(tuple, dc.report(table(*rows), part, most_broadcast=0).collect())) == wanted


def test_decontamination_edges(spark, table):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id long, text string")
    docs = table((1, "Zero ONE two, three four five six seven eight nine ten; last.", "a"), (2, "clean text", "a"), (None, None, None))
    assert sorted(str(r.doc_id) for r in dc.drop_documents(docs, bench).collect()) == ["2", "None"]
    assert dc.drop_documents(docs, bench).columns == docs.columns
    assert {r.doc_id: r.text for r in dc.remove_spans(docs, bench).collect()} == {1: "Zero last.", 2: "clean text", None: None}
    assert dc.report(docs.limit(0), bench).count() == 0
    assert not any(r.contaminated for r in dc.report(docs, bench.limit(0)).collect())


def test_mixed_stretches_are_the_mix(spark, table):
    draw = random.Random(8)
    rows = [(i, " ".join(f"w{i}-{k}" for k in range(draw.randrange(40))), draw.choice(["a", "a", "b", "c", None])) for i in range(80)]
    rows += [(7, "x y z", "b"), (7, "x y z", "b"), (None, "n o", "a"), (200, None, "a"), (201, "", "z")]
    docs = table(*rows)
    found = mixing.mixed(docs, block_tokens=16).orderBy("slot", "at").collect()
    taken = Counter()
    blocks = {}
    for r in found:
        taken[r.doc_id, r.source] += r.words
        blocks.setdefault((r.slot, r.source, r.block), []).append(r)
        assert len(r.text.split(" ")) == r.words
    wanted = Counter()
    for r in mixing.mix(docs, block_tokens=16).collect():
        wanted[r.doc_id, r.source] += r.taken
    assert +taken == +wanted
    assert sorted(slot for slot, _, _ in blocks) == list(range(len(blocks)))
    texts = {}
    for i, text, source in rows:
        texts.setdefault((i, source), set()).add(text)
    last = {source: max(b for _, s, b in blocks if s == source) for _, source, _ in blocks}
    for (_, source, block), stretches in blocks.items():
        # Stretches fill a block without gaps; only the last block of a source may be short.
        assert [r.at for r in stretches] == [sum(o.words for o in stretches[:k]) for k in range(len(stretches))]
        assert sum(r.words for r in stretches) == 16 or block == last[source]
        for r in stretches:
            assert any((t or "").split()[r["first"] : r["first"] + r.words] == r.text.split(" ") for t in texts[r.doc_id, r.source])
    assert mixing.mixed(docs.limit(0)).count() == 0


def test_large_decontamination_moves_no_text_per_word(spark, table):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id long, text string")
    plan = dc.report(table((1, "a b c", "s")), bench, most_broadcast=0)._jdf.queryExecution().optimizedPlan().toString()
    generates = [line for line in plan.split("\n") if "posexplode" in line.lower()]
    assert generates and "Join LeftSemi" in plan
