"""Operators that read texts in Python workers, against brute force and on odd tables."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from ledgerlark.llm import arrays, buckets, context_tree, line_dedup, near_duplicates, quality_classifier, quality_rules
from ledgerlark.llm.components import components
from ledgerlark.session import stage

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 977}" for i in range(60_000))


def sentence(draw, n, vocabulary=400):
    return " ".join(f"v{draw.randrange(vocabulary)}" for _ in range(n))


def classes_of(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_word_hashes_do_not_depend_on_neighbours(monkeypatch):
    texts = ["a bb  ccc", "", "bb a", None, "é\tbb\n", "x" * 5000 + " bb"]
    coded = arrays.encode(texts, lower=False)
    whole, counts = arrays.hash_words(coded, arrays.BY_SPACE)
    assert counts.tolist() == [len(SPACE.findall(t or "")) for t in texts]
    words = [w for t in texts for w in SPACE.findall(t or "")]
    by_word = defaultdict(set)
    for word, found in zip(words, whole, strict=True):
        by_word[word].add(int(found))
    assert all(len(found) == 1 for found in by_word.values()) and len(set.union(*by_word.values())) == len(by_word)
    monkeypatch.setattr(arrays, "PIECE_BYTES", 3)
    assert arrays.hash_words(coded, arrays.BY_SPACE)[0].tolist() == whole.tolist()


def test_components(spark):
    links = [(1, 2), (2, 3), (7, 9), (9, 8), (5, 5), (3, 1)] + [(100, i) for i in range(101, 400)] + [(i, i + 1) for i in range(500, 540)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = classes_of([p for p in links if p[0] != p[1]], {n for p in links if p[0] != p[1] for n in p})
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_signatures_estimate_probability_jaccard():
    draw = np.random.default_rng(1)
    e = draw.integers(1, 2**63, 400).astype(np.uint64)
    x, y = draw.integers(1, 5, 300), draw.integers(1, 5, 300)
    a, b = e[:300], e[100:]
    exact, _ = near_duplicates.similarity(np.sort(a), x[np.argsort(a)], np.sort(b), y[np.argsort(b)])
    slow = 0.0
    wx, wy = dict(zip(a.tolist(), x.tolist(), strict=True)), dict(zip(b.tolist(), y.tolist(), strict=True))
    for d in wx.keys() & wy.keys():
        slow += 1 / sum(max(wx.get(k, 0) / wx[d], wy.get(k, 0) / wy[d]) for k in wx.keys() | wy.keys())
    assert exact == pytest.approx(slow)
    owner = np.repeat([0, 1], 300)
    rows = near_duplicates.signatures(np.concatenate([a, b]), owner, np.concatenate([x, y]), 2, 6000)
    assert (rows[0] == rows[1]).mean() == pytest.approx(exact, abs=0.03)


def near_copies(draw):
    rows, base = [], [sentence(draw, draw.randrange(40, 200)) for _ in range(25)]
    for text in base:
        words = text.split()
        for _ in range(draw.randrange(1, 6)):
            copy = list(words)
            for _ in range(draw.randrange(0, 4)):
                copy[draw.randrange(len(copy))] = f"new{draw.randrange(10**6)}"
            rows.append(" ".join(copy))
    rows += [base[0]] * 5 + [base[1].upper()] + ["one two", "one two", "one two three", "", "", " .,", LONG, LONG + " end"]
    return list(enumerate(rows, start=10))


def test_near_duplicates_against_brute_force(table):
    rows = near_copies(random.Random(4))
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
        sets[i] = Counter(zip(*[words[k:] for k in range(5)])) if len(words) >= 5 else Counter([tuple(words)] if words else [])
    texts = dict(rows)

    def near(a, b):
        if texts[a] == texts[b]:
            return True
        x, y = sets[a], sets[b]
        if not x.keys() & y.keys():
            return False
        keys = sorted(x.keys() | y.keys())
        number = {k: n for n, k in enumerate(keys)}
        one, two = sorted(number[k] for k in x), sorted(number[k] for k in y)
        return max(near_duplicates.similarity(one, [x[keys[k]] for k in one], two, [y[keys[k]] for k in two])) >= 0.8

    want = classes_of([p for p in combinations([i for i, _ in rows], 2) if near(*p)], [i for i, _ in rows])
    docs = table(*[(i, text, "s") for i, text in rows])
    got = near_duplicates.report(docs).collect()
    assert {r.doc_id: r.class_id for r in got} == want and len(got) == len(rows)
    sizes = Counter(want.values())
    assert all(r.class_size == sizes[r.class_id] for r in got)
    kept = near_duplicates.deduplicate(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_near_duplicates_edges(table):
    text = sentence(random.Random(1), 50)
    odd = table((None, None, None), (None, text, None), (3, text, "a"), (3, text, "a"), (3, "other words", "a"), (4, "", "a"))
    got = sorted(((r.doc_id, r.class_id, r.class_size) for r in near_duplicates.report(odd).collect()), key=str)
    assert got == sorted([(None, None, 2), (4, None, 2), (None, None, 3), (3, None, 3), (3, None, 3), (3, 3, 1)], key=str)
    assert near_duplicates.deduplicate(odd).count() == 3
    assert near_duplicates.report(odd.limit(0)).count() == 0 == near_duplicates.deduplicate(odd.limit(0)).count()


def brute_lines(rows):
    spots = defaultdict(list)
    for i, text in sorted(rows):
        for place, line in enumerate((text or "").split("\n")):
            if line.strip():
                spots[" ".join(line.split()).lower()].append((i, place))
    grams = {line: {line.ljust(8)[k : k + 8] for k in range(max(1, len(line) - 7))} for line in spots}
    links = [(a, b) for a, b in combinations(spots, 2) if len(grams[a] & grams[b]) >= 0.8 * len(grams[a] | grams[b])]
    groups = defaultdict(list)
    for line, label in classes_of(links, list(spots)).items():
        groups[label] += spots[line]
    gone = defaultdict(list)
    for group in groups.values():
        for i, place in sorted(group)[1:]:
            gone[i].append(place)
    return {i: sorted(gone[i]) for i, _ in rows}


def test_line_dedup_against_brute_force(table):
    draw = random.Random(6)
    lines = [sentence(draw, draw.randrange(1, 25)) for _ in range(60)] + ["}", "ok", "ÜBER alles was geht und steht"]

    def vary(line):
        return line.upper() if draw.random() < 0.2 else line + draw.choice(("", " ", ".", "!!")) if draw.random() < 0.7 else line[:-2] + "zz"

    rows = [(i, "\n".join(vary(draw.choice(lines)) for _ in range(draw.randrange(12)))) for i in range(40)]
    rows += [(100, LONG), (101, LONG + " x"), (102, None), (103, "\n \n")]
    docs = table(*[(i, t, "s") for i, t in rows])
    got = {r.doc_id: r for r in line_dedup.report(docs).collect()}
    want = brute_lines(rows)
    assert {i: list(r.dropped) for i, r in got.items()} == want
    assert all(got[i].n_lines == sum(bool(x.strip()) for x in (t or "").split("\n")) for i, t in rows)
    cleaned = {r.doc_id: r.text for r in line_dedup.clean(docs).collect()}
    for i, text in rows:
        parts = (text or "").split("\n")
        assert cleaned[i] == "\n".join(p for k, p in enumerate(parts) if k not in want[i])


def test_line_dedup_copies_and_no_sort_for_every_line(table):
    """All lines of a document were sorted anew for each of them."""
    lines = [f"{n} {n * n} line of its own {n * 7919 % 1000}" for n in range(300)]
    lines[5], lines[299] = "", lines[0]
    docs = table((1, "\n".join(lines), "a"), (1, "\n".join(lines), "a"), (2, "\n".join(lines[:2]), "a"))
    found = line_dedup.decide(docs).select("doc_id", "copy", "n_lines", "dropped", "kept")
    assert "array_sort" not in found._jdf.queryExecution().optimizedPlan().toString()
    rows = {(r.doc_id, r["copy"]): r for r in found.collect()}
    places = [n for n in range(300) if n != 5]
    assert [rows[key].n_lines for key in ((1, 1), (1, 2), (2, 1))] == [299, 299, 2]
    assert rows[1, 1].dropped[-1] == 299 and tuple(rows[1, 1].kept[-1]) == (1, 0)
    assert list(rows[1, 2].dropped) == places and {k.doc_id for k in rows[1, 2].kept} == {1}
    assert {k.place for k in rows[1, 2].kept} <= set(places) and tuple(rows[1, 2].kept[-1]) == (1, 0)
    assert list(rows[2, 1].dropped) == [0, 1] and [k.doc_id for k in rows[2, 1].kept] == [1, 1]


def test_line_dedup_edges(table):
    odd = table((1, "same line here", "a"), (1, "same line here", "a"), (None, "same line here", None), (2, None, None))
    got = sorted(((r.doc_id, r.n_lines, list(r.dropped)) for r in line_dedup.report(odd).collect()), key=str)
    assert got == sorted([(None, 1, []), (1, 1, [0]), (1, 1, [0]), (2, 0, [])], key=str)
    assert line_dedup.report(odd.limit(0)).count() == 0


def test_line_dedup_copies_fill_no_bucket(table, monkeypatch):
    """Each slice that has a line put it in its buckets once more, and lines that stay for sure were joined and sorted."""
    line = "a line of many words that every document has"
    docs = table(*[(i, f"{line}\n{random.Random(i).getrandbits(240):060x}", "a") for i in range(40)], (40, line + ".", "a"))
    kept = {}

    def spy(df, label):
        kept.setdefault(label, []).append(found := stage(df, label))
        found.rows = found.collect()
        return found

    monkeypatch.setattr(buckets, "stage", spy)
    monkeypatch.setattr(line_dedup, "stage", spy)
    got = {r.doc_id: r for r in line_dedup.report(docs.repartition(8)).collect()}
    assert {i: list(r.dropped) for i, r in got.items()} == {0: [], **{i: [0] for i in range(1, 41)}}
    assert {tuple(r.kept_doc_ids) for i, r in got.items() if i} == {(0,)}
    assert max(r["rows"] for r in kept["buckets"][0].rows) == 2
    assert len(kept["named"][0].rows) == 41


def test_signatures_do_not_depend_on_blocks(monkeypatch):
    lines = [sentence(random.Random(n), n % 30 + 1) + "\u00e9" * (n % 2) for n in range(80)] + ["x", "\U0001F600"]
    whole = line_dedup.signatures(lines)
    for size in (1, 100, 1000):
        monkeypatch.setattr(line_dedup, "BLOCK_CHARS", size)
        assert (line_dedup.signatures(lines) == whole).all()


def labelled(spark, draw, n=300):
    rows, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        words = sentence(draw, draw.randrange(30, 120)).capitalize().split()
        text = ". ".join(" ".join(words[k : k + 9]) for k in range(0, len(words), 9))
        rows.append((i, text if good else " ".join(f"{w.upper()}!!" if i % 8 else f"{w}***" for w in words), "s"))
        if i % 2 or i % 3:
            labels.append((i, int(good), 0))
    labels += [(None, 1, 0), (5, None, 0), (7, 1, 0), (99_999, 1, 0)]
    return rows, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_classifier_separates_held_out_rows(spark, table):
    rows, labels = labelled(spark, random.Random(2))
    docs = table(*rows, (None, None, None), (7000, "", "s"), (7001, LONG, "s"), (1, rows[1][1], "s"))
    model = quality_classifier.train(docs, labels)
    assert 0.5 < model.prior < 0.95
    got = quality_classifier.classify(docs, model).collect()
    assert len(got) == len(rows) + 4 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 7000]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held)
    assert sum(r.predicted == int(r.doc_id % 4 != 0) for r in held) >= 0.95 * len(held)
    kept = quality_classifier.accepted(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in got)


def test_classifier_without_data(spark, table):
    _, labels = labelled(spark, random.Random(2), 4)
    empty = table((1, "a", "s")).limit(0)
    model = quality_classifier.train(empty, labels)
    assert quality_classifier.classify(empty, model).count() == 0
    assert {r.score for r in quality_classifier.classify(table((1, "a", "s")), model).collect()} == {0.5}


def test_prior_estimate():
    draw = np.random.default_rng(3)
    good, bad = draw.normal(2, 1, 4000), draw.normal(-2, 1, 4000)
    mixed = np.concatenate([good[:1400], bad[:600]])
    assert quality_classifier.estimate_prior(draw.normal(2, 1, 2000), mixed) == pytest.approx(0.7, abs=0.08)


def base_row(text):
    words, seen, dup = SPACE.findall(text or ""), set(), 0
    for line in (text or "").split("\n"):
        if SPACE.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    covered = {k for i, w in enumerate(windows) if times[w] > 1 for k in range(i, i + 8)}
    counts = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered))
    return (*counts, len(words) < 20 or 100 * len(covered) > 30 * len(words))


def test_quality_rules_against_brute_force(spark, table):
    draw = random.Random(9)
    rows, labels = labelled(spark, draw)
    extra = [None, "", " \n\t", "a " * 40, "é ü\n# *\né ü\n\n \n# *", "x y z", LONG, "w " * 7 + "q", "a b c d e f g h " * 2]
    extra += ["\n".join(["same line"] * 15 + [sentence(draw, 30)])]
    rows += [(1000 + i, text, "s") for i, text in enumerate(extra)] + [(None, extra[3], None)]
    docs = table(*rows)
    weights, least = quality_rules.train(docs, labels)
    got = quality_rules.judge(docs, weights, least).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter((r.doc_id, *(r[n] for n in names)) for r in got) == Counter((i, *base_row(t)) for i, t, _ in rows)
    assert all(r.kept == (not r.base_failed and r.score >= least) for r in got)
    judged = [r for r in got if r.doc_id is not None and r.doc_id < 1000 and not r.base_failed]
    assert sum(r.kept == (r.doc_id % 4 != 0) for r in judged) >= 0.97 * len(judged)
    # The ratio of one text by hand.
    cell, _ = quality_rules.cells(*arrays.hash_words([rows[1][1].encode()], arrays.BY_SPACE))
    assert next(r.score for r in got if r.doc_id == 1) == pytest.approx(weights[cell].mean())


def test_quality_rules_without_data(spark, table):
    _, labels = labelled(spark, random.Random(2), 4)
    empty = table((1, "a", "s")).limit(0)
    weights, least = quality_rules.train(empty, labels)
    assert least == -math.inf and quality_rules.judge(empty, weights, least).count() == 0


def test_threshold():
    assert quality_rules.threshold(np.array([0.0, 1.0, 3.0, 4.0]), np.array([0, 0, 1, 1])) == 2.0
    assert quality_rules.threshold(np.array([1.0, 2.0]), np.array([1, 1])) == -math.inf


def brute_tree(training, text, depth):
    """Context-tree weighting with one dictionary, recursively."""
    edge = context_tree.EDGE
    nodes = defaultdict(lambda: [0, 0])
    walk = lambda t: (([edge] * depth + list(t) + [edge], i) for i in range(depth, depth + len(t) + 1))
    for t in training:
        for data, i in walk(t):
            for d in range(depth + 1):
                context, known = tuple(data[i - d : i][::-1]), 1
                for step in range(8):
                    bit = data[i] >> (7 - step) & 1
                    nodes[context, known][bit] += 1
                    known = known << 1 | bit
    children = defaultdict(list)
    for context, known in list(nodes):
        if context:
            children[context[:-1], known].append((context, known))

    def estimate(key):
        a, b = nodes[key]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    weighted = {}
    for key in sorted(nodes, key=lambda k: -len(k[0])):
        own = estimate(key)
        below = sum(weighted[c] for c in children[key])
        weighted[key] = own if len(key[0]) == depth else math.log(0.5 * math.exp(own - below) + 0.5) + below
    total = 0.0
    for data, i in walk(text):
        known = 1
        for step in range(8):
            bit = data[i] >> (7 - step) & 1
            p = None
            for d in range(depth, -1, -1):
                key = tuple(data[i - d : i][::-1]), known
                if key not in weighted:
                    continue
                a, b = nodes[key]
                own = ((b if bit else a) + 0.5) / (a + b + 1)
                share = math.exp(estimate(key) - math.log(2) - weighted[key])
                p = own if p is None or d == depth else share * own + (1 - share) * p
            total += math.log10(0.5 if p is None else p)
            known = known << 1 | bit
    return total


def test_context_tree_against_brute_force(table):
    draw = random.Random(5)
    rows = [(i, sentence(draw, draw.randrange(12), 12).title(), "s") for i in range(40)] + [(50, None, "s"), (51, "É!", None)]
    rows += [(3, rows[3][1], "s"), (None, "v1 v2", "s")]
    got = context_tree.score(table(*rows)).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    lower = lambda t: (t or "").encode().lower()
    training = [lower(t) for i, t, _ in rows if not held(i)]
    counts = Counter(w for t in training for w in [*t.split(), b"\n"])
    n, v = sum(counts.values()), len(counts)
    assert any(held(i) for i, _, _ in rows) and len(got) == len(rows)
    want = Counter()
    scores = defaultdict(list)
    for i, t, _ in rows:
        words = [*lower(t).split(), b"\n"]
        want[i, held(i), len(words), sum(counts[w] > 0 for w in words), n] += 1
        scores[i].append(
            (sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words), brute_tree(training, lower(t), context_tree.DEPTH))
        )
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in got) == want
    for r in got:
        assert any(
            r.base_score == pytest.approx(base) and r.score == pytest.approx(model, rel=1e-5) for base, model in scores[r.doc_id]
        )
        size = len(lower(next(t for i, t, _ in rows if i == r.doc_id))) + 1
        assert r.doc_id == 3 or r.bits_per_byte == pytest.approx(-r.score * math.log2(10) / size)


def test_context_tree_in_many_blocks_and_parts(table, monkeypatch):
    draw = random.Random(8)
    docs = table(*[(i, sentence(draw, 30), "s") for i in range(80)])
    whole = sorted(map(tuple, context_tree.score(docs).collect()))
    for name, value in (("BLOCK_BYTES", 60), ("MOST_SHARDS", 2), ("FAN", 2)):
        monkeypatch.setattr(context_tree, name, value)
    again = sorted(map(tuple, context_tree.score(docs.repartition(3)).collect()))
    assert [r[:5] for r in whole] == [r[:5] for r in again]
    assert np.allclose([r[5:] for r in whole], [r[5:] for r in again])
    assert context_tree.score(docs.limit(0)).count() == 0


def test_threshold_of_counted_scores():
    scores, good = np.array([0.0, 1.0, 3.0, 4.0]), np.array([0, 1, 0, 1])
    times = np.array([5, 1, 1, 7])
    spread = np.repeat(np.arange(4), times)
    assert quality_rules.threshold(scores, good, times) == quality_rules.threshold(scores[spread], good[spread])


def test_one_id_on_most_rows_does_not_fill_the_driver(spark):
    """A trusted id with a third of the rows: the fit holds no more rows than the bound."""
    rows = [(1, f"text number {i} of one id") for i in range(900)] + [(i, f"other text {i}") for i in range(2, 1800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    seen = []
    old = quality_classifier.Model
    try:
        quality_classifier.Model = lambda positive, unlabelled, *_: seen.append((len(positive), len(unlabelled)))
        quality_classifier.train(docs, labels, most_positive=50, most_unlabelled=80)
    finally:
        quality_classifier.Model = old
    assert 10 < seen[0][0] <= 100 and 30 < seen[0][1] <= 150


def test_moments_cover_all_rows(spark):
    texts = [f"Text {i}, with {i % 7} words!" * (i % 5) for i in range(200)]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    mean, spread = quality_classifier.moments(rows)
    found = quality_classifier.features(texts).astype(float)
    assert np.allclose(mean, found.mean(axis=0), rtol=1e-5) and np.allclose(spread, found.std(axis=0), atol=1e-4)
