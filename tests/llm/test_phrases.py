"""Phrase collocations against counts of all phrases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerlark.llm import phrases
from ledgerlark.llm.phrases import collocations, merge_step


def brute(docs, least=30, ranked=2000):
    counts, total = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, 5):
                for at in range(len(words) - size + 1):
                    counts[lang][tuple(words[at : at + size])] += 1
    rows = []
    for lang, f in counts.items():
        found = []
        candidates = {p: a for p, a in f.items() if len(p) >= 2 and a >= least}
        for p, a in candidates.items():
            around = [
                b for q, b in candidates.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ]
            if any(100 * b >= 80 * a for b in around):
                continue
            cuts = [(2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), left, right))
        found.sort()
        for place, (score, a, phrase, left, right) in enumerate(found[:ranked], 1):
            rows.append((lang, place, phrase.decode(), -a, left, right, total[lang], -score))
    return rows


def texts(seed, n):
    draw = random.Random(seed)
    vocabulary = ["the", "The", "of", "é", "zu", "x", "new", "york", "city", "hall"]
    weights = [30, 4, 12, 5, 4, 3, 6, 2, 2, 2]
    for _ in range(n):
        words = draw.choices(vocabulary, weights=weights, k=draw.randrange(40))
        for _ in range(draw.randrange(3)):
            at = draw.randrange(len(words) + 1)
            words[at:at] = ["new", "york", "city", "hall"][: draw.choice([2, 3, 4, 4])]
        yield "".join(w + draw.choice([" ", " ", " ", " ", "  ", "\t", ", ", ".", "\n"]) for w in words)


@pytest.mark.parametrize(("chunk", "ranges"), [(200_000, 4), (1, 4), (7, 40)])
def test_against_all_phrases(spark, rows, monkeypatch, chunk, ranges):
    monkeypatch.setattr(phrases, "CHUNK", chunk)
    draw = random.Random(1)
    docs = [(t, draw.choice(["en", "en", "de", None])) for t in texts(chunk, 260)]
    docs += [("only words of one copy here", "fr")] * 31 + [(None, "en"), ("", "de"), (" \t.,", None), (",,a b", "")]
    frame = spark.createDataFrame([(*d, 1, "w") for d in docs], "text string, lang string, n int, word string")
    settings = {
        "spark.sql.shuffle.partitions": str(ranges),
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(min(chunk, 10_000)),
    }
    old = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        found = collocations(frame.repartition(3))
        assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        wanted = brute(docs)
        assert len(wanted) > 40 and {r[0] for r in wanted} == {"en", "de", "und", "fr"}
        assert rows(found) == sorted(wanted, key=lambda row: [(v is not None, str(v)) for v in row])
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


def test_first_of_a_language_with_ties(spark, rows):
    docs = [("aa bb, cc dd, ee ff, gg hh", "en")] * 30 + [("bb aa", "en")]
    frame = spark.createDataFrame(docs, "text string, lang string")
    assert rows(collocations(frame, ranked=3)) == sorted(brute(docs, ranked=3), key=str)


def test_empty_table(spark):
    assert collocations(spark.createDataFrame([], "text string, lang string")).count() == 0


def test_a_step_of_the_merge():
    sizes = np.array([2, 3, 1, 2, 3, 4, 4, 2, 1])
    counts = np.array([9, 7, 50, 8, 6, 5, 4, 20, 3])
    above, most = merge_step(sizes, counts, np.zeros(9, np.int64))
    assert above.tolist() == [[-1, -1, -1, 2, 2, 2, 2, 2, -1], [-1, 0, -1, -1, 3, 3, 3, -1, -1], [-1, -1, -1, -1, -1, 4, 4, -1, -1]]
    assert most.tolist() == [7, 0, 20, 6, 5, 0, 0, 0, 0]
