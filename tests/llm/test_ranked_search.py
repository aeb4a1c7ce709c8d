"""Ranked search against scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerlark.llm import ranked_search
from ledgerlark.llm.ranked_search import Postings, rank

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lowered)


def brute(docs, items):
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n_docs, words = sum(n > 0 for _, _, n in held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    found = []
    for item, text in items:
        scores = []
        for doc, counts, n in held:
            total = 0
            for term, times in Counter(terms(text)).items():
                if counts[term]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    m = 25 + (75 * n * n_docs) // words
                    total += times * weight * ((10**9 * counts[term]) // (1000 * counts[term] + 8 * m))
            if total > 0:
                scores.append((-total, doc is not None, doc))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        found += [(item, place, doc, -s) for place, (s, _, doc) in enumerate(scores[:10], 1)]
    return found


def test_range_maxima():
    draw = np.random.default_rng(3)
    for size in (1, 2, 7, 40):
        pairs = sorted({(int(t), int(d)) for t, d in zip(draw.integers(0, 4, 60), draw.integers(0, size, 60), strict=True)})
        term, doc = np.array(pairs).T
        impact = draw.integers(0, 5, len(pairs))
        postings = Postings(term, doc, impact, size)
        for t in range(4):
            for low in range(size):
                for high in range(low, size):
                    at = postings.greatest(np.array([t]), np.array([low]), np.array([high]))[0]
                    inside = [i for i, (a, b) in enumerate(pairs) if a == t and low <= b <= high]
                    assert (at == -1) == (not inside)
                    assert at == -1 or (at in inside and impact[at] == max(impact[inside]))


@pytest.mark.parametrize("block", [3, 8192])
@pytest.mark.parametrize("pairs", [4, 1_000_000])
def test_against_all_scores(spark, rows, monkeypatch, block, pairs):
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", block)
    monkeypatch.setattr(ranked_search, "MOST_PAIRS", pairs)
    draw = random.Random(block)
    vocabulary = ["the", "The", "of", "é", "Éa", "x1", "x2", "rare", "z.z"]
    text = lambda most: " ".join(draw.choices(vocabulary, weights=[9, 3, 7, 4, 3, 2, 1, 1, 2], k=draw.randrange(most)))
    docs = [(i, text(30)) for i in range(120)]
    docs += [(i, "the rare x2") for i in range(200, 230)] + [(7, "the rare x2"), (None, "rare of"), (500, None), (501, ""), (502, "--")]
    items = [(i, text(12)) for i in range(6)] + [(6, None), (7, ""), (8, "absent"), (9, "rare rare the"), (9, "rare rare the"), (None, "x1 é")]
    frame = spark.createDataFrame([(i, t, -1, "q") for i, t in docs], "doc_id long, text string, score int, term string")
    asked = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id int, text string, rank int")
    found = rank(frame.repartition(4), asked)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(found) == sorted(brute(docs, items), key=lambda row: [(v is not None, str(v)) for v in row])


def test_few_documents_are_scored():
    """Documents without the rare terms of a query stay closed."""
    size = 4000
    docs = np.arange(size)
    rare = np.arange(0, size, 200)
    term = np.concatenate([np.zeros(size, np.int64), np.ones(len(rare), np.int64)])
    doc = np.concatenate([docs, rare])
    impact = np.concatenate([docs % 7 + 1, np.full(len(rare), 1000) + rare]).astype(np.int64)
    queries = ranked_search.Queries(np.array([0]), np.array([0, 2]), np.array([0, 1]), np.array([1, 1]), np.array([5, 6]))
    best = ranked_search.Best(1)
    import pyarrow as pa

    scored = ranked_search.search(Postings(term, doc, impact, size), queries, pa.array(docs), best, np.array([0]))
    wanted = sorted(((1000 + d + d % 7 + 1, d) for d in rare.tolist()), reverse=True)[:10]
    assert [(s, d) for s, d in best.rows[0]] == wanted
    assert scored < 100


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert rank(docs, items).count() == 0
    assert rank(spark.createDataFrame([(1, "a")], "doc_id long, text string"), items.limit(0)).count() == 0
