"""The best documents for a set of queries, by range maxima over posting lists.

Documents are indexed in blocks. A block holds, for every query term, the list of
its documents with their impacts (what the term adds to a document's score) and a
sparse table of range maxima over that list. The search of a query in a block
keeps intervals of documents. The sum of the terms' maxima in an interval bounds
the score of every document in it. The interval with the highest bound is split
at the document of its greatest impact: that document gets its exact score, and
the two parts go back with bounds of their own. What is below the lowest of the
best scores so far is never opened.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerlark.llm.arrays import ALPHANUMERIC, encode, hash_words, slices
from ledgerlark.session import stage

BEST = 10
# 75 % of a document's weight follows its length; eight parts of it weigh against a thousandfold tf.
LENGTH_SHARE, LENGTH_FACTOR, SCALE = 75, 8, 1_000_000_000
# Documents and postings of a block at most; a document is never cut.
BLOCK_DOCS, BLOCK_POSTINGS = 8192, 1_000_000
# Blocks that a task searches at least, and tasks at most.
BLOCKS_A_TASK, MOST_TASKS = 2, 50_000
# Pairs of query and term that are searched for together, 24 bytes each in every task; more make more passes.
MOST_PAIRS = 1_000_000
# Queries that are searched together in a block, and intervals of each that are split in a step at most.
QUERIES_AT_ONCE, SPLIT_AT_ONCE = 128, 32


class Queries(NamedTuple):
    """Queries as rows of (query, term, times), ordered by query; ``vocabulary`` ascends."""

    numbers: np.ndarray
    begins: np.ndarray
    terms: np.ndarray
    times: np.ndarray
    vocabulary: np.ndarray


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["q", "term", "times"]
    for batch in batches:
        coded = encode(batch.column(1).to_pylist(), lower=True)
        numbers = batch.column(0).to_numpy()
        for start, end in slices(coded):
            hashes, counts = hash_words(coded[start:end], ALPHANUMERIC)
            pairs = np.stack([np.repeat(numbers[start:end], counts), hashes.view(np.int64)])
            rows, times = np.unique(pairs, axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0]), pa.array(rows[1]), pa.array(times)], names)


def _queries(rows: DataFrame) -> Queries:
    found = rows.toPandas().sort_values(["q", "term"])
    numbers, begins = np.unique(found["q"].to_numpy(np.int64), return_index=True)
    vocabulary, at = np.unique(found["term"].to_numpy(np.int64), return_inverse=True)
    return Queries(numbers, np.append(begins, len(found)), at, found["times"].to_numpy(np.int64), vocabulary)


def _index(vocabulary: np.ndarray, kind: pa.DataType, most_docs: int, most_postings: int):
    """Blocks of documents: ids, lengths in terms, and the postings of the vocabulary by term."""
    ids_of = pa.list_(kind)
    numbers = pa.list_(pa.int32())

    def block(ids, lengths, terms, docs, tf) -> pa.RecordBatch:
        term, doc, times = (np.concatenate(part) for part in (terms, docs, tf))
        order = np.lexsort((doc, term))
        every = pa.concat_arrays(ids)
        columns = [
            pa.ListArray.from_arrays(pa.array([0, len(every)], pa.int32()), every).cast(ids_of),
            pa.array([np.concatenate(lengths)], pa.list_(pa.int64())),
            *[pa.array([part[order].astype(np.int32)], numbers) for part in (term, doc, times)],
        ]
        return pa.RecordBatch.from_arrays(columns, ["ids", "lengths", "terms", "docs", "tf"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lengths, terms, docs, tf, count, size = [], [], [], [], [], 0, 0
        for batch in batches:
            coded = encode(batch.column(1).to_pylist(), lower=True)
            for start, end in slices(coded):
                hashes, counts = hash_words(coded[start:end], ALPHANUMERIC)
                at = np.minimum(np.searchsorted(vocabulary, hashes.view(np.int64)), max(len(vocabulary) - 1, 0))
                known = vocabulary[at] == hashes.view(np.int64) if len(vocabulary) else np.zeros(len(hashes), bool)
                owner = np.repeat(np.arange(end - start), counts)[known]
                keys, times = np.unique(owner * max(len(vocabulary), 1) + at[known], return_counts=True)
                ids.append(batch.column(0)[start:end])
                lengths.append(counts)
                docs.append(keys // max(len(vocabulary), 1) + count)
                terms.append(keys % max(len(vocabulary), 1))
                tf.append(np.minimum(times, 2**31 - 1))
                count, size = count + end - start, size + len(keys)
                if count >= most_docs or size >= most_postings:
                    yield block(ids, lengths, terms, docs, tf)
                    ids, lengths, terms, docs, tf, count, size = [], [], [], [], [], 0, 0
        if count:
            yield block(ids, lengths, terms, docs, tf)

    return build


class Postings:
    """The postings of a block with range maxima over each list."""

    def __init__(self, terms: np.ndarray, docs: np.ndarray, impacts: np.ndarray, size: int):
        self.size, self.docs, self.impacts = size, docs, impacts
        self._keys = terms.astype(np.int64) * size + docs
        longest = int(np.bincount(terms).max()) if len(terms) else 1
        levels = [np.arange(len(docs), dtype=np.int32)]
        # Level k has the place of the greatest of the 2^k impacts from a place on. Ranges that pass the
        # end of a term's list are filled in too, but never asked for.
        while (1 << len(levels)) <= longest:
            low = levels[-1]
            other = low[np.minimum(np.arange(len(low)) + (1 << (len(levels) - 1)), len(low) - 1)]
            levels.append(np.where(impacts[other] > impacts[low], other, low))
        self._table = np.stack(levels)

    def greatest(self, terms: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Place of the greatest impact of each term in documents ``low`` to ``high``; -1 if it has none there."""
        first = np.searchsorted(self._keys, terms * self.size + low)
        after = np.searchsorted(self._keys, terms * self.size + high, side="right")
        found = np.full(len(terms), -1, np.int64)
        some = np.flatnonzero(after > first)
        a, b = first[some], after[some]
        level = np.frexp((b - a).astype(float))[1] - 1
        one, two = self._table[level, a], self._table[level, b - (1 << level)]
        found[some] = np.where(self.impacts[two] > self.impacts[one], two, one)
        return found


def _bounds(postings: Postings, queries: Queries, q: np.ndarray, low: np.ndarray, high: np.ndarray):
    """For intervals of documents: the sum of the maxima, and the document with the greatest part in it."""
    begin, end = queries.begins[q], queries.begins[q + 1]
    count = end - begin
    owner = np.repeat(np.arange(len(q)), count)
    starts = np.cumsum(count) - count
    row = begin[owner] + np.arange(len(owner)) - starts[owner]
    place = postings.greatest(queries.terms[row], low[owner], high[owner])
    part = np.where(place >= 0, postings.impacts[place] * queries.times[row], 0)
    total = np.add.reduceat(part, starts)
    most = np.maximum.reduceat(part, starts)
    where = np.where((part == most[owner]) & (place >= 0), place, -1)
    return total, postings.docs[np.maximum.reduceat(where, starts)]


class Best:
    """The best (score, id) of every query so far; equal scores by ascending id, a null id first."""

    def __init__(self, queries: int):
        self.rows: list[list[tuple]] = [[] for _ in range(queries)]
        self.least = np.ones(queries, np.int64)

    def add(self, q: int, scores: np.ndarray, ids: list) -> None:
        rows = self.rows[q] + list(zip(scores.tolist(), ids, strict=True))
        rows.sort(key=lambda r: (-r[0], r[1] is not None, r[1] if r[1] is not None else 0))
        self.rows[q] = rows[:BEST]
        if len(rows) >= BEST:
            self.least[q] = rows[BEST - 1][0]


def search(postings: Postings, queries: Queries, ids, best: Best, turn: np.ndarray) -> int:
    """Add a block's documents that belong to the best of the queries ``turn``; returns how many were scored."""
    q = turn
    low, high = np.zeros(len(q), np.int64), np.full(len(q), postings.size - 1, np.int64)
    bound, split = _bounds(postings, queries, q, low, high)
    at_once, scored = 1, 0
    while True:
        # What equals the last of the best may still come before it by its id.
        open_ = bound >= best.least[q]
        q, low, high, bound, split = (part[open_] for part in (q, low, high, bound, split))
        if not len(q):
            return scored
        order = np.lexsort((-bound, q))
        q, low, high, bound, split = (part[order] for part in (q, low, high, bound, split))
        first = np.flatnonzero(np.diff(q, prepend=-1))
        place = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
        now = place < at_once
        at_once = min(2 * at_once, SPLIT_AT_ONCE)
        nq, nl, nh, nd = q[now], low[now], high[now], split[now].astype(np.int64)
        score, _ = _bounds(postings, queries, nq, nd, nd)
        scored += len(nq)
        good = np.flatnonzero(score >= best.least[nq])
        for one in np.unique(nq[good]):
            mine = good[nq[good] == one]
            best.add(int(one), score[mine], [ids[int(d)].as_py() for d in nd[mine]])
        left, right = nd > nl, nd < nh
        cq = np.concatenate([nq[left], nq[right]])
        cl, ch = np.concatenate([nl[left], nd[right] + 1]), np.concatenate([nd[left] - 1, nh[right]])
        cb, cs = _bounds(postings, queries, cq, cl, ch) if len(cq) else (np.zeros(0, np.int64), np.zeros(0, np.int32))
        rest = ~now
        q, low, high = np.concatenate([q[rest], cq]), np.concatenate([low[rest], cl]), np.concatenate([high[rest], ch])
        bound, split = np.concatenate([bound[rest], cb]), np.concatenate([split[rest], cs])


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    """The weight of a term that ``df`` of all documents hold."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(n) + 1))) for n in df], np.int64)


def _search(queries: Queries, weight: np.ndarray, documents: int, words: int, kind: pa.DataType):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(queries.numbers))
        for batch in batches:
            for row in range(batch.num_rows):
                ids = batch.column(0)[row].values
                lengths, terms, docs, tf = (batch.column(i)[row].values.to_numpy(zero_copy_only=False) for i in range(1, 5))
                if not len(terms):
                    continue
                m = 100 - LENGTH_SHARE + (LENGTH_SHARE * lengths[docs] * documents) // words
                tf = tf.astype(np.int64)
                impacts = weight[terms] * ((SCALE * tf) // (1000 * tf + LENGTH_FACTOR * m))
                postings = Postings(terms, docs, impacts, len(ids))
                for start in range(0, len(queries.numbers), QUERIES_AT_ONCE):
                    turn = np.arange(start, min(start + QUERIES_AT_ONCE, len(queries.numbers)))
                    search(postings, queries, ids, best, turn)
        rows = [(int(queries.numbers[q]), i, s) for q, found in enumerate(best.rows) for s, i in found]
        columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
        types = [pa.int64(), kind, pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["q", "doc_id", "score"])

    return find


def _pass(spark: SparkSession, docs: DataFrame, rows: DataFrame, kind: str) -> DataFrame:
    """The best documents of each task for the queries of ``rows`` (``q``, ``term``, ``times``)."""
    queries = _queries(rows)
    arrow = to_arrow_type(docs.schema["id"].dataType)
    blocks = f"ids array<{kind}>, lengths array<bigint>, terms array<int>, docs array<int>, tf array<int>"
    index = stage(docs.mapInArrow(_index(queries.vocabulary, arrow, BLOCK_DOCS, BLOCK_POSTINGS), blocks), "blocks")
    lengths = F.filter("lengths", lambda n: n > 0)
    total = index.agg(
        F.count("*").alias("blocks"),
        F.sum(F.size(lengths)).alias("documents"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n)).alias("words")
    ).first()
    held = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toPandas()
    df = np.zeros(len(queries.vocabulary), np.int64)
    df[held["term"].to_numpy(np.int64)] = held["df"].to_numpy(np.int64)
    documents, words = int(total["documents"] or 0), max(int(total["words"] or 0), 1)
    # Blocks are short rows with much work each, so they are dealt out by number and not by bytes.
    dealt = index.repartition(max(1, math.ceil(total["blocks"] / max(BLOCKS_A_TASK, total["blocks"] // MOST_TASKS))))
    return dealt.mapInArrow(
        _search(queries, weights(df, documents), documents, words, arrow), f"q bigint, doc_id {kind}, score bigint"
    )


def rank(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of the best documents for every row of ``items``.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII, A-Z lowered; they are
    told apart by 64-bit hashes. Document frequencies, lengths and numbers are those of the whole table.

    Each task keeps the best ten of each query over all its blocks, so scores found early close
    intervals of later blocks, and ten rows a query leave a task. Queries of more than ``MOST_PAIRS``
    query terms together are searched in several passes over the documents.

    Null and empty texts have no terms: such documents are never found, such items find nothing. Repeated
    rows of ``docs`` are documents of their own; repeated rows of ``items`` are items of their own. Equal
    scores are ordered by id, a null id first. Empty tables give no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    asked = stage(
        items.select(F.monotonically_increasing_id().alias("q"), F.col(item_id).alias("item_id"), F.col(item_text).alias("text")),
        "items",
    )
    pairs = stage(asked.select("q", "text").mapInArrow(_terms, "q bigint, term bigint, times bigint"), "item-terms")
    passes = max(1, math.ceil(pairs.count() / MOST_PAIRS))
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    found = None
    for turn in range(passes):
        mine = pairs.filter(F.pmod(F.xxhash64("q"), F.lit(passes)) == turn) if passes > 1 else pairs
        rows = _pass(spark, texts, mine, kind)
        found = rows if found is None else found.unionByName(rows)
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= BEST)
    return best.join(asked.select("q", "item_id"), "q").select("item_id", "rank", "doc_id", "score")
