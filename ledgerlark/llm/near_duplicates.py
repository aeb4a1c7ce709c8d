"""Near-duplicate documents by ProbMinHash.

A text is a weighted set: its runs of five words, weighted by how often they
occur. Every element is a Poisson process whose rate is its weight; each of its
arrivals falls on one of the components of the signature, and a component keeps
the element of its earliest arrival. A process ends as soon as its next arrival
comes after the latest of the arrivals kept. Two signatures agree in a
component with the probability Jaccard of the two weighted sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.arrays import ALPHANUMERIC, U64, encode, fold, hash_words, mix64, shingles, slices, weighted
from ledgerlark.llm.buckets import FACT_TYPES, FACTS, crowded, facts, nodes_of, settle
from ledgerlark.session import stage, unstage

WORDS = 5
SIMILARITY = 0.8
# A pair at the threshold agrees in a band of five with 0.33, and so misses all
# 24 bands with 0.00007; a pair at 0.3 meets in one band with 0.06.
BANDS, ROWS = 24, 5

_STEP = 0x9E3779B97F4A7C15


def signatures(elements: np.ndarray, owner: np.ndarray, weights: np.ndarray, texts: int, size: int) -> np.ndarray:
    """A row of ``size`` components for every text; ``owner`` ascends."""
    earliest = np.full(texts * size, np.inf)
    kept = np.zeros(texts * size, U64)
    arrival = np.zeros(len(elements))
    e, d, w = elements, owner, weights.astype(float)
    turn = 0
    while len(e):
        turn += 1
        draw = mix64(e + U64(turn * _STEP % 2**64))
        arrival = arrival - np.log1p(-((draw >> U64(11)).astype(float) * 2.0**-53)) / w
        slot = d * size + (mix64(draw + U64(_STEP)) % U64(size)).astype(np.int64)
        np.minimum.at(earliest, slot, arrival)
        won = arrival == earliest[slot]
        kept[slot[won]] = e[won]
        alive = d[np.concatenate([[True], d[1:] != d[:-1]])]
        latest = np.zeros(texts)
        latest[alive] = earliest.reshape(texts, size)[alive].max(axis=1)
        go = arrival < latest[d]
        e, d, w, arrival = e[go], d[go], w[go], arrival[go]
    return kept.reshape(texts, size)


def bands(signature: np.ndarray, count: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One hash for each band, different for equal values of different bands."""
    parts = signature.reshape(len(signature), count, rows)
    salt = mix64(np.arange(1, count + 1, dtype=U64))
    return fold([parts[:, :, j] for j in range(rows)]) ^ salt


def _weighted_texts(texts) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    coded = encode(texts, lower=True)
    for start, end in slices(coded):
        hashes, counts = hash_words(coded[start:end], ALPHANUMERIC)
        yield start, end, *weighted(*shingles(hashes, counts, WORDS))


def _sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for start, end, elements, owner, counts in _weighted_texts(batch["text"]):
            found = bands(signatures(elements, owner, counts, end - start, BANDS * ROWS)).view(np.int64)
            some = np.bincount(owner, minlength=end - start) > 0
            rows = batch.iloc[start:end][["id", "t"]].copy()
            rows["bands"] = [row if full else None for row, full in zip(found, some, strict=True)]
            yield rows


SKETCH = f"t bigint, e array<bigint>, w array<int>, {FACT_TYPES}"


def _sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for start, end, elements, owner, counts in _weighted_texts(batch["text"]):
            cuts = np.searchsorted(owner, np.arange(end - start + 1))
            rows = batch.iloc[start:end][["t"]].copy()
            spans = list(zip(cuts[:-1], cuts[1:], strict=True))
            orders = [np.argsort(elements[a:b]) for a, b in spans]
            rows["e"] = [elements[a:b][o].view(np.int64) for (a, b), o in zip(spans, orders, strict=True)]
            rows["w"] = [counts[a:b][o].astype(np.int32) for (a, b), o in zip(spans, orders, strict=True)]
            yield rows.assign(**facts(owner, elements, counts, end - start))


def similarity(e1, w1, e2, w2) -> tuple[float, float]:
    """Probability Jaccard and plain Jaccard of two weighted sets."""
    e1, e2, x, y = np.asarray(e1), np.asarray(e2), np.asarray(w1, float), np.asarray(w2, float)
    common, i, j = np.intersect1d(e1, e2, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0, 0.0
    plain = len(common) / (len(e1) + len(e2) - len(common))
    cx, cy = x[i], y[j]
    left, right = x.sum() - cx.sum(), y.sum() - cy.sum()
    ratios, at = np.unique(cy / cx, return_inverse=True)
    sums = np.array([np.maximum(cx, cy / r).sum() + left + right / r for r in ratios])
    return float((cx / sums[at]).sum()), plain


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        good = [
            max(similarity(*pair)) >= SIMILARITY
            for pair in zip(batch["e1"], batch["w1"], batch["e2"], batch["w2"], strict=True)
        ]
        yield batch.loc[good, ["a", "b"]]


def _elements(batch: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]]:
    """The runs of every text with their counts."""
    for start in range(0, len(batch), 100):
        part = batch.iloc[start : start + 100]
        owner = np.repeat(np.arange(len(part)), [len(e) for e in part["e"]])
        yield part, owner, np.concatenate(part["e"].tolist()).view(U64), np.concatenate(part["w"].tolist())


def text_key(text: Column) -> Column:
    """A hash of the text; a null text counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _links(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    one = sketches.select(F.col("t").alias("a"), F.col("e").alias("e1"), F.col("w").alias("w1"))
    two = sketches.select(F.col("t").alias("b"), F.col("e").alias("e2"), F.col("w").alias("w2"))
    return pairs.join(one, "a").join(two, "b").mapInPandas(_verify, "a bigint, b bigint")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int = 5) -> DataFrame:
    """The class of near-duplicates of every distinct (id, text).

    Returns ``id``, ``t`` (a hash of the text), ``copies`` (equal rows),
    ``class_id`` (the smallest id of the class), ``class_t`` (the smallest text
    hash among the rows with that id) and ``class_size`` (rows).

    Equal texts are one node from the start. In a bucket, that is a band value
    that several texts share, all pairs are compared if the bucket is small. In a
    larger one every text is compared with the first one; texts that are then
    still in different components are compared with their neighbours in an order
    that is drawn anew in every round, until a round finds no link (at most
    ``rounds``), and at last with every text that a prefix filter on the rarest
    runs leaves. All comparisons are exact: linked is
    what has a probability Jaccard, or a plain one, of at least 0.8. Similar
    texts of a bucket are always in one class.

    Null and empty texts are equal texts; texts without words are near nothing
    but their equals; a text of fewer than five words is one run. A null id is
    smaller than any other. Repeated rows are one node. An empty table gives no
    rows. Other columns are not read.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("id"), text_key(F.col(text)).alias("t"), F.col(text).alias("text"))
    members = stage(rows.mapInPandas(_sign, f"id {kind}, t bigint, bands array<bigint>"), "signatures")
    texts = stage(
        members.groupBy("t").agg(F.min(F.struct("id")).alias("first"), F.count("*").alias("size")).select(
            "t", F.col("first.id").alias("first"), "size"
        ),
        "texts",
    )
    rows_of = crowded(members)
    wanted = nodes_of(rows_of)
    first = texts.select(F.col("t").alias("of"), "first")
    near = rows.join(wanted, "t").select("id", "t", "text")
    chosen = near.join(first, (F.col("t") == F.col("of")) & F.col("id").eqNullSafe(F.col("first"))).select("t", "text")
    sketches = stage(chosen.mapInPandas(_sketch, SKETCH), "sketches")
    labels = settle(
        rows_of,
        lambda pairs: _links(pairs, sketches),
        sketches.select("t", "e", "w"),
        sketches.select("t", *FACTS),
        _elements,
        SIMILARITY,
        rounds,
        weighted=True,
    )
    unstage(sketches, rows_of)
    named = texts.join(labels.withColumnRenamed("node", "t"), "t", "left").withColumn("label", F.coalesce("label", "t"))
    heads = (
        named.groupBy("label")
        .agg(F.min(F.struct("first", "t")).alias("head"), F.sum("size").alias("class_size"))
        .select("label", F.col("head.first").alias("class_id"), F.col("head.t").alias("class_t"), "class_size")
    )
    found = named.join(heads, "label").select("t", "class_id", "class_t", "class_size")
    counted = members.groupBy("id", "t").agg(F.count("*").alias("copies"))
    return counted.join(found, "t")


def report(docs: DataFrame, **options) -> DataFrame:
    """One row for every row of ``docs``: id, class and how many rows the class has."""
    found = classes(docs, **options)
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(
        F.col("id").alias("doc_id"), "class_id", "class_size"
    )


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class: that of the smallest id.

    Of equal ids the smallest text hash counts, and of equal rows one stays.
    """
    heads = classes(docs, doc_id, text, **options).select("class_id", "class_t").distinct()
    packed = docs.select(
        F.struct("*").alias("doc"), F.col(doc_id).alias("id"), text_key(F.col(text)).alias("t")
    )
    kept = packed.join(
        heads, (F.col("t") == F.col("class_t")) & F.col("id").eqNullSafe(F.col("class_id")), "left_semi"
    )
    return kept.dropDuplicates(["id", "t"]).select("doc.*")
