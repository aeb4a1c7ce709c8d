"""Quality classifier learned from trusted positives and unlabelled text.

Positive-unlabelled learning: the risk of a linear classifier is written with
positives, unlabelled texts and the share of positives among those. The part
of it that stands for the negatives cannot be below zero; where a step would
push it there, the step goes the other way (the non-negative estimator).
Labels of bad quality are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.arrays import BY_SPACE, U64, encode, hash_words, mix64, slices
from ledgerlark.llm.labelled import fold_of, sample
from ledgerlark.session import stage

FOLDS, HELD_OUT = 4, 2
ACCEPT = 0.7
# Rows the classifier is fitted on at most: trusted ones, and unlabelled ones.
MOST_POSITIVE = 20_000
MOST_UNLABELLED = 20_000

# Classes of bytes: 0 lower-case letter, 1 upper-case letter, 2 digit, 3 space,
# 4 line end, 5 punctuation of sentences, 6 other symbol, 7 not ASCII.
CLASSES = 8
_KIND = np.full(256, 6, np.uint8)
for _kind, _bytes in (
    (0, range(97, 123)),
    (1, range(65, 91)),
    (2, range(48, 58)),
    (3, b" \t\x0b\x0c\r"),
    (4, b"\n"),
    (5, b".,;:'\"()-"),
    (7, range(128, 256)),
):
    _KIND[list(_bytes)] = _kind

FEATURES = CLASSES * CLASSES + 6


def features(texts) -> np.ndarray:
    """A row of numbers per text; all but one of an empty text are 0.

    Shares of neighbouring byte classes; of words that equal the one before;
    of words seen before in the text; word length; number of words; lines per
    word; whether there are under ten words. Language does not enter.
    """
    coded = encode(texts, lower=False)
    found = np.zeros((len(coded), FEATURES), np.float32)
    for start, end in slices(coded):
        part = coded[start:end]
        n = end - start
        sizes = np.fromiter((len(c) for c in part), np.int64, n)
        data = np.frombuffer(b"".join(part), np.uint8)
        text = np.repeat(np.arange(n), sizes)
        kind = _KIND[data].astype(np.int64)
        inside = text[1:] == text[:-1] if len(text) else np.zeros(0, bool)
        cell = text[1:] * CLASSES**2 + kind[:-1] * CLASSES + kind[1:] if len(text) else np.zeros(0, np.int64)
        pairs = np.bincount(cell[inside], minlength=n * CLASSES**2).reshape(n, -1)
        hashes, counts = hash_words(part, BY_SPACE)
        word_text = np.repeat(np.arange(n), counts)
        words = np.maximum(counts, 1)
        same = (hashes[1:] == hashes[:-1]) & (word_text[1:] == word_text[:-1])
        again = np.bincount(word_text[1:][same], minlength=n)
        keys = hashes + mix64(word_text.astype(U64) + U64(1))
        distinct = np.bincount(word_text[np.unique(keys, return_index=True)[1]], minlength=n)
        breaks = np.bincount(text[kind == 4], minlength=n)
        found[start:end] = np.column_stack(
            [
                np.sqrt(pairs / np.maximum(sizes - 1, 1)[:, None]),
                again / words,
                (counts - distinct) / words,
                np.minimum(1, sizes / words / 20) * (counts > 0),
                np.log1p(counts) / 10,
                breaks / words,
                counts < 10,
            ]
        )
    return found


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 150, rate: float = 0.5) -> np.ndarray:
    """Weights that minimise the non-negative risk under the sigmoid loss."""
    weights = np.zeros(positive.shape[1])
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        p, u = sigmoid(positive @ weights), sigmoid(unlabelled @ weights)
        slope = prior * (positive.T @ (p * (1 - p))) / len(p)
        negative = u.mean() - prior * p.mean()
        rising = (unlabelled.T @ (u * (1 - u))) / len(u) - slope
        gradient = (rising - slope if negative >= 0 else -rising) + 1e-4 * weights
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        weights -= rate * mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return weights


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, slack: float = 0.5) -> float:
    """Share of positives among unlabelled scores.

    Above any threshold there are at least as many unlabelled texts as the
    positives among them give, so the smallest ratio of the two upper tails
    bounds the share; thresholds with few positives above them are noisy, and
    ``slack`` over the root of the counts weighs against them.
    """
    levels = np.quantile(positive, np.linspace(0, 0.95, 96))
    p = (positive[:, None] >= levels).mean(axis=0)
    u = (unlabelled[:, None] >= levels).mean(axis=0)
    noise = slack * (1 / np.sqrt(len(positive)) + 1 / np.sqrt(len(unlabelled)))
    best = np.argmin((u + noise) / p)
    return float(np.clip(u[best] / p[best], 0.05, 0.99))


class Model:
    """Scaling and weights; without two positives every score is 0.5."""

    def __init__(self, positive: np.ndarray, unlabelled: np.ndarray, mean: np.ndarray, spread: np.ndarray):
        self.prior = None
        if len(positive) < 2 or len(unlabelled) < 2:
            return
        self.mean, self.spread = mean, spread + 1e-3
        good, mixed = self.scaled(positive), self.scaled(unlabelled)
        # The share is read off texts that the first fits have not seen.
        shares = []
        for part in (0, 1):
            first = fit(good[part::2], mixed[part::2], 0.5)
            seen = 1 - part
            shares.append(estimate_prior(good[seen::2] @ first, mixed[seen::2] @ first))
        self.prior = float(np.mean(shares))
        self.weights = fit(good, mixed, self.prior)

    def scaled(self, found: np.ndarray) -> np.ndarray:
        z = np.clip((found - self.mean) / self.spread, -5, 5)
        return np.hstack([z, np.ones((len(z), 1))]) / np.sqrt(z.shape[1] + 1)

    def score(self, texts) -> np.ndarray:
        if self.prior is None:
            return np.full(len(texts), 0.5)
        return sigmoid(self.scaled(features(texts)) @ self.weights)


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"features": list(features(batch["text"]))})


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows, sums and sums of squares of every feature in a task."""
    total = np.zeros((2, FEATURES + 1))
    for batch in batches:
        found = np.hstack([features(batch["text"]).astype(float), np.ones((len(batch), 1))])
        total += [found.sum(axis=0), (found**2).sum(axis=0)]
    yield pd.DataFrame({"feature": np.arange(FEATURES + 1), "total": total[0], "squares": total[1]})


def moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and spread of every feature over all ``rows`` (``text``)."""
    sums = rows.select("text").mapInPandas(_sums, "feature int, total double, squares double")
    found = sums.groupBy("feature").agg(F.sum("total").alias("total"), F.sum("squares").alias("squares")).toPandas()
    found = found.sort_values("feature")
    if not len(found) or not found["total"].iloc[-1]:
        return np.zeros(FEATURES), np.zeros(FEATURES)
    count = found["total"].iloc[-1]
    mean = found["total"].to_numpy()[:-1] / count
    spread = np.sqrt(np.maximum(found["squares"].to_numpy()[:-1] / count - mean**2, 0))
    # Sums of many tasks differ in their last digits from run to run.
    return mean.astype(np.float32).astype(float), spread.astype(np.float32).astype(float)


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
    most_positive: int = MOST_POSITIVE,
    most_unlabelled: int = MOST_UNLABELLED,
) -> Model:
    """Fit on rows outside the held-out fold.

    Means and spreads of the features are those of all these rows. The weights and the class prior
    are fitted on about ``most_positive`` trusted rows (quality 1) and ``most_unlabelled`` others of
    ``docs``, labelled or not, chosen by a hash of id and text; equal rows count once. The features
    of these are what the driver holds, whatever id has most rows.

    Null ids are in no fold and carry no label; labels without a document, and null qualities, count
    for nothing; an id labelled twice is trusted if one of its labels is 1.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).filter(
        fold_of(F.col("id"), FOLDS) != HELD_OUT
    )
    trusted = (
        labels.filter(F.col(quality) == 1)
        .select(F.col(doc_id).alias("id"))
        .filter(fold_of(F.col("id"), FOLDS) != HELD_OUT)
        .distinct()
    )
    by = (F.col("id"), F.xxhash64("text"))
    named = rows.select("id", by[1].alias("hash")).join(trusted, "id", "left_semi")
    # Ids and hashes alone are joined; the sample of them is small enough to be sent to the texts.
    chosen = F.broadcast(stage(sample(named, most_positive, F.col("id"), F.col("hash")), "trusted"))
    positive = rows.withColumn("hash", by[1]).join(chosen, ["id", "hash"], "left_semi").dropDuplicates(["id", "hash"])
    unlabelled = sample(rows, most_unlabelled, *by)
    found = []
    for part in (positive, unlabelled):
        table = part.select("text").mapInPandas(_features, "features array<float>").toPandas()
        found.append(np.array(table["features"].tolist(), np.float32).reshape(-1, FEATURES))
    return Model(*found, *moments(rows))


def classify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for every row of ``docs``.

    The score is read from the text alone. A null text counts as empty; an
    empty one has a score like any other. A row with a null id is not held
    out. Equal texts have equal scores; an empty table gives no rows.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def scores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["id", "held_out"]].assign(score=model.score(batch["text"]))

    rows = docs.select(
        F.col(doc_id).alias("id"), (fold_of(F.col(doc_id), FOLDS) == HELD_OUT).alias("held_out"), F.col(text).alias("text")
    )
    return rows.mapInPandas(scores, f"id {kind}, held_out boolean, score double").select(
        F.col("id").alias("doc_id"), "held_out", "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns, whatever their names.

    A null text counts as empty; a score equal to the bound is accepted; repeated rows stay or go
    together. An empty table gives no rows.
    """

    @F.pandas_udf("boolean")
    def good(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts) >= ACCEPT)

    return docs.filter(good(F.col(text)))
