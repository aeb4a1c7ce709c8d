"""Quality rules: counts of a text, and a likelihood ratio of its hashed n-grams.

Two multinomials over hashed words and word pairs are counted: one of a trusted
target, one of the whole raw corpus. A text is judged by the mean logarithm of
their ratio over its n-grams, against one threshold for all texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.arrays import BY_SPACE, U64, encode, fold, hash_words, mix64, slices
from ledgerlark.llm.bitmarks import keep_marked, marks_of
from ledgerlark.session import stage

# Cells of the hashed multinomials, and what is added to each count.
BITS = 16
SMOOTHING = 1.0
# Steps that the scores of labelled rows are counted in, to place the threshold.
STEP = 0.0001
# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
REPEAT_WORDS = 8
LEAST_WORDS = 20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def cells(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell and text number of all words and of all pairs of neighbouring words."""
    text = np.repeat(np.arange(len(counts)), counts)
    pair = np.flatnonzero(text[1:] == text[:-1]) if len(text) else np.zeros(0, np.int64)
    found = np.concatenate([hashes, fold([hashes[pair], hashes[pair + 1]])]) if len(pair) else hashes
    return (found >> U64(64 - BITS)).astype(np.int64), np.concatenate([text, text[pair]])


def base_counts(part: list[bytes], hashes: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of the base rules for every text."""
    n = len(part)
    data = np.frombuffer(b"".join(part), np.uint8)
    of = np.repeat(np.arange(n), [len(c) for c in part])
    letter = (BY_SPACE[data] == 1) & ((data & 0xC0) != 0x80)
    repeated = np.zeros(n, np.int64)
    for i, c in enumerate(part):
        lines = [line for line in c.split(b"\n") if line.strip()]
        repeated[i] = len(lines) - len(set(lines))
    text = np.repeat(np.arange(n), counts)
    runs = max(0, len(hashes) - REPEAT_WORDS + 1)
    again = np.zeros(n, np.int64)
    if runs:
        whole = np.flatnonzero(text[:runs] == text[len(text) - runs :])
        window = fold([hashes[whole + j] for j in range(REPEAT_WORDS)]) + mix64(text[whole].astype(U64) + U64(1))
        _, back, times = np.unique(window, return_inverse=True, return_counts=True)
        twice = whole[times[back] > 1]
        cover = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(cover, twice, 1)
        np.add.at(cover, twice + REPEAT_WORDS, -1)
        again = np.bincount(text[np.cumsum(cover[:-1]) > 0], minlength=n)
    return {
        "n_words": counts.astype(np.int64),
        "word_chars": np.bincount(of[letter], minlength=n),
        "n_symbols": np.bincount(of[_SYMBOL[data]], minlength=n),
        "n_dup_lines": repeated,
        "n_repeat_words": again,
    }


def ratio(hashes: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Mean log ratio by text; 0 for a text without words."""
    cell, text = cells(hashes, counts)
    size = np.maximum(np.bincount(text, minlength=len(counts)), 1)
    return np.bincount(text, weights=weights[cell], minlength=len(counts)) / size


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros(1 << BITS, np.int64)
    for batch in batches:
        coded = encode(batch["text"], lower=False)
        for start, end in slices(coded):
            cell, _ = cells(*hash_words(coded[start:end], BY_SPACE))
            total += np.bincount(cell, minlength=1 << BITS)
    used = np.flatnonzero(total)
    yield pd.DataFrame({"cell": used.astype(np.int32), "n": total[used]})


def counted(texts: DataFrame) -> np.ndarray:
    """Words and word pairs of all rows (``text``) by cell: 65,536 numbers at most leave a task."""
    found = texts.select("text").mapInPandas(_count, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(1 << BITS)
    total[found["cell"]] = found["n"]
    return total


def perhaps(rows: DataFrame, judged: DataFrame) -> DataFrame:
    """The rows (``id``, ``text``) that may have a label (``judged``), and a few others.

    Bits of the ids let a task drop the rest, however many labels there are.
    """
    marks = marks_of(judged.select(F.xxhash64("judged").alias("key")), "key")
    keyed = rows.withColumn("key", F.when(F.col("id").isNotNull(), F.xxhash64("id")))
    return keep_marked(keyed, "key", marks).select("id", "text")


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality"
) -> tuple[np.ndarray, float]:
    """The log ratio of every cell, and the threshold.

    The raw counts cover all rows of ``docs``, the target all rows with quality 1. The threshold is
    the one that best parts all rows with a label, among texts that the base rules pass (mean of both
    hit rates; in the middle of the gap); it is read off counts of scores in steps of 0.0001. Without
    labels of both kinds it is minus infinity.

    An id labelled twice has the lower quality; null ids and qualities, and labels without a
    document, count for nothing. Rows that repeat an id count one by one.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    judged = stage(
        labels.select(F.col(doc_id).alias("judged"), F.col(quality).alias("quality"))
        .filter("judged IS NOT NULL AND quality IN (0, 1)")
        .groupBy("judged")
        .agg(F.min("quality").cast("int").alias("quality")),
        "judged",
    )
    same = F.col("id") == F.col("judged")
    trusted = judged.filter("quality = 1")
    # One plan at every size: the hint keeps Spark from sending few labels to the texts.
    totals = np.stack([counted(rows), counted(perhaps(rows, trusted).join(trusted.hint("merge"), same, "left_semi"))])
    shares = (totals + SMOOTHING) / (totals.sum(axis=1, keepdims=True) + SMOOTHING * (1 << BITS))
    weights = np.log(shares[1]) - np.log(shares[0])
    kind = docs.schema[doc_id].dataType.simpleString()
    # Scores meet their labels, not texts.
    scored = _scored(perhaps(rows, judged), weights, f"id {kind}").filter(~F.col("base_failed")).select("id", "score")
    passed = scored.join(judged.hint("merge"), same)
    steps = passed.groupBy(F.round(F.col("score") / STEP).alias("step"), "quality").agg(F.count("*").alias("n")).toPandas()
    return weights, threshold(
        steps["step"].to_numpy(float) * STEP, steps["quality"].to_numpy(int), steps["n"].to_numpy(np.int64)
    )


def threshold(scores: np.ndarray, good: np.ndarray, times: np.ndarray | None = None) -> float:
    """The cut with the best mean of both hit rates; ``times`` says how often a score occurs."""
    if not (good == 1).any() or not (good == 0).any():
        return -np.inf
    order = np.argsort(scores, kind="stable")
    s, g = scores[order], good[order]
    n = np.ones(len(s)) if times is None else times[order].astype(float)
    lost = np.cumsum(n * (g == 1)) / n[g == 1].sum()
    caught = np.cumsum(n * (g == 0)) / n[g == 0].sum()
    ends = np.flatnonzero(np.append(s[1:] > s[:-1], True))
    best = ends[np.argmax((caught - lost)[ends])]
    if caught[best] <= lost[best]:
        return -np.inf
    return float((s[best] + s[min(best + 1, len(s) - 1)]) / 2)


def _scored(rows: DataFrame, weights: np.ndarray, extra: str) -> DataFrame:
    names = [field.split(" ")[0] for field in extra.split(", ")]
    sent = rows.sparkSession.sparkContext.broadcast(weights)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            coded = encode(batch["text"], lower=False)
            for start, end in slices(coded):
                hashes, counts = hash_words(coded[start:end], BY_SPACE)
                found = batch.iloc[start:end][names].reset_index(drop=True)
                yield found.assign(
                    **base_counts(coded[start:end], hashes, counts), score=ratio(hashes, counts, sent.value)
                )

    longs = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return rows.mapInPandas(judge, f"{extra}, {longs}, score double").withColumn("base_failed", failed)


def judge(
    docs: DataFrame, weights: np.ndarray, least: float, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Counts, ``base_failed``, ``score`` and ``kept`` of every row of ``docs``.

    A null text has no words and so fails; ids may be null or repeated; equal
    texts have equal rows; a score equal to the threshold is kept. An empty
    table gives no rows. Other columns are not read.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return _scored(rows, weights, f"doc_id {kind}").withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= F.lit(float(least)))
    )
