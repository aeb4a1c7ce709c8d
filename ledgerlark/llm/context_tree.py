"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions. The node of a decision is the context (up to
five bytes before) and the bits of the byte already known. Every node has a
Krichevsky-Trofimov estimate of its counts; its weighted probability is half
that estimate and half the product of its children, the same node with one more
byte of context. The weights give, on the path of a decision from no context to
the longest, the share of each depth. A context that training never met ends
the path: the deepest one met answers as a leaf.

The tree is never in one place. Texts are cut into blocks; every block asks for
the distinct runs of six bytes and the distinct words that it holds, with its
training counts. What is asked is packed by shard: runs whose contexts share
three bytes are in one shard, words are dealt by hash. Shards add up the counts
of all blocks and answer each block. So what moves grows with the corpus, and a
task holds one block, or one shard of the distinct runs with some of the
questions to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.arrays import BY_SPACE, U64, encode, hash_words, mix64, slices
from ledgerlark.llm.labelled import fold_of
from ledgerlark.session import stage

DEPTH = 5
FOLDS, HELD_OUT = 10, 0
BLOCK_BYTES = 40_000_000
SLICE_BYTES = 500_000
# Depth from which on a shard holds all of a node; above it sums go to the
# driver, a row for each pair of bytes and known bits.
TOP = 3
MOST_SHARDS = 4096
# Partial counts that one task merges.
FAN = 16
# Never a byte of UTF-8: stands before a text and after it.
EDGE = 0xFF
# Words have negative keys, byte runs positive ones.
WORD = U64(1 << 63)
END = np.array([1], U64) | WORD
LOG10 = np.log(10)


def byte_runs(part: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of every text, and its end: context and byte as one number, and the text.

    The number has the latest byte of the context on top and the byte itself
    at the bottom, so that a shift to the right shortens the context.
    """
    pad = bytes([EDGE]) * DEPTH
    data = np.frombuffer(b"".join(x for c in part for x in (pad, c)) + pad, np.uint8)
    sizes = np.fromiter((len(c) for c in part), np.int64, len(part)) + 1
    begins = np.concatenate([[0], np.cumsum(sizes - 1 + DEPTH)[:-1]]) + DEPTH
    text = np.repeat(np.arange(len(part), dtype=np.int32), sizes)
    place = np.arange(len(text)) + np.repeat(begins - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    run = data[place].astype(U64)
    for back in range(1, DEPTH + 1):
        run |= data[place - back].astype(U64) << U64(8 * (DEPTH + 1 - back))
    return run, text


class Counter:
    """Counts of 64-bit keys, most of them in a table by hash, the rest sorted."""

    BITS = 22

    def __init__(self):
        self.key = np.zeros(1 << self.BITS, U64)
        self.count = np.zeros(1 << self.BITS, np.int64)
        self.rest: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray, counted: np.ndarray) -> None:
        slot = (mix64(keys) >> U64(64 - self.BITS)).astype(np.int64)
        free = self.key[slot] == 0
        self.key[slot[free]] = keys[free] + U64(1)
        hit = self.key[slot] == keys + U64(1)
        np.add.at(self.count, slot[hit & counted], 1)
        if not hit.all():
            found, back = np.unique(keys[~hit], return_inverse=True)
            self.rest.append((found, np.bincount(back, weights=counted[~hit], minlength=len(found)).astype(np.int64)))

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        used = np.flatnonzero(self.key)
        keys, counts = [self.key[used] - U64(1)], [self.count[used]]
        if self.rest:
            found, back = np.unique(np.concatenate([k for k, _ in self.rest]), return_inverse=True)
            keys.append(found)
            counts.append(
                np.bincount(back, weights=np.concatenate([c for _, c in self.rest]), minlength=len(found)).astype(np.int64)
            )
        return np.concatenate(keys), np.concatenate(counts)


class Lookup:
    """Values by 64-bit key; every key that is asked for is known."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(8, int(len(keys) * 3).bit_length())
        slot = self.slot(keys)
        self.key = np.zeros(1 << self.bits, U64)
        self.value = np.zeros(1 << self.bits)
        self.key[slot] = keys + U64(1)
        kept = self.key[slot] == keys + U64(1)
        self.value[slot[kept]] = values[kept]
        order = np.argsort(keys[~kept])
        self.rest, self.rest_values = keys[~kept][order], values[~kept][order]

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix64(keys) >> U64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = self.slot(keys)
        found = self.value[slot]
        miss = np.flatnonzero(self.key[slot] != keys + U64(1))
        if len(miss):
            found[miss] = self.rest_values[np.searchsorted(self.rest, keys[miss])]
        return found


def pack(numbers: np.ndarray, ascending: bool = False) -> bytes:
    """Numbers as compressed byte planes; ascending ones as differences."""
    if ascending and len(numbers):
        numbers = np.concatenate([numbers[:1], numbers[1:] - numbers[:-1]])
    planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(len(numbers), -1).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(blob: bytes, kind, ascending: bool = False) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    numbers = np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()
    return np.cumsum(numbers, dtype=kind) if ascending else numbers


def _asked(block: int, texts: list[bytes], trained: np.ndarray, shards: int) -> pd.DataFrame:
    """The runs and words that a block holds, with their counts in its training texts, by shard."""
    runs, words = Counter(), Counter()
    for start, end in slices(texts, SLICE_BYTES):
        learn = trained[start:end]
        run, text = byte_runs(texts[start:end])
        runs.add(run, learn[text])
        hashes, counts = hash_words(texts[start:end], BY_SPACE)
        words.add(hashes | WORD, np.repeat(learn, counts))
    words.add(np.repeat(END, len(texts)), trained)
    keys, counts = runs.result()
    hashes, seen = words.result()
    rows = []
    for first, key, n, dealt in (
        (0, keys, counts, mix64(keys >> U64(8 * (DEPTH + 1 - TOP)))),
        (shards, hashes, seen, mix64(hashes)),
    ):
        shard = (dealt % U64(shards)).astype(np.int64)
        order = np.lexsort((key, shard))
        key, n, shard = key[order], n[order], shard[order]
        cuts = np.searchsorted(shard, np.arange(shards + 1))
        rows += [
            (first + i, pack(key[a:b], ascending=True), pack(n[a:b]))
            for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
            if b > a
        ]
    return pd.DataFrame(rows, columns=["shard", "keys", "numbers"]).assign(
        block=block, ids=None, held=None, sizes=None
    )


def cutter(shards: int):
    """Blocks of texts, packed, each followed by what it asks; a block is within one task."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        block = (context.partitionId() if context else 0) << 32
        texts: list[bytes] = []
        trained: list[bool] = []
        size = 0
        for batch in batches:
            coded = encode(batch["text"], lower=True)
            held = batch["held"].to_numpy(bool)
            for start, end in slices(coded):
                if size >= BLOCK_BYTES:
                    yield _asked(block, texts, np.array(trained), shards)
                    block, texts, trained, size = block + 1, [], [], 0
                part = coded[start:end]
                texts += part
                trained += (~held[start:end]).tolist()
                size += sum(map(len, part))
                yield pd.DataFrame(
                    {
                        "block": [block],
                        "shard": [-1],
                        "keys": [zstandard.ZstdCompressor(level=1).compress(b"".join(part))],
                        "numbers": [None],
                        "ids": [batch["id"].iloc[start:end].tolist()],
                        "held": [held[start:end].tolist()],
                        "sizes": [[len(c) for c in part]],
                    }
                )
        if texts:
            yield _asked(block, texts, np.array(trained), shards)

    return cut


def _merge(group: pd.DataFrame) -> pd.DataFrame:
    """Counts of a shard, added up."""
    keys = np.concatenate([unpack(b, U64, ascending=True) for b in group["keys"]])
    numbers = np.concatenate([unpack(b, np.int64) for b in group["numbers"]])
    found, back = np.unique(keys, return_inverse=True)
    counts = np.bincount(back, numbers, len(found)).astype(np.int64)
    return pd.DataFrame(
        {
            "shard": group["shard"].iloc[:1].to_numpy(),
            "part": group["part"].iloc[:1].to_numpy(),
            "keys": [pack(found, ascending=True)],
            "numbers": [pack(counts)],
        }
    )


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x of at least 0.5."""
    shift = np.zeros_like(x)
    for step in range(8):
        shift += np.log(x + step)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of a sequence with these counts."""
    a, b = zeros.astype(float), ones.astype(float)
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1) - np.log(np.pi)


class Nodes:
    """The nodes of one depth: ids (context, known bits), counts, weighted logarithm, own share."""

    def __init__(self, ids: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None):
        self.ids, self.zeros, self.ones = ids, zeros, ones
        own = log_estimate(zeros, ones)
        self.weighted = own if below is None else np.logaddexp(own, below) - np.log(2)
        self.share = np.exp(np.minimum(own - np.log(2) - self.weighted, 0)) if below is not None else np.ones(len(ids))
        self.seen = zeros + ones > 0

    def estimate(self, at: np.ndarray, bit: np.ndarray) -> np.ndarray:
        count = np.where(bit == 1, self.ones[at], self.zeros[at])
        return (count + 0.5) / (self.zeros[at] + self.ones[at] + 1)

    def mix(self, at: np.ndarray, bit: np.ndarray, deeper: np.ndarray) -> np.ndarray:
        """Probability of ``bit``; ``deeper`` is that of the child, or nan if it was never seen."""
        own, share = self.estimate(at, bit), self.share[at]
        mixed = np.where(np.isnan(deeper), own, share * own + (1 - share) * deeper)
        return np.where(self.seen[at], mixed, np.nan)


def decisions(symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte its eight decisions: known bits behind a leading one, and the bit."""
    step = np.arange(8)
    known = (1 << step) | (symbol[:, None] >> (8 - step))
    return known.ravel(), ((symbol[:, None] >> (7 - step)) & 1).ravel()


def grow(run: np.ndarray, n: np.ndarray, top: int) -> tuple[list[Nodes], list[np.ndarray], np.ndarray]:
    """Nodes of the depths ``top`` to ``DEPTH``, where each decision finds them, and the bits."""
    known, bit = decisions((run & 255).astype(np.int64))
    context = np.repeat((run >> 8).astype(np.int64), 8)
    weight = np.repeat(n, 8)
    levels, places, below = [], [], None
    for depth in range(DEPTH, top - 1, -1):
        ids, at = np.unique(((context >> (8 * (DEPTH - depth))) << 8) | known, return_inverse=True)
        ones = np.bincount(at, weights=weight * bit, minlength=len(ids))
        zeros = np.bincount(at, weights=weight, minlength=len(ids)) - ones
        if levels:
            child = levels[-1]
            parent = ((child.ids >> 16) << 8) | (child.ids & 255)
            below = np.bincount(np.searchsorted(ids, parent), weights=child.weighted, minlength=len(ids))
        levels.append(Nodes(ids, zeros, ones, below))
        places.append(at)
    return levels, places, bit


def _upper(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums by node of depth ``TOP - 1``."""
    for batch in batches:
        for keys, numbers in zip(batch["keys"], batch["numbers"], strict=True):
            runs, n = unpack(keys, U64, ascending=True).view(np.int64), unpack(numbers, np.int64)
            node = grow(runs, n, TOP)[0][-1]
            yield pd.DataFrame(
                {
                    "node": ((node.ids >> 16) << 8) | (node.ids & 255),
                    "zeros": node.zeros,
                    "ones": node.ones,
                    "below": node.weighted,
                }
            ).groupby("node", as_index=False).sum()


def upper_levels(rows: pd.DataFrame) -> list[Nodes]:
    """The nodes of the depths below ``TOP``, from sums by node of the deepest of them."""
    rows = rows.sort_values("node")
    levels = [Nodes(*(rows[c].to_numpy() for c in ("node", "zeros", "ones", "below")))]
    for _ in range(TOP - 1):
        child = levels[-1]
        ids, at = np.unique(((child.ids >> 16) << 8) | (child.ids & 255), return_inverse=True)
        sums = [np.bincount(at, weights=x, minlength=len(ids)) for x in (child.zeros, child.ones, child.weighted)]
        levels.append(Nodes(ids, *sums))
    return levels


def log_probabilities(run: np.ndarray, n: np.ndarray, upper: list[Nodes]) -> np.ndarray:
    """Base-10 logarithm of the probability of every run's byte after its context."""
    levels, places, bit = grow(run, n, TOP)
    p = np.full(len(bit), np.nan)
    for nodes, at in zip(levels, places, strict=True):
        p = nodes.mix(at, bit, p)
    known, _ = decisions((run & 255).astype(np.int64))
    context = np.repeat((run >> 8).astype(np.int64), 8)
    for depth, nodes in zip(range(TOP - 1, -1, -1), upper, strict=True):
        ids = ((context >> (8 * (DEPTH - depth))) << 8) | known
        p = nodes.mix(np.searchsorted(nodes.ids, ids), bit, p)
    return np.log(np.where(np.isnan(p), 0.5, p)).reshape(-1, 8).sum(axis=1) / LOG10


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of every row of ``docs``, learned from the rows that are not held out.

    ``doc_id``, ``held_out``; ``n_tokens`` (words and one end), ``n_known``
    (those that training has), ``train_tokens``, ``base_score`` (add-0.1 unigrams of
    words), ``score`` (base-10 logarithm of the probability of the text, A-Z
    lowered, with its end) and ``bits_per_byte``.

    A null text counts as empty: its end alone is scored. A row with a null id is
    trained on. Repeated rows count each. Words are compared by a 64-bit hash.
    An empty table gives no rows; without training rows every bit has
    probability one half. Other columns are not read.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(
        F.col(doc_id).alias("id"), (fold_of(F.col(doc_id), FOLDS) == HELD_OUT).alias("held"), F.col(text).alias("text")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // BLOCK_BYTES + 1
    shards = min(MOST_SHARDS, max(16, 1 << (2 * blocks - 1).bit_length()))
    # Questions to a shard meet in parts of a few million.
    parts = -(-blocks // (4 * shards))
    cut = stage(
        rows.mapInPandas(
            cutter(shards),
            "block bigint, shard int, keys binary, numbers binary, "
            f"ids array<{kind}>, held array<boolean>, sizes array<int>",
        ),
        "context-blocks",
    )
    asked = cut.filter("shard >= 0").select(
        "shard", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int").alias("part"), "block", "keys", "numbers"
    )
    packed = "shard int, part int, keys binary, numbers binary"
    counted = stage(asked.groupBy("shard", "part").applyInPandas(_merge, packed), "context-counts")
    left = parts
    while left > 1:
        left = -(-left // FAN)
        counted = stage(
            counted.withColumn("part", F.floor(F.col("part") / FAN).cast("int"))
            .groupBy("shard", "part")
            .applyInPandas(_merge, packed),
            "context-counts",
        )
    runs, words = counted.filter(F.col("shard") < shards), counted.filter(F.col("shard") >= shards)
    sums = runs.mapInPandas(_upper, "node bigint, zeros double, ones double, below double")
    upper = upper_levels(sums.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "below")]).toPandas())
    sent = docs.sparkSession.sparkContext.broadcast(upper)

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard, keys, numbers in zip(batch["shard"], batch["keys"], batch["numbers"], strict=True):
                run, n = unpack(keys, U64, ascending=True).view(np.int64), unpack(numbers, np.int64)
                found = log_probabilities(run, n, sent.value).astype(np.float32)
                yield pd.DataFrame({"shard": [shard], "keys": [keys], "numbers": [pack(found)]})

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen = [unpack(b, np.int64) for b in batch["numbers"]]
            yield pd.DataFrame({"total": [int(n.sum()) for n in seen], "known": [int((n > 0).sum()) for n in seen]})

    valued = runs.mapInPandas(weigh, "shard int, keys binary, numbers binary").union(
        words.select("shard", "keys", "numbers")
    )
    total, known = (
        words.select("numbers").mapInPandas(tally, "total bigint, known bigint").agg(F.sum("total"), F.sum("known")).first()
    )
    total, known = total or 0, known or 0
    scale = total + 0.1 * (known + 1)

    def answer(asked_of: pd.DataFrame, values: pd.DataFrame) -> pd.DataFrame:
        keys = unpack(values["keys"].iloc[0], U64, ascending=True)
        kind = np.float32 if values["of"].iloc[0] < shards else np.int64
        numbers = unpack(values["numbers"].iloc[0], kind)
        found = [
            pack(numbers[np.searchsorted(keys, unpack(b, U64, ascending=True))]) for b in asked_of["keys"]
        ]
        return asked_of[["block", "shard", "keys"]].assign(numbers=found)

    every = valued.select(
        F.col("shard").alias("of"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("of_part"), "keys", "numbers"
    )
    answers = (
        asked.groupBy("shard", "part")
        .cogroup(every.groupBy("of", "of_part"))
        .applyInPandas(answer, "block bigint, shard int, keys binary, numbers binary")
    )

    def judge(texts: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        tables = []
        for part, kind in ((answers["shard"] < shards, np.float32), (answers["shard"] >= shards, np.int64)):
            keys = [unpack(b, U64, ascending=True) for b in answers["keys"][part]]
            numbers = [unpack(b, kind) for b in answers["numbers"][part]]
            tables.append(Lookup(np.concatenate(keys), np.concatenate(numbers).astype(float)))
        run_values, word_counts = tables
        last = word_counts(END)[0]
        out = []
        for ids, held, sizes, blob in zip(texts["ids"], texts["held"], texts["sizes"], texts["text"], strict=True):
            whole = zstandard.ZstdDecompressor().decompress(blob)
            ends = np.cumsum(sizes)
            coded = [whole[b - n : b] for b, n in zip(ends, sizes, strict=True)]
            for start, end in slices(coded, SLICE_BYTES):
                n = end - start
                run, owner = byte_runs(coded[start:end])
                model = np.bincount(owner, weights=run_values(run), minlength=n)
                hashes, counts = hash_words(coded[start:end], BY_SPACE)
                seen = word_counts(hashes | WORD)
                of = np.repeat(np.arange(n), counts)
                out.append(
                    pd.DataFrame(
                        {
                            "id": ids[start:end],
                            "held": held[start:end],
                            "n_tokens": counts + 1,
                            "n_known": np.bincount(of, seen > 0, n).astype(np.int64) + int(last > 0),
                            "base_score": np.bincount(of, np.log10((seen + 0.1) / scale), n) + np.log10((last + 0.1) / scale),
                            "score": model,
                            "bits_per_byte": -model * np.log2(10) / np.bincount(owner, minlength=n),
                        }
                    )
                )
        return pd.concat(out, ignore_index=True)

    scored = (
        cut.filter("shard < 0")
        .select(F.col("block").alias("of"), "ids", "held", "sizes", F.col("keys").alias("text"))
        .groupBy("of")
        .cogroup(answers.groupBy("block"))
        .applyInPandas(
            judge,
            f"id {kind}, held boolean, n_tokens bigint, n_known bigint, base_score double, score double, bits_per_byte double",
        )
    )
    return scored.select(
        F.col("id").alias("doc_id"),
        F.col("held").alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(int(total)).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        "bits_per_byte",
    )
