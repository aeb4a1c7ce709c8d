"""From band values to classes: cheap exact comparisons first, then all that can still be similar."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.arrays import U64, mix64
from ledgerlark.llm.bitmarks import counts_of, marked, often, short_key
from ledgerlark.llm.components import components
from ledgerlark.session import stage, unstage

# Nodes that are broadcast at most, 16 bytes each; beyond it Spark joins by shuffle.
MOST_BROADCAST = 2_000_000
# Hash slots that elements are counted by, four bytes each in every task; the counts only order the elements.
COUNTERS = 1 << 21
# Rows of an element's group that meet in one key of the join.
BLOCK = 500
# Buckets of so many rows are compared pair by pair: at most 15 pairs a row.
SMALL = 16
# For each of 256 slots a bit: whether an odd number of a set's elements falls on it.
ODD = ("odd0", "odd1", "odd2", "odd3")
# What is known of a set without its elements: their number, their weight and which slots are odd.
FACTS = ("n", "heavy", *ODD)
FACT_TYPES = "n long, heavy double, " + ", ".join(f"{c} long" for c in ODD)

# Of a batch of sets: its rows, and row number (ascending), element and weight of every element.
Elements = Callable[[pd.DataFrame], Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]]]


def _bands(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All band values of a column of lists, or of bytes with eight for each, and their number by row."""
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        lengths = pc.binary_length(column).fill_null(0).to_numpy() // 8
        return np.frombuffer(b"".join(column.drop_null().to_pylist()), U64), lengths
    lengths = column.value_lengths().fill_null(0).to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False).view(U64), lengths


def _single(batch: pa.RecordBatch, again) -> pa.RecordBatch:
    """The rows that stand alone for their node: marked so, or of a node that has one row."""
    if again is None:
        return batch
    met = marked(again.value, short_key(batch.column(0).to_numpy().view(U64)))
    return batch.filter(pc.or_(batch.column(2), pa.array(~met)))


def _values(again):
    def values(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield _bands(_single(batch, again).column("bands"))[0]

    return values


def _several(again):
    """The rows of the nodes that may have several."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(marked(again.value, short_key(batch.column(0).to_numpy().view(U64)))))

    return keep


def _shared(marks, again):
    """Nodes with those of their band values whose bits are set."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _single(batch, again)
            found, lengths = _bands(rows.column(1))
            good = marked(marks.value, short_key(found))
            owner = np.repeat(np.arange(len(rows)), lengths)[good]
            yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(owner)), pa.array(found[good].view(np.int64))], ["t", "bucket"])

    return keep


def crowded(signed: DataFrame, again=None) -> DataFrame:
    """The buckets (``t``, ``bucket``) of ``signed`` (``t``, ``bands``) that have several nodes.

    Adds ``center``, the smallest node of the bucket, and ``rows``, how many
    rows it has. Most buckets have one row: sorted runs of short keys find those that may have more, so
    that only they are shuffled. Buckets are then found by an aggregate with partial results and
    their rows by a join that Spark can split, so a bucket may have most rows.

    With ``again``, the bits of all nodes (hashes) that may have several rows, these are
    brought to one row each first, so that copies fill no bucket.
    """
    several = None
    if again is not None:
        several = stage(signed.select("t", "bands").mapInArrow(_several(again), signed.select("t", "bands").schema).dropDuplicates(["t"]), "repeated")
        signed = signed.withColumn("single", F.lit(False)).unionByName(several.withColumn("single", F.lit(True)))
    rows = signed.select("t", "bands", *(["single"] if again is not None else []))
    marks = often(rows.select("bands") if again is None else rows, _values(again), 2)
    kind = signed.schema["t"].dataType.simpleString()
    spread = stage(rows.mapInArrow(_shared(marks, again), f"t {kind}, bucket bigint"), "spread")
    if several is not None:
        unstage(several)
    shared = (
        spread.groupBy("bucket")
        .agg(F.min("t").alias("center"), F.max("t").alias("other"), F.count("*").alias("rows"))
        .filter("center <> other")
        .drop("other")
    )
    found = stage(spread.join(shared, "bucket").distinct(), "buckets")
    unstage(spread)
    return found


def nodes_of(rows: DataFrame) -> DataFrame:
    """The nodes (``t``) of crowded rows, to be broadcast if a count allows it."""
    found = stage(rows.select("t").distinct(), "candidates")
    return F.broadcast(found) if found.count() <= MOST_BROADCAST else found


def settle(
    rows: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    sets: DataFrame,
    known: DataFrame,
    elements: Elements,
    similarity: float,
    rounds: int = 5,
    weighted: bool = False,
) -> DataFrame:
    """``node`` and ``label`` of all nodes that are linked.

    ``verify`` keeps the pairs (``a``, ``b``) that are similar; it sees only pairs whose facts
    (``known``) allow that. In buckets of up to 16 rows every pair is compared; these buckets are
    done. In larger ones every node is compared with the center first. Nodes of a bucket that are
    then in different components are compared with their neighbours in an order drawn anew in every
    round, in parts of about 500 rows, until a round finds no link or ``rounds`` are done. What is apart
    after that goes through ``untested``, so any two similar nodes of a bucket end in one component.

    ``sets`` has the nodes (``t``) with what ``elements`` reads. Pairs that
    ``verify`` keeps need a plain Jaccard of ``similarity`` or, if ``weighted``, a
    plain or a probability Jaccard of it.
    """

    def linked(pairs: DataFrame) -> DataFrame:
        return stage(verify(hopeful(pairs, known, similarity, weighted)).distinct(), "links")

    few, many = rows.filter(F.col("rows") <= SMALL), rows.filter(F.col("rows") > SMALL)
    inside = few.select("bucket", F.col("t").alias("a")).join(few.select("bucket", F.col("t").alias("b")), "bucket")
    pairs = inside.filter("a < b").select("a", "b").unionByName(
        many.filter("t <> center").select(F.col("center").alias("a"), F.col("t").alias("b"))
    )
    found = linked(pairs.distinct())
    labels = components(found)
    unstage(found)
    for turn in range(1, rounds):
        # One key of bucket and part: by two columns Spark would leave the rows dealt by the bucket alone.
        part = F.pmod(F.xxhash64("t", F.lit(-turn)), F.ceil(F.col("rows") / 500).cast("long"))
        order = Window.partitionBy("spot").orderBy("draw", "t")
        beside = (
            _apart(many, labels)
            .withColumn("draw", F.xxhash64("t", "bucket", F.lit(turn)))
            .withColumn("spot", F.xxhash64("bucket", part))
            .select("t", "label", F.lag("t").over(order).alias("s"), F.lag("label").over(order).alias("beside"))
            .filter("label <> beside")
            .select(F.least("t", "s").alias("a"), F.greatest("t", "s").alias("b"))
            .distinct()
        )
        found = linked(beside)
        if found.isEmpty():
            unstage(found)
            break
        labels = merged(labels, found)
    nodes = stage(_apart(many, labels).select("t", "label").distinct(), "apart")
    if not nodes.isEmpty():
        left = untested(nodes, sets, elements, similarity, weighted)
        found = stage(verify(left).distinct(), "links")
        unstage(left)
        if not found.isEmpty():
            labels = merged(labels, found)
    unstage(nodes)
    return labels


def _apart(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of the buckets that hold several labels, with the label of their node."""
    named = rows.join(labels.withColumnRenamed("node", "t"), "t", "left").withColumn("label", F.coalesce("label", "t"))
    split = named.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    return named.join(split.filter("low <> high").select("bucket"), "bucket", "left_semi")


def facts(owner: np.ndarray, found: np.ndarray, weight: np.ndarray, sets: int) -> dict[str, np.ndarray]:
    """The facts of sets from the owners (ascending), elements (each once) and weights of all elements."""
    odd = np.zeros((sets, len(ODD)), U64)
    for start in range(0, sets, 4096):
        end = min(start + 4096, sets)
        a, b = np.searchsorted(owner, [start, end])
        slot = (mix64(found[a:b]) >> U64(56)).astype(np.int64)
        times = np.bincount((owner[a:b] - start) * 256 + slot, minlength=(end - start) * 256)
        odd[start:end] = np.packbits((times & 1).astype(np.uint8), bitorder="little").view(U64).reshape(-1, len(ODD))
    return {
        "n": np.bincount(owner, minlength=sets),
        "heavy": np.bincount(owner, weights=weight, minlength=sets).astype(float),
        **{c: odd[:, i].view(np.int64) for i, c in enumerate(ODD)},
    }


def _can_be_similar(similarity: float, weighted: bool, before: bool) -> Column:
    """Whether the sets with facts ``..._a`` and ``..._b`` can be similar.

    A slot on which the numbers of elements of two sets are odd and even holds an
    element that only one of them has. Their number bounds the plain similarity,
    and, as every element weighs 1 or more, the probability Jaccard too: with u
    and v the weight shares of what only one has, that is at most the mean of
    (1-u)/(1+u) and (1-v)/(1+v), which is greatest if all of it is in the heavier
    set. With ``before``, so many elements (``rank``) and weight shares (``share``) stand before
    the first common element as well; only one set has each of them, and the slots are those of the other elements.
    """
    apart = sum(
        (F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in ODD[1:]),
        F.bit_count(F.col(f"{ODD[0]}_a").bitwiseXOR(F.col(f"{ODD[0]}_b"))),
    )
    if before:
        apart += F.col("rank_a") + F.col("rank_b")
    both = F.col("n_a") + F.col("n_b")
    left = [F.col(f"n_{s}") - (F.col(f"rank_{s}") if before else F.lit(0)) for s in "ab"]
    possible = F.least(*left) * (1 + similarity) >= both * similarity - 1e-6
    possible &= apart * (1 + similarity) <= both * (1 - similarity) + 1e-6
    if weighted:
        also = apart * similarity <= F.greatest("heavy_a", "heavy_b") * (1 - similarity) + 1e-6
        if before:
            bounds = [(1 - F.col(f"share_{side}")) / (1 + F.col(f"share_{side}")) for side in "ab"]
            also &= (bounds[0] + bounds[1]) / 2 >= similarity - 1e-9
        possible |= also
    return possible


def _needed(weighted: bool) -> list[str]:
    """The facts that ``_can_be_similar`` reads."""
    return [c for c in FACTS if weighted or c != "heavy"]


def hopeful(pairs: DataFrame, known: DataFrame, similarity: float, weighted: bool) -> DataFrame:
    """The pairs whose facts (``known``: ``t`` and the facts) allow that they are similar; texts are not read."""
    one = known.select(*[F.col(c).alias(f"{c}_a") for c in ("t", *_needed(weighted))])
    two = known.select(*[F.col(c).alias(f"{c}_b") for c in ("t", *_needed(weighted))])
    joined = pairs.join(one, F.col("a") == F.col("t_a")).join(two, F.col("b") == F.col("t_b"))
    return joined.filter(_can_be_similar(similarity, weighted, before=False)).select("a", "b")


def _slot(found: np.ndarray) -> np.ndarray:
    return (mix64(found) % U64(COUNTERS)).astype(np.int64)


def _count(elements: Elements):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for _, _, found, _ in elements(batch):
                total += np.bincount(_slot(found), minlength=COUNTERS)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"slot": at, "n": total[at]})

    return count


def _odd_before(found: np.ndarray, begin: np.ndarray, kept: np.ndarray) -> dict[str, np.ndarray]:
    """Which slots are odd among the elements that stand before each of the ``kept`` ones in its set, which begins at ``begin``."""
    slot = mix64(found) >> U64(56)
    bit = U64(1) << (slot & U64(63))
    odd = {}
    for i, name in enumerate(ODD):
        own = np.where(slot >> U64(6) == i, bit, U64(0))
        before = np.bitwise_xor.accumulate(own) ^ own
        odd[name] = (before[kept] ^ before[begin[kept]]).view(np.int64)
    return odd


def _rarest(elements: Elements, often, similarity: float, weighted: bool):
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, owner, found, weight in elements(batch):
                order = np.lexsort((found, often.value[_slot(found)], owner))
                owner, found, weight = owner[order], found[order], weight[order].astype(np.int64)
                n = np.bincount(owner, minlength=len(part))
                begin = np.cumsum(n) - n
                rank = np.arange(len(owner)) - begin[owner]
                before = np.cumsum(weight) - weight
                before -= before[begin[owner]]
                total = np.bincount(owner, weights=weight, minlength=len(part))
                rest = 1 - similarity + 1e-9
                kept = rank <= rest * n[owner]
                if weighted:
                    kept |= before <= rest * total[owner]
                of = owner[kept]
                rows = part[["t", "label"]].iloc[of].reset_index(drop=True)
                known = {name: values[of] for name, values in facts(owner, found, weight, len(part)).items()}
                for name, gone in _odd_before(found, begin[owner], kept).items():
                    known[name] = known[name] ^ gone
                yield rows.assign(e=found[kept].view(np.int64), rank=rank[kept], share=before[kept] / total[of], **known)

    return find


def untested(nodes: DataFrame, sets: DataFrame, elements: Elements, similarity: float, weighted: bool) -> DataFrame:
    """All pairs (``a``, ``b``) of ``nodes`` with different labels that can be similar.

    A prefix filter. All sets are put in one order of the elements, those of
    rare hash slots first. The elements that a similar set lacks are at most
    1 - ``similarity`` of a set, by number for the plain Jaccard and by weight
    for the other. So the first common element of two similar sets has at most
    that much before it in both: only such elements are joined, and what is
    before them bounds the similarity once more. With u and v the weight shares
    before it, a probability Jaccard is at most the mean of (1-u)/(1+u) and
    (1-v)/(1+v). The facts of both sets bound it once more.

    The label with most rows of an element is never joined with itself, and
    groups are joined in blocks, so neither a large component nor a common
    element is one task. Nothing is capped.
    """
    near = stage(sets.join(nodes, "t"), "apart-sets")
    often = counts_of(near.mapInPandas(_count(elements), "slot long, n long"), COUNTERS)
    kind = nodes.schema["t"].dataType.simpleString()
    marks = stage(
        near.mapInPandas(
            _rarest(elements, often, similarity, weighted),
            f"t {kind}, label {kind}, e long, rank long, share double, {FACT_TYPES}",
        ),
        "rarest",
    )
    groups = (
        marks.groupBy("e", "label")
        .agg(F.count("*").alias("rows"))
        .groupBy("e")
        .agg(F.max(F.struct("rows", "label")).alias("main"), F.sum("rows").alias("rows"))
        .filter("rows > main.rows")
        .select(
            "e",
            F.col("main.label").alias("main"),
            F.ceil((F.col("rows") - F.col("main.rows")) / BLOCK).alias("lefts"),
            F.ceil(F.col("rows") / BLOCK).alias("rights"),
        )
    )
    columns = ["t", "label", "rank", *(["share"] if weighted else []), *_needed(weighted)]
    cut = stage(marks.select("e", *columns).join(groups, "e"), "rarest-shared")
    one = (
        cut.filter("label <> main")
        .withColumn("p", F.pmod(F.xxhash64("t"), F.col("lefts")))
        .withColumn("q", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rights") - 1)))
        .select("e", "p", "q", *[F.col(c).alias(f"{c}_a") for c in columns])
    )
    two = (
        cut.withColumn("q", F.pmod(F.xxhash64("t"), F.col("rights")))
        .withColumn("p", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lefts") - 1)))
        .select("e", "p", "q", "main", *[F.col(c).alias(f"{c}_b") for c in columns])
    )
    possible = _can_be_similar(similarity, weighted, before=True)
    pairs = stage(
        one.join(two, ["e", "p", "q"])
        .filter((F.col("label_a") != F.col("label_b")) & ((F.col("label_b") == F.col("main")) | (F.col("t_a") < F.col("t_b"))))
        .filter(possible)
        .select(F.least("t_a", "t_b").alias("a"), F.greatest("t_a", "t_b").alias("b"))
        .distinct(),
        "pairs",
    )
    unstage(near, marks, cut)
    return pairs


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links: only the labels at their ends are joined anew. What is given is dropped."""
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    nodes = labels.unionByName(ends.join(labels, "node", "left_anti").select("node", F.col("node").alias("label")))
    known = nodes.select("node", "label")
    between = (
        links.join(known.withColumnRenamed("node", "a").withColumnRenamed("label", "la"), "a")
        .join(known.withColumnRenamed("node", "b").withColumnRenamed("label", "lb"), "b")
        .select(F.col("la").alias("a"), F.col("lb").alias("b"))
    )
    up = components(between).select(F.col("node").alias("label"), F.col("label").alias("above"))
    found = stage(
        nodes.join(up, "label", "left").select("node", F.coalesce("above", "label").alias("label")), "labels"
    )
    unstage(labels, links)
    return found
