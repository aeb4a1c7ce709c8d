"""Benchmark decontamination by word windows.

The windows of all benchmark items form a hash set that is broadcast as long as
its row count is below a bound; beyond it Spark joins by shuffle. Documents are
scanned window by window inside one JVM stage; a match of hashes is verified by
the words themselves.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: bytes that separate words, after A-Z have been lowered.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same words before A-Z are lowered.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

WINDOW = 10

# Windows that are broadcast at most; a window is about 200 bytes.
MOST_BROADCAST = 500_000


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lowered and all other characters as they are."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def words_of(text: Column) -> Column:
    """The words of a text in order; none for a null."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BREAK), "")


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct windows of the items: ``hash``, ``words``, ``length`` and ``items``.

    An item with fewer words than a window, but not none, is one window. Items
    with a null id count under the empty string.
    """
    words = items.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words_of(F.col(text)).alias("all")
    ).filter(F.size("all") > 0)
    length = F.least(F.size("all"), F.lit(window))
    cut = words.select(
        "item", "all", length.alias("length"), F.explode(F.sequence(F.lit(1), F.size("all") - length + 1)).alias("at")
    ).select("item", "length", F.slice("all", F.col("at"), F.col("length")).alias("words"))
    return cut.groupBy("words", "length").agg(F.collect_set("item").alias("items")).withColumn(
        "hash", F.xxhash64("words")
    )


def scan(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    most_broadcast: int = MOST_BROADCAST,
) -> DataFrame:
    """Where benchmark windows occur in every distinct document.

    One row per distinct (id, words): ``doc_id``, ``words_hash``, ``n_words``,
    ``copies`` (how many rows are equal), ``hits`` (sorted numbers of the words,
    from 0, that lie in an occurrence) and ``items`` (sorted ids as strings of
    the items with an occurring window). A null or empty text has no words.
    """
    windows = item_windows(items, item_id, item_text, window)
    sizes = {row["length"]: row["count"] for row in windows.groupBy("length").count().collect()}
    lengths = sorted(sizes) or [window]
    few = sum(sizes.values()) <= most_broadcast
    rows = docs.select(F.col(doc_id).alias("doc_id"), words_of(F.col(text)).alias("text_words"))
    rows = rows.select("doc_id", F.size("text_words").alias("n_words"), F.xxhash64("text_words").alias("words_hash"), "text_words")
    spots = rows.select("*", F.posexplode_outer("text_words").alias("at", "word"))
    if len(lengths) == 1:
        spots = spots.withColumn("span", F.lit(lengths[0]))
    else:
        spots = spots.withColumn("span", F.explode(F.array(*map(F.lit, lengths))))
    first = F.coalesce(F.col("at"), F.lit(0)).eqNullSafe(F.lit(0)) & (F.col("span") == lengths[0])
    fits = F.col("at") + F.col("span") <= F.col("n_words")
    part = F.slice("text_words", F.col("at") + 1, F.col("span"))
    spots = spots.filter(fits | first).withColumn("window_hash", F.when(fits, F.xxhash64(part)))
    if not few:
        return _covered(_by_shuffle(rows, spots.filter(fits).withColumn("hash", F.xxhash64(part)), windows))
    windows = F.broadcast(windows)
    same = (F.col("window_hash") == F.col("hash")) & (part == F.col("words"))
    found = (
        spots.join(windows, same, "left")
        .filter(F.col("hash").isNotNull() | first)
        .select(
            "doc_id",
            "words_hash",
            "n_words",
            first.cast("int").alias("first"),
            F.when(F.col("hash").isNotNull(), F.struct("at", "span")).alias("spot"),
            "items",
        )
    )
    grouped = found.groupBy("doc_id", "words_hash", "n_words").agg(
        F.sum("first").alias("copies"), F.collect_set("spot").alias("spots"), F.collect_set("items").alias("found")
    )
    return _covered(grouped)


def _by_shuffle(rows: DataFrame, spots: DataFrame, windows: DataFrame) -> DataFrame:
    """Windows that are too many to be sent to the texts.

    Hashes of spots meet hashes of windows first; no text crosses a shuffle for each of its words. Then
    the texts that have such spots meet them once, and the few words of each are compared.
    """
    near = (
        spots.select("doc_id", "words_hash", "at", "span", "hash")
        .join(windows.select("hash").distinct().hint("merge"), "hash", "left_semi")
        .groupBy(F.col("doc_id").alias("near_id"), F.col("words_hash").alias("near_hash"))
        .agg(F.collect_set(F.struct("at", "span")).alias("near"))
    )
    mine = (F.col("words_hash") == F.col("near_hash")) & F.col("doc_id").eqNullSafe(F.col("near_id"))
    maybe = (
        rows.join(near, mine)
        .select("doc_id", "words_hash", "text_words", F.explode("near").alias("s"))
        .select("doc_id", "words_hash", "s", F.slice("text_words", F.col("s.at") + 1, F.col("s.span")).alias("part"))
    )
    hits = (
        maybe.withColumn("part_hash", F.xxhash64("part"))
        .join(windows, (F.col("part_hash") == F.col("hash")) & (F.col("part") == F.col("words")))
        .groupBy(F.col("doc_id").alias("near_id"), F.col("words_hash").alias("near_hash"))
        .agg(F.collect_set("s").alias("spots"), F.collect_set("items").alias("found"))
    )
    every = rows.groupBy("doc_id", "words_hash", "n_words").agg(F.count("*").cast("long").alias("copies"))
    joined = every.join(hits, mine, "left")
    empty = {name: F.array().cast(hits.schema[name].dataType) for name in ("spots", "found")}
    return joined.withColumns({name: F.coalesce(name, none) for name, none in empty.items()})


def _covered(grouped: DataFrame) -> DataFrame:
    covered = F.transform("spots", lambda s: F.sequence(s["at"], s["at"] + s["span"] - 1))
    return grouped.select(
        "doc_id",
        "words_hash",
        F.col("n_words").cast("long").alias("n_words"),
        "copies",
        F.array_sort(F.array_distinct(F.flatten(covered))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten("found"))).alias("items"),
    )


def report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Per document the words hit and the items found; one row for every input row."""
    found = scan(docs, items, **options)
    return (
        found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select(
            "doc_id",
            "n_words",
            F.size("hits").cast("long").alias("n_hit"),
            F.size("items").cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
            (F.size("hits") > 0).alias("contaminated"),
        )
    )


def drop_documents(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the documents in which a window of an item occurs."""
    found = scan(docs, items, doc_id, text, **options)
    hit = found.filter(F.size("hits") > 0).select(F.col("doc_id").alias("hit_id"), "words_hash")
    packed = docs.select(
        F.struct("*").alias("doc"), F.col(doc_id).alias("id"), F.xxhash64(words_of(F.col(text))).alias("hash")
    )
    clean = packed.join(hit, (F.col("hash") == F.col("words_hash")) & F.col("id").eqNullSafe(F.col("hit_id")), "left_anti")
    return clean.select("doc.*")


def remove_spans(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``doc_id`` and ``text`` of every row, with the words that are hit cut out.

    With a word goes what stands between it and the next one; all else stays as
    it was. A null text stays null.
    """
    found = scan(docs, items, doc_id, text, **options).filter(F.size("hits") > 0)
    hit = found.select(F.col("doc_id").alias("hit_id"), "words_hash", "hits")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn(
        "hash", F.xxhash64(words_of(F.col("text")))
    )
    words, gaps = F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.split("text", WORD, -1)
    pieces = F.zip_with(words, F.slice(gaps, F.lit(2), F.size(words)), lambda word, gap: F.concat(word, gap))
    left = F.filter(pieces, lambda piece, at: ~F.array_contains(F.col("hits"), at))
    cut = F.concat(F.get(gaps, F.lit(0)), F.array_join(left, ""))
    return rows.join(
        hit, (F.col("hash") == F.col("words_hash")) & F.col("doc_id").eqNullSafe(F.col("hit_id")), "left"
    ).select("doc_id", F.when(F.col("hits").isNull(), F.col("text")).otherwise(cut).alias("text"))
