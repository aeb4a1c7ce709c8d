"""Mixing sources to target weights with a low-discrepancy schedule.

Every source is one line of tokens: its documents in a shuffled order that
depends on their content alone. The line is cut into blocks of equal length. A
golden-ratio lattice deals the slots of the mix to the sources in proportion to
their targets; the k-th slot of a source reads the k-th block of its line, and
a line that ends is read again from its start.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.session import stage

# Fixed value: a word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

GOLDEN = (math.sqrt(5) - 1) / 2


def word_count(text: Column) -> Column:
    """Number of words; 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(doc_id: Column, text: Column, seed: str = "mix") -> Column:
    """A hash that orders the documents of a source, from id and text alone."""
    digest = F.md5(F.coalesce(text, F.lit("")))
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), digest))


def largest_quotient(a: int, b: int) -> int:
    """The largest partial quotient of ``a / b``; small for evenly spread multiples."""
    largest = 0
    while b:
        largest, a, b = max(largest, a // b), b, a % b
    return largest


def golden_step(n: int, tried: int = 200) -> int:
    """A step near ``n`` over the golden ratio that shares no factor with ``n``.

    Of the nearest integers, the one whose ratio to ``n`` is most like the
    golden ratio: its largest partial quotient is the smallest.
    """
    start = round(n * GOLDEN)
    near = [s for off in range(tried) for s in (start + off, start - off) if 0 < s < n and math.gcd(s, n) == 1]
    return min(near, key=lambda s: (largest_quotient(n, s), abs(s - start)), default=1)


def targets(sizes: DataFrame, weights=(5, 2, 1), share: Fraction = Fraction(3, 2), repeats: int = 2) -> DataFrame:
    """Tokens that each source gives to the mix.

    ``sizes`` has ``source`` and ``source_size``. Sources in code point order
    (null last) weigh ``weights`` in turn and share ``share`` of all tokens. No
    target is above ``repeats`` times the size of its source; what is cut off
    goes to the others by weight. With the sources in order of size over weight
    the full ones come first, and the common level of the others is the highest
    level that any prefix of full sources gives.

    Adds ``source_no``, ``weight`` and ``target``. One row per source meets in
    one task.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    choice = F.array(*[F.lit(float(w)) for w in weights])
    numbered = sizes.withColumn("source_no", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(choice, F.col("source_no") % len(weights) + 1)
    )
    filled = numbered.withColumn("cap", F.lit(float(repeats)) * F.col("source_size").cast("double")).withColumn(
        "total", F.sum("source_size").over(everything).cast("double")
    )
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source_no").asc())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.lit(float(share)) * F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum(
        "weight"
    ).over(onward)
    return (
        filled.withColumn("level", level)
        .withColumn("target", F.least("cap", F.max("level").over(everything) * F.col("weight")))
        .select("source", "source_no", "source_size", "weight", "target")
    )


def lines(rows: DataFrame, rows_per_bucket: int = 1000) -> DataFrame:
    """Add ``start``: the tokens before a row in the line of its source.

    ``rows`` has ``source_no``, ``shuffled`` (a hex hash) and ``size``. Rows are
    cut into hash ranges of about ``rows_per_bucket``; only the sums of the
    ranges are added up per source, so a source with most of the rows is still
    many small windows.
    """
    buckets = max(1, -(-rows.count() // rows_per_bucket))
    leading = F.conv(F.substring("shuffled", 1, 8), 16, 10).cast("long")
    cut = rows.withColumn("bucket", F.shiftright(leading * F.lit(buckets), 32))
    sums = cut.groupBy("source_no", "bucket").agg(F.sum("size").alias("tokens"))
    earlier = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source_no", "bucket", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("offset"))
    inside = (
        Window.partitionBy("source_no", "bucket").orderBy("shuffled").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        cut.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(offsets, ["source_no", "bucket"])
        .withColumn("start", F.col("offset") + F.col("within"))
        .drop("bucket", "within", "offset")
    )


def schedule(plan: DataFrame, block_tokens: int, slots_per_range: int = 1024) -> DataFrame:
    """Deal the slots of the mix to the sources.

    ``plan`` has ``source_no`` and ``quota`` (blocks of the source). Slot i of N
    is the lattice point ``i * g mod N``, with g nearest to N over the golden
    ratio; the points from the quotas before a source to its own end are its
    own. Each source so gets exactly its quota, spread evenly. Points are
    generated source by source and turned back into slots. The rank of a slot
    in its source comes from counts per slot range, never from one window per
    source.

    Returns ``slot``, ``source_no`` and ``block`` (the rank). Spark takes rows out
    of a sequence for as few as the rows the sequences are in, and would
    broadcast them; joins with slots are hinted.
    """
    before = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    placed = plan.select(
        "source_no", "quota", F.coalesce(F.sum("quota").over(before), F.lit(0)).cast("long").alias("first")
    )
    n = plan.agg(F.sum("quota")).first()[0] or 0
    wide = "decimal(38,0)"
    back = pow(golden_step(n), -1, n) if n > 1 else 0
    chunks = (
        placed.filter(F.col("quota") > 0)
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("quota") - 1) / slots_per_range))))
        .repartition("source_no", "chunk")
    )
    last = F.least(F.col("quota"), (F.col("chunk") + 1) * F.lit(slots_per_range)) - 1
    points = chunks.select(
        "source_no",
        F.explode(
            F.sequence(F.col("first") + F.col("chunk") * F.lit(slots_per_range), F.col("first") + last)
        ).alias("point"),
    )
    product = F.col("point").cast("decimal(19,0)") * F.lit(back).cast("decimal(18,0)")
    slots = points.select(
        "source_no", (product.cast(wide) % F.lit(max(n, 1)).cast("decimal(19,0)")).cast("long").alias("slot")
    ).withColumn("part", F.floor(F.col("slot") / slots_per_range))
    counts = slots.groupBy("source_no", "part").agg(F.count("*").alias("slots"))
    earlier = Window.partitionBy("source_no").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.select("source_no", "part", F.coalesce(F.sum("slots").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source_no", "part").orderBy("slot")
    return (
        slots.withColumn("within", F.row_number().over(inside) - 1)
        .join(ranks.hint("merge"), ["source_no", "part"])
        .select("slot", "source_no", (F.col("offset") + F.col("within")).cast("long").alias("block"))
    )


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights=(5, 2, 1),
    share: Fraction = Fraction(3, 2),
    repeats: int = 2,
    block_tokens: int = 1024,
    seed: str = "mix",
) -> DataFrame:
    """Words that the mix takes of every document.

    One row per input row: ``doc_id``, ``shuffled`` (its place in the line of
    its source), ``size``, ``source``, ``source_size``, ``target`` and ``taken``
    (repeats counted, at most ``repeats`` times ``size``). A source gives its
    target rounded down, whatever the block length: its last block is cut.

    A null text has size 0 and gives nothing; rows with a null source form a
    source of their own; a null id is a value like any other; repeated rows
    count one by one. An empty table gives no rows. Other columns are not read.
    """
    known, pieces = _dealt(docs, doc_id, text, source, weights, share, repeats, block_tokens, seed)
    row = ["source_no", "start", "shuffled", "doc_id", "source", "size", "source_size", "target"]
    taken = pieces.groupBy(*row).agg(
        F.sum(F.when(F.col("slot").isNotNull(), F.col("words")).otherwise(0)).cast("long").alias("taken")
    )
    columns = ["doc_id", "shuffled", "size", "source", "source_size", "target", "taken"]
    unread = known.filter(F.col("size") == 0).withColumn("taken", F.lit(0).cast("long"))
    return taken.select(columns).unionByName(unread.select(columns))


def mixed(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights=(5, 2, 1),
    share: Fraction = Fraction(3, 2),
    repeats: int = 2,
    block_tokens: int = 1024,
    seed: str = "mix",
) -> DataFrame:
    """The mix itself, to be read in the order of ``slot`` and ``at``.

    One row per stretch of a document in a block: ``slot`` (from 0, without gaps), ``source``, ``block``
    (of the source), ``at`` (where in the block the stretch starts), ``doc_id``, ``shuffled``, ``first`` (number of
    its first word in the document), ``words`` (how many) and ``text`` (those words, joined by a space). A
    block has ``block_tokens`` words, the last one of a source what is left of its target.

    The words of a row's stretches add up to what ``mix`` says it takes; nulls, copies and empty tables are as there.
    """
    _, pieces = _dealt(docs, doc_id, text, source, weights, share, repeats, block_tokens, seed)
    begin = F.greatest(F.col("begin"), F.col("block") * block_tokens)
    spans = pieces.filter((F.col("words") > 0) & F.col("slot").isNotNull()).select(
        "slot",
        "source",
        "block",
        (begin - F.col("block") * block_tokens).cast("int").alias("at"),
        "doc_id",
        "shuffled",
        (begin - F.col("begin")).cast("long").alias("first"),
        F.col("words").cast("long").alias("words"),
    )
    # Rows equal in id, source and text have one key and one text.
    texts = docs.select(
        shuffle_key(F.col(doc_id), F.col(text), seed).alias("key"),
        F.col(source).alias("of"),
        F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0)).alias("every"),
    ).dropDuplicates(["key", "of"])
    named = spans.join(texts, (F.col("shuffled") == F.col("key")) & F.col("source").eqNullSafe(F.col("of")))
    cut = F.slice("every", (F.col("first") + 1).cast("int"), F.col("words").cast("int"))
    return named.select(*spans.columns, F.array_join(cut, " ").alias("text"))


def _dealt(
    docs: DataFrame, doc_id: str, text: str, source: str, weights, share: Fraction, repeats: int, block_tokens: int, seed: str
) -> tuple[DataFrame, DataFrame]:
    """All rows with their source's target, and the stretches of those with words in blocks that have a slot."""
    narrow = stage(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            shuffle_key(F.col(doc_id), F.col(text), seed).alias("shuffled"),
            word_count(F.col(text)).alias("size"),
        ),
        "mix-sizes",
    )
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = stage(
        targets(sizes, weights, share, repeats)
        .withColumn("tokens", F.floor("target").cast("long"))
        .withColumn("quota", F.ceil(F.col("tokens") / block_tokens).cast("long")),
        "mix-plan",
    )
    known = narrow.join(plan, narrow["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    placed = lines(known.filter(F.col("size") > 0))
    block = F.lit(block_tokens)
    spans = [
        F.sequence(
            F.floor((F.col("start") + F.col("source_size") * turn) / block),
            F.floor((F.col("start") + F.col("size") - 1 + F.col("source_size") * turn) / block),
        )
        for turn in range(repeats)
    ]
    turns = F.array(*[F.struct(F.lit(turn).alias("turn"), span.alias("blocks")) for turn, span in enumerate(spans)])
    pieces = (
        placed.withColumn("pass", F.explode(turns))
        .withColumn("block", F.explode("pass.blocks"))
        .withColumn("begin", F.col("start") + F.col("source_size") * F.col("pass.turn"))
        .withColumn(
            "words",
            F.greatest(
                F.least(F.col("begin") + F.col("size"), (F.col("block") + 1) * block, F.col("tokens"))
                - F.greatest(F.col("begin"), F.col("block") * block),
                F.lit(0),
            ),
        )
    )
    dealt = schedule(plan, block_tokens)
    return known, pieces.join(dealt.hint("merge"), ["source_no", "block"], "left")


def apply_mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mixed documents: each as often as the mix begins to read it.

    Documents of which the mix takes nothing go. Rows equal in id, source and
    text share evenly what was taken of them. Columns and rows are otherwise
    those of ``docs``.
    """
    seed = options.get("seed", "mix")
    taken = mix(docs, doc_id, text, source, **options)
    copies = (
        taken.groupBy(F.col("shuffled").alias("chosen"), F.col("source").alias("chosen_source"))
        .agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"))
        .filter(F.col("taken") > 0)
        .select("chosen", "chosen_source", F.ceil(F.col("taken") / F.col("size")).cast("int").alias("copies"))
    )
    packed = docs.select(
        F.struct("*").alias("doc"),
        shuffle_key(F.col(doc_id), F.col(text), seed).alias("shuffled"),
        F.col(source).alias("of"),
    )
    kept = packed.join(
        copies, (F.col("shuffled") == F.col("chosen")) & F.col("of").eqNullSafe(F.col("chosen_source"))
    )
    return kept.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")
