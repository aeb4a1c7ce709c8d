"""Phrase collocations from count streams that are merged in order, not looked up.

Phrases of one to four words are counted level by level, each level only where
its parts can still be frequent. The counts are then one stream that is sorted
twice. In prefix order a phrase comes right after its beginnings, and its
continuations follow it, so one pass in step gives the counts of all its first
parts and its commonest continuation. In suffix order the same pass gives the
counts of its last parts and its commonest extension to the left.

A range of a sorted stream may begin in the middle of the continuations of a
phrase. Each range hands on the few phrases that are open at its ends, and these
are put in afterwards, so a first word with a third of all phrases is no single task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.arrays import U64, encode, fold, mix64, place_words, slices, table
from ledgerlark.llm.bitmarks import GATHERED, KEY_BITS, marked, often, short_key
from ledgerlark.session import stage

LEAST = 30
LONGEST = 4
RANKED = 2000
# Rows of a sorted stream that are merged at a time.
CHUNK = 200_000
# Parts of a language that are ranked apart.
DEALS = 256

# What ends a piece of a text, and what else stands between words.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_ENDS = np.isin(np.arange(256), list(PIECE_ENDS))
_IN_WORDS = table(PIECE_ENDS + b"\x20\x09")
_WORD = re.compile(rb"[^.,;:!?\x0a-\x0d\x20\x09]+")

WORDS = [f"w{k}" for k in range(1, LONGEST + 1)]


def _salt(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def _sliced(batch: pa.RecordBatch):
    """By slice of texts: the languages, the joined bytes, and of every word its key, place, language and piece.

    The key of a word is a hash of the word and its language. Pieces are numbered through the slice.
    """
    langs = ["und" if v is None else v for v in batch.column(0).to_pylist()]
    numbers = {v: i for i, v in enumerate(dict.fromkeys(langs))}
    named, of_text = list(numbers), np.array([numbers[v] for v in langs], np.int64)
    salts = np.array([_salt(v) for v in named], U64)
    coded = encode(batch.column(1).to_pylist(), lower=True)
    for start, end in slices(coded):
        hashes, counts, places = place_words(coded[start:end], _IN_WORDS)
        lang = np.repeat(of_text[start:end], counts)
        keys = mix64(hashes ^ salts[lang]) if len(hashes) else hashes
        joined = b" ".join(coded[start:end])
        ends = np.flatnonzero(_ENDS[np.frombuffer(joined, np.uint8)])
        text = np.repeat(np.arange(end - start), counts)
        yield named, joined, keys, places, lang, text + np.searchsorted(ends, places)


def _words(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for _, _, keys, _, _, _ in _sliced(batch):
        yield keys


def _pairs(words):
    """Pairs of words that may be frequent and stand together in a piece."""

    def of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, _, keys, _, _, piece in _sliced(batch):
            good = marked(words.value, short_key(keys))
            at = np.flatnonzero(good[:-1] & good[1:] & (piece[:-1] == piece[1:]))
            yield fold([keys[at], keys[at + 1]])

    return of


def _chained(keys: np.ndarray, piece: np.ndarray, pairs) -> np.ndarray:
    """Where a pair stands that may be frequent."""
    pair = piece[:-1] == piece[1:]
    pair[pair] = marked(pairs.value, short_key(fold([keys[:-1][pair], keys[1:][pair]])))
    return pair


def _longer(pairs):
    """Phrases of three and four words whose pairs may all be frequent."""

    def of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, _, keys, _, _, piece in _sliced(batch):
            pair = _chained(keys, piece, pairs)
            chain = pair
            for size in range(3, LONGEST + 1):
                chain = chain[:-1] & pair[size - 2 :]
                at = np.flatnonzero(chain)
                yield fold([keys[at + k] for k in range(size)])

    return of


def _total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many words each language has."""
    for batch in batches:
        for named, _, _, _, lang, _ in _sliced(batch):
            total = np.bincount(lang, minlength=len(named))
            yield pa.RecordBatch.from_arrays([pa.array(named, pa.string()), pa.array(total, pa.int64())], ["lang", "n"])


class _Run:
    """Distinct phrases of one language and length in order, with their counts and, for single words, their texts."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, texts: np.ndarray | None):
        self.words, self.counts, self.texts = words, counts, texts

    @classmethod
    def joined(cls, runs: list[_Run]) -> _Run:
        words = np.concatenate([r.words for r in runs], axis=1)
        counts = np.concatenate([r.counts for r in runs])
        order = np.lexsort(words[::-1])
        words, counts = words[:, order], counts[order]
        first = np.flatnonzero(np.append(True, (words[:, 1:] != words[:, :-1]).any(axis=0)))
        texts = np.concatenate([r.texts for r in runs])[order[first]] if runs[0].texts is not None else None
        return cls(words[:, first], np.add.reduceat(counts, first), texts)


_RUNS = "lang string, size int, bucket long, " + ", ".join(f"{w} binary" for w in WORDS) + ", n binary, texts array<string>"
_RUN_FIELDS = pa.schema(
    [("lang", pa.string()), ("size", pa.int32()), ("bucket", pa.int64()), *[(w, pa.binary()) for w in WORDS],
     ("n", pa.binary()), ("texts", pa.list_(pa.string()))]
)
_COUNTS = "lang string, " + ", ".join(f"{w} long" for w in WORDS) + ", n long, word string"


def _cut(lang: str, size: int, run: _Run, buckets: int) -> pa.RecordBatch:
    """A run as one row for each bucket of first two words: columns of words that repeat shrink to little."""
    key = run.words[0] if size == 1 else fold([run.words[0], run.words[1]])
    bucket = (short_key(key) * U64(buckets) >> U64(KEY_BITS)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    first = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    rows = []
    for at in np.split(order, first[1:]):
        words = [w[at].tobytes() for w in run.words]
        n = run.counts[at].view(np.uint8).reshape(-1, 8).T.tobytes()
        texts = run.texts[at].tolist() if run.texts is not None else None
        rows.append((lang, size, int(bucket[at[0]]), *words, *[None] * (LONGEST - size), n, texts))
    return pa.RecordBatch.from_pylist([dict(zip(_RUN_FIELDS.names, row, strict=True)) for row in rows], _RUN_FIELDS)


def _send_runs(words, pairs, longer, buckets: int):
    """Sorted runs of the phrases that may be frequent: words with their text, and two to four words."""

    def found(batch: pa.RecordBatch) -> Iterator[tuple[str, int, _Run]]:
        for named, joined, keys, places, lang, piece in _sliced(batch):
            at = np.flatnonzero(marked(words.value, short_key(keys)))
            if not len(at):
                continue
            for size, at in [(1, at), *_frequent(keys, piece, pairs, longer)]:
                parts = [keys[at + k] for k in range(size)]
                _, first, counts = np.unique(fold(parts) if size > 1 else parts[0], return_index=True, return_counts=True)
                of = lang[at[first]]
                for one in np.unique(of):
                    mine = np.flatnonzero(of == one)
                    texts = None
                    if size == 1:
                        places_of = places[at[first[mine]]].tolist()
                        texts = np.array([_WORD.match(joined, p)[0].decode("utf-8", "surrogatepass") for p in places_of], object)
                    yield named[one], size, _Run(np.stack([part[first[mine]] for part in parts]), counts[mine], texts)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], list[_Run]] = {}
        count = 0
        for batch in batches:
            for lang, size, run in found(batch):
                held.setdefault((lang, size), []).append(run)
                count += len(run.counts)
                if count >= GATHERED:
                    held = {key: [_Run.joined(runs)] for key, runs in held.items()}
                    count = sum(len(runs[0].counts) for runs in held.values())
                    if count >= GATHERED // 2:
                        for (of, n), runs in held.items():
                            yield _cut(of, n, runs[0], buckets)
                        held, count = {}, 0
        for (of, n), runs in held.items():
            yield _cut(of, n, _Run.joined(runs), buckets)

    return send


def _frequent(keys: np.ndarray, piece: np.ndarray, pairs, longer) -> Iterator[tuple[int, np.ndarray]]:
    """Sizes, and where phrases of that size start that may be frequent."""
    pair = chain = _chained(keys, piece, pairs)
    for size in range(2, LONGEST + 1):
        at = np.flatnonzero(chain)
        if size > 2:
            at = at[marked(longer.value, short_key(fold([keys[at + k] for k in range(size)])))]
        if len(at):
            yield size, at
        chain = chain[:-1] & pair[size - 1 :]


def _merge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one bucket as phrases with exact counts; rare ones go."""

    def found(lang: str, size: int, runs: list[_Run]) -> pa.RecordBatch:
        run = _Run.joined(runs)
        kept = np.flatnonzero(run.counts >= LEAST)
        columns = [pa.array([lang] * len(kept), pa.string())]
        columns += [pa.array(w[kept].view(np.int64)) for w in run.words]
        columns += [pa.nulls(len(kept), pa.int64()) for _ in range(LONGEST - size)]
        texts = run.texts[kept].tolist() if run.texts is not None else [None] * len(kept)
        columns += [pa.array(run.counts[kept]), pa.array(texts, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["lang", *WORDS, "n", "word"])

    now, runs = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = (row["lang"], row["size"], row["bucket"])
            if key != now and runs:
                yield found(*now[:2], runs)
                runs = []
            now = key
            words = np.stack([np.frombuffer(row[w], U64) for w in WORDS[: row["size"]]])
            counts = np.ascontiguousarray(np.frombuffer(row["n"], np.uint8).reshape(8, -1).T).view(np.int64).ravel()
            runs.append(_Run(words, counts, np.array(row["texts"], object) if row["texts"] is not None else None))
    if runs:
        yield found(*now[:2], runs)


# --- merging in order --------------------------------------------------------

_PARTS = [f"part{k}" for k in range(1, LONGEST)]
_MERGED = "lang string, " + ", ".join(f"{w} long" for w in WORDS) + ", " + ", ".join(f"{p} long" for p in _PARTS)
_OPEN, _LATE, _OWNER = 1, 2, 3


def merge_step(sizes: np.ndarray, counts: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One pass over phrases in order, the beginnings of each among them or before the first.

    Returns for every phrase the rows of its beginnings of 1, 2 and 3 words (-1
    if that stands before the first row or is no shorter phrase), and raises
    ``most`` to the count of the commonest continuation by one word.
    """
    at = np.arange(len(sizes))
    above = np.full((LONGEST - 1, len(sizes)), -1)
    for k in range(1, LONGEST):
        last = np.maximum.accumulate(np.where(sizes == k, at, -1))
        above[k - 1] = np.where(sizes > k, last, -1)
        child = np.flatnonzero((sizes == k + 1) & (last >= 0))
        np.maximum.at(most, last[child], counts[child])
    return above, most


def _merge(chunk_rows: int):
    """Adds the counts of the beginnings and of the commonest continuation to a sorted range.

    What is open at the ends of the range is handed on in rows with a mark: the
    phrases whose continuations may go on in the next range, and the commonest
    continuation here of phrases that stand in a range before.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        late: dict[int, dict] = {}
        for chunk in _chunks(batches, chunk_rows):
            data = chunk if held is None else pa.concat_tables([held, chunk])
            sizes = sum((~data[w].combine_chunks().is_null().to_numpy(zero_copy_only=False)).astype(np.int64) for w in WORDS)
            counts = data["n"].to_numpy()
            above, most = merge_step(sizes, counts, data["most"].to_numpy().copy())
            parts = np.where(above >= 0, counts[above], -1)
            for size in range(2, LONGEST + 1):
                early = np.flatnonzero((sizes == size) & (above[size - 2] < 0))
                if len(early):
                    row = data.slice(int(early[0]), 1).to_pylist()[0]
                    mine = late.setdefault(size, {**row, WORDS[size - 1]: None, "most": 0})
                    mine["most"] = max(mine["most"], int(counts[early].max()))
            # The last row and the beginnings of it that stand here may have more continuations.
            last = len(sizes) - 1
            open_ = sorted({last, *(int(i) for i in above[:, last] if i >= 0)})
            done = np.setdiff1d(np.arange(len(sizes)), open_)
            yield _merged(data, done, parts, most, 0)
            place = data.schema.get_field_index("most")
            held = data.take(pa.array(open_)).set_column(place, data.schema.field(place), pa.array(most[open_]))
            tail = parts[:, open_]
        if held is not None:
            every = np.arange(len(held))
            yield _merged(held, every, tail, held["most"].to_numpy(), _OWNER)
            yield _merged(held, every, tail, np.zeros(len(held), np.int64), _OPEN)
        if late:
            rows = pa.Table.from_pylist(list(late.values()), schema=held.schema)
            yield _merged(rows, np.arange(len(rows)), np.full((LONGEST - 1, len(rows)), -1), rows["most"].to_numpy(), _LATE)

    return merge


def _chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    gathered, size = [], 0
    for batch in batches:
        if batch.num_rows:
            gathered.append(batch)
            size += batch.num_rows
        if size >= rows:
            yield pa.Table.from_batches(gathered)
            gathered, size = [], 0
    if gathered:
        yield pa.Table.from_batches(gathered)


def _merged(data: pa.Table, rows: np.ndarray, parts: np.ndarray, most: np.ndarray, mark: int) -> pa.RecordBatch:
    taken = data.take(pa.array(rows)).combine_chunks()
    found = [pa.array(parts[k][rows], mask=parts[k][rows] < 0) for k in range(LONGEST - 1)]
    columns = [taken["lang"], *[taken[w] for w in WORDS], *found, taken["n"], pa.array(most[rows])]
    columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
    extra = [taken[name].combine_chunks() for name in _EXTRA]
    return pa.RecordBatch.from_arrays(
        [*columns, pa.array(np.full(len(rows), mark, np.int32)), *extra],
        ["lang", *WORDS, *_PARTS, "n", "most", "mark", *_EXTRA],
    )


# What the first pass found travels through the second one.
_EXTRA = ["left1", "left2", "left3", "right_most"]


def _in_order(counts: DataFrame) -> DataFrame:
    """``counts`` with the counts of all beginnings (``part1`` to ``part3``) and the commonest continuation (``most``)."""
    order = [F.col("lang").asc(), *[F.col(w).asc_nulls_first() for w in WORDS]]
    rows = counts.withColumn("most", F.lit(0).cast("long"))
    extra = ", ".join(f"{name} long" for name in _EXTRA)
    merged = stage(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_merge(CHUNK), f"{_MERGED}, n long, most long, mark int, {extra}"),
        "merged",
    )
    # At most four open and three late phrases a range.
    edges: dict[tuple, list[int]] = {}
    for row in merged.filter(F.col("mark").isin(_OPEN, _LATE)).collect():
        known = edges.setdefault((row["lang"], *[row[w] for w in WORDS]), [0, 0])
        known[0] = max(known[0], row["n"] if row["mark"] == _OPEN else 0)
        known[1] = max(known[1], row["most"] if row["mark"] == _LATE else 0)
    kept = merged.filter(F.col("mark").isin(0, _OWNER))
    return kept.mapInArrow(_joined(edges), kept.schema).drop("mark")


def _joined(edges: dict[tuple, list[int]]):
    """Puts in what other ranges know: counts of beginnings, and continuations of a range's last phrases."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            words = [data[w].is_valid().to_numpy(zero_copy_only=False) for w in WORDS]
            size = sum(w.astype(np.int64) for w in words)
            for k, part in enumerate(_PARTS, 1):
                lost = np.flatnonzero((size > k) & ~data[part].is_valid().to_numpy(zero_copy_only=False))
                if len(lost):
                    rows = zip(*(data[c].take(pa.array(lost)).to_pylist() for c in ("lang", *WORDS[:k])), strict=True)
                    found = data[part].to_pandas().astype("Int64")
                    found.iloc[lost] = [edges[(*row, *[None] * (LONGEST - k))][0] for row in rows]
                    data[part] = pa.array(found, pa.int64())
            owners = np.flatnonzero(data["mark"].to_numpy() == _OWNER)
            if len(owners):
                most = data["most"].to_numpy().copy()
                rows = zip(*(data[c].take(pa.array(owners)).to_pylist() for c in ("lang", *WORDS)), strict=True)
                for at, row in zip(owners, rows, strict=True):
                    most[at] = max(most[at], edges[row][1])
                data["most"] = pa.array(most)
            yield pa.RecordBatch.from_arrays(list(data.values()), batch.schema.names)

    return join


def _size() -> Column:
    return sum((F.col(w).isNotNull().cast("int") for w in WORDS[1:]), F.col(WORDS[0]).isNotNull().cast("int"))


def _turned(rows: DataFrame) -> DataFrame:
    """Phrases with their words in opposite order."""
    words = F.reverse(F.slice(F.array(*WORDS), F.lit(1), _size()))
    other = rows.withColumn("turned", words)
    for k, w in enumerate(WORDS):
        other = other.withColumn(w, F.get("turned", F.lit(k)))
    return other.drop("turned")


def count_phrases(docs: DataFrame, lang: str = "lang", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Counts of frequent phrases (``lang``, ``w1`` to ``w4``, ``n``, ``word`` of single words), and words by language.

    Every level reads the texts anew. Words, then pairs, then longer phrases are first counted by short
    keys, each only where all its parts may be frequent; what reaches the least count sets a bit.
    Phrases with their bits set leave the tasks as sorted runs, which are merged into exact counts.
    """
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    totals = rows.mapInArrow(_total, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("total"))
    words = often(rows, _words, LEAST)
    pairs = often(rows, _pairs(words), LEAST)
    longer = often(rows, _longer(pairs), LEAST)
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = ["lang", "size", "bucket"]
    runs = rows.mapInArrow(_send_runs(words, pairs, longer, buckets), _RUNS).repartition(buckets, *by)
    return stage(runs.sortWithinPartitions(*by).mapInArrow(_merge_runs, _COUNTS), "counts"), stage(totals, "totals")


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", ranked: int = RANKED) -> DataFrame:
    """The best phrases of every language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``.

    Phrases of two to four words that occur 30 times or more within pieces of texts are candidates. A
    candidate is as strong as its weakest cut into two parts. It goes if a phrase of one more word around
    it, itself a candidate, occurs at least 0.8 times as often; longer ones occur no more often than that one.

    Words are told apart by 64-bit hashes. Null and empty texts have no words; a null language is ``und``;
    repeated rows count each; an empty table gives no rows. Other columns are not read. Counts are
    64-bit, products have 38 digits.
    """
    counts, totals = count_phrases(docs, lang, text)
    none = F.lit(None).cast("long")
    plain = counts.drop("word").select("*", *[none.alias(name) for name in _EXTRA])
    first = _in_order(plain)
    left = first.select(
        "lang", *WORDS, "n", *[F.col(p).alias(f"left{k}") for k, p in enumerate(_PARTS, 1)], F.col("most").alias("right_most")
    )
    both = _turned(_in_order(_turned(left)))
    size = _size()
    top = F.col("n").cast("decimal(20,0)") * 2_000_000
    cuts = []
    for k in range(1, LONGEST):
        # What is left of m words after k is m - k words.
        left, rest = F.col(f"left{k}"), F.get(F.array(*_PARTS), size - k - 1)
        score = F.call_function("div", top, left.cast("decimal(20,0)") + rest.cast("decimal(20,0)"))
        cuts.append(F.when(size > k, F.struct(score.alias("score"), F.lit(k).alias("k"), left.alias("l"), rest.alias("r"))))
    longest = F.greatest("most", "right_most")
    kept = (
        both.filter((size >= 2) & (longest.cast("decimal(20,0)") * 100 < F.col("n").cast("decimal(20,0)") * 80))
        .withColumn("cut", F.array_min(F.array(*cuts)))
        .select("lang", *WORDS, F.col("n").alias("a"), "cut.l", "cut.r", "cut.score")
    )
    # A language is ranked in parts first, so none is one task. Ties of the last place are all kept
    # until the words are known.
    near = kept.withColumn("deal", F.pmod(F.xxhash64(*WORDS), F.lit(DEALS)))
    for by in (["lang", "deal"], ["lang"]):
        strength = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("a").desc())
        near = near.withColumn("place", F.rank().over(strength)).filter(F.col("place") <= ranked).drop("place")
    known = counts.filter("word IS NOT NULL").select("w1", "word")
    for k, w in enumerate(WORDS, 1):
        near = near.join(known.select(F.col("w1").alias(w), F.col("word").alias(f"text{k}")), w, "left")
    named = near.withColumn("phrase", F.concat_ws(" ", *[f"text{k}" for k in range(1, LONGEST + 1)]))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    best = named.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= ranked)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
