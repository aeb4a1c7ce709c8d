"""WARC archives: records written by Spark, read back, and merged to one capture index.

A record is a gzip member of its own, as crawlers write them, so that file,
offset and length of an index row give the record without its neighbours. Of
equal payloads one is stored; the others are revisits that name it.

Every file is read to a run of index rows in the order of URL key and time. The
runs are cut at common range bounds, and each range merges the pieces of all
runs by a tournament tree of losers. The ranges in order are the capture
histories of the whole corpus.
"""

from __future__ import annotations

import base64
import hashlib
import time
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.session import scratch, stage

# Payloads from this size on are stored once.
LEAST_REVISIT = 1000
RECORDS_PER_FILE = 2000
ROWS_PER_RANGE = 10_000
# Originals that are broadcast at most, about 60 bytes each.
MOST_BROADCAST = 500_000

# Fixed values of the format.
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
GZIP = 31
# The text writer ends every row with a byte. An empty gzip member ends with a
# zero byte, so rows lack that byte and the writer adds it.
EMPTY = zlib.compress(b"", 6, wbits=GZIP)
LAST = "\0"


def url_key(url: str | None) -> str:
    """The host's labels from the right, then path and query; empty for a null."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").removeprefix("www.")
        port = parts.port
    except ValueError:
        return url.strip().lower()
    port_part = "" if port in (None, {"http": 80, "https": 443}.get(parts.scheme)) else f":{port}"
    query = "?" + "&".join(sorted(parts.query.split("&"))) if parts.query else ""
    path = parts.path.rstrip("/") or "/"
    return f"{','.join(reversed(host.split('.')))}{port_part}){path}{query}".lower()


def record(name: str, url: str | None, seconds: int, payload: bytes, refers: str | None) -> bytes:
    """A response record, or a revisit of the record ``refers``."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}".encode()
    block = http + END + (payload if refers is None else b"")
    head = [
        "WARC/1.0",
        f"WARC-Type: {'response' if refers is None else 'revisit'}",
        f"WARC-Record-ID: <urn:capture:{name}>",
        f"WARC-Date: {time.strftime('%Y-%m-%dT%H:%M:%SZ', time.gmtime(seconds))}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=chr(37) + ':/?#[]@!$&()*+,;=~')}")
    if refers is not None:
        head += [f"WARC-Refers-To: <urn:capture:{refers}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + END + block + END


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = zip(batch["name"], batch["url"], batch["seconds"], batch["payload"], batch["refers"], strict=True)
        yield pd.DataFrame(
            {
                "record": [
                    zlib.compress(record(name, url, int(seconds), payload.encode("utf-8", "surrogatepass"), refers), 6, wbits=GZIP)
                    + EMPTY[:-1]
                    for name, url, seconds, payload, refers in rows
                ]
            }
        )


def write_archives(
    pages: DataFrame,
    folder: str,
    seconds: Column,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    records_per_file: int = RECORDS_PER_FILE,
) -> None:
    """Write a record for every row of ``pages`` below ``folder``.

    ``seconds`` is the capture time since 1970 (null: 0). A null payload is
    empty. Of equal payloads of at least 1000 bytes the largest id is the response;
    rows that repeat that id are responses as well. Rows with a null id are
    responses, unless their payload is stored under another id. An empty table
    gives an archive without records.
    """
    rows = pages.select(
        F.col(page_id).alias("id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(seconds.cast("long"), F.lit(0)).alias("seconds"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("payload"),
    ).withColumn("digest", F.when(F.octet_length("payload") >= LEAST_REVISIT, F.sha1("payload")))
    stored = stage(
        rows.filter("digest IS NOT NULL")
        .groupBy("digest")
        .agg(F.max("id").alias("first"), F.count("*").alias("rows"))
        .filter("rows > 1 AND first IS NOT NULL")
        .select("digest", "first"),
        "originals",
    )
    if stored.count() <= MOST_BROADCAST:
        stored = F.broadcast(stored)
    named = rows.join(stored, "digest", "left").select(
        F.coalesce(F.col("id").cast("string"), F.concat(F.lit("null:"), F.sha1("payload"))).alias("name"),
        "url",
        "seconds",
        "payload",
        F.when(F.col("id").eqNullSafe(F.col("first")), None).otherwise(F.col("first").cast("string")).alias("refers"),
    )
    named.mapInPandas(_pack, "record binary").select(F.col("record").cast("string")).write.option(
        "lineSep", LAST
    ).option("compression", "none").option("maxRecordsPerFile", records_per_file).text(folder)


def members(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and text of every gzip member that is not empty."""
    at, piece = 0, 1 << 13
    while at < len(content):
        reader = zlib.decompressobj(GZIP)
        parts, fed = [], at
        while not reader.eof and fed < len(content):
            parts.append(reader.decompress(content[fed : fed + piece]))
            fed = min(fed + piece, len(content))
        if not reader.eof:
            raise ValueError(f"the member at byte {at} is cut off")
        end = fed - len(reader.unused_data)
        text = b"".join(parts)
        if text:
            yield at, end - at, text
        at = end


def _lines(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode().split("\r\n")[1:])}


def parse(text: bytes) -> dict[str, object]:
    """The index fields of a record; the digest of a response is checked."""
    head, _, rest = text.partition(END)
    fields = _lines(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(END)
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    kind = fields["warc-type"]
    size = int(_lines(http)["content-length"])
    if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != size):
        raise ValueError(f"{fields['warc-record-id']} is damaged")
    name = fields["warc-record-id"].removeprefix("<urn:capture:").removesuffix(">")
    refers = fields.get("warc-refers-to")
    return {
        "url_key": url_key(fields.get("warc-target-uri")),
        "captured": fields["warc-date"],
        "name": None if name.startswith("null:") else name,
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": refers and refers.removeprefix("<urn:capture:").removesuffix(">"),
    }


INDEX = (
    "url_key string, captured string, name string, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to string, file string, offset bigint, length bigint"
)
_COLUMNS = [part.split()[0] for part in INDEX.split(", ")]
ORDER = ["url_key", "captured", "file", "offset"]


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The index rows of each file, sorted: one run."""
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            rows = [
                {**parse(text), "file": path.rsplit("/", 1)[-1], "offset": offset, "length": length}
                for offset, length, text in members(bytes(content))
            ]
            if rows:
                yield pd.DataFrame(rows, columns=_COLUMNS).sort_values(ORDER)


class LoserTree:
    """Merges sorted lists: a match per level for each item, against the loser kept there."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs = [iter(run) for run in runs]
        self.heads = [next(run, None) for run in self.runs]
        self.losers = [-1] * len(runs)
        for leaf in range(len(runs)):
            self._play(leaf, first=True)

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and (x, a) < (y, b))

    def _play(self, winner: int, first: bool = False) -> None:
        node = (winner + len(self.runs)) // 2
        while node > 0:
            if self.losers[node] < 0 and first:
                self.losers[node] = winner
                return
            if not self._before(winner, self.losers[node]):
                winner, self.losers[node] = self.losers[node], winner
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.runs:
            top = self.losers[0]
            item = self.heads[top]
            if item is None:
                return
            yield item
            self.heads[top] = next(self.runs[top], None)
            self._play(top)


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A range in order: its rows come as pieces of runs, each ascending."""
    parts = [batch for batch in batches if len(batch)]
    if not parts:
        return
    rows = pd.concat(parts, ignore_index=True)
    runs: list[list[tuple]] = []
    for at, key in enumerate(zip(*(rows[c] for c in ORDER), strict=True)):
        if not runs or key < runs[-1][-1][0]:
            runs.append([])
        runs[-1].append((key, at))
    order = [at for _, at in LoserTree(runs)]
    yield rows.iloc[order].assign(place=range(len(order)))


def merged_index(spark: SparkSession, folder: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """The capture index of all archives below ``folder``.

    Columns: ``range_no`` and ``place`` (together the order by URL key, time, file
    and offset), ``url_key``, ``captured``, ``name`` (the id as text), the payload's
    size and digest, ``record_type``, ``refers_to``, and where the record is. Range
    bounds include file and offset, so the captures of one URL may fill many
    ranges; a range has about ``rows_per_range`` rows, which is what a task holds.
    """
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    runs = stage(files.mapInPandas(_runs, INDEX), "capture-runs")
    ranges = max(1, -(-runs.count() // rows_per_range))
    merged = runs.repartitionByRange(ranges, *ORDER).mapInPandas(_merge, f"{INDEX}, place bigint")
    return merged.withColumn("range_no", F.spark_partition_id())


def round_trip(pages: DataFrame, seconds: Column, page_id: str = "page_id", **columns: str) -> DataFrame:
    """Write ``pages`` to new archives in the shared folder and return their merged index.

    ``page_id`` and ``refers_to`` have the type of the id again.
    """
    spark = pages.sparkSession
    kind = pages.schema[page_id].dataType
    folder = scratch(spark, "archives")
    write_archives(pages, folder, seconds, page_id, **columns)
    return (
        merged_index(spark, folder)
        .withColumn("page_id", F.col("name").cast(kind))
        .withColumn("refers_to", F.col("refers_to").cast(kind))
        .drop("name")
    )
