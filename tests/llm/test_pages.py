"""Archives and main text on small pages."""

import hashlib
import random
import time
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import archives, main_text
from ledgerlark.llm.page_blocks import leaf_blocks
from ledgerlark.session import scratch


@pytest.mark.parametrize("count", range(9))
def test_loser_tree_merges(count):
    draw = random.Random(count)
    runs = [sorted((draw.randrange(20), i) for i in range(draw.randrange(12))) for _ in range(count)]
    assert list(archives.LoserTree(runs)) == sorted(x for run in runs for x in run)


@pytest.mark.parametrize(
    ("url", "key"),
    [
        ("https://www.Example.com:443/A/?b=2&a=1#top", "com,example)/a?a=1&b=2"),
        ("http://blog.example.org:8080", "org,example,blog:8080)/"),
        (None, ""),
        ("", ""),
        ("http://[bad", "http://[bad"),
    ],
)
def test_url_keys(url, key):
    assert archives.url_key(url) == key


def test_record_round_trip():
    for payload in (b"", b"\r\n\r\nWARC/1.0\r\n", "é".encode() * 3000, bytes(range(256)) * 50):
        text = archives.record("7", "http://a.b/c d\r\nX: 1", 10, payload, None)
        packed = zlib.compress(text, 6, wbits=archives.GZIP) + archives.EMPTY
        found = list(archives.members(packed * 3))
        assert len(found) == 3 and found[0][2] == text and b"\nX: 1" not in text
        fields = archives.parse(text)
        assert (fields["name"], fields["payload_bytes"]) == ("7", len(payload))
        assert fields["payload_digest"] == hashlib.sha1(payload).hexdigest()
    with pytest.raises(ValueError, match="cut off"):
        list(archives.members(packed[:-30]))
    with pytest.raises(ValueError, match="damaged"):
        archives.parse(archives.record("7", None, 0, b"abcdef", None).replace(b"abcdef", b"abcdeg"))


def page_rows():
    big, other = "<p>" + "x" * 1000, "é" * 500
    rows = [(i, f"http://h{i % 3}.com/p", big) for i in range(40)] + [(100, "http://h1.com/p", other), (101, None, other)]
    rows += [(102, "u", "small"), (103, "u", "small"), (104, None, None), (105, "u", ""), (39, "again", big), (None, "n", big)]
    return rows + [(None, None, None), (106, "long", "word " * 200_000)]


def test_archives(spark):
    rows = page_rows()
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, file string").repartition(3)
    got = archives.round_trip(pages, F.lit(5) + F.col("page_id")).collect()
    largest = {}
    for i, _, html in rows:
        if i is not None and html and len(html.encode()) >= 1000:
            largest[html] = max(i, largest.get(html, i))
    want = Counter()
    for i, _, html in rows:
        payload = (html or "").encode()
        first = largest.get(html)
        same = first is None or first == i
        want[i, len(payload), hashlib.sha1(payload).hexdigest(), "response" if same else "revisit", None if same else first] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    # Histories are in one global order, whatever the number of ranges.
    order = sorted(got, key=lambda r: (r.range_no, r.place))
    keys = [(r.url_key, r.captured, r.file, r.offset) for r in order]
    assert keys == sorted(keys)


def test_archives_in_many_ranges_and_files(spark):
    pages = spark.range(500).select(F.col("id").alias("page_id"), F.lit("http://hot.com/").alias("url"), F.col("id").cast("string").alias("html"))
    folder = scratch(spark, "archives")
    archives.write_archives(pages.repartition(4), folder, F.col("page_id") % 7, records_per_file=30)
    index = archives.merged_index(spark, folder, rows_per_range=60)
    rows = sorted(index.collect(), key=lambda r: (r.range_no, r.place))
    assert len(rows) == 500 and len({r.range_no for r in rows}) > 3
    keys = [(r.url_key, r.captured, r.file, r.offset) for r in rows]
    assert keys == sorted(keys)


def test_archives_of_nothing(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert archives.round_trip(pages, F.col("page_id")).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>No &amp; no</title><style>p{}</style><script>var a="</p>";</script></head>
<body class="home"><header class="site-header"><h1>My Site</h1></header>
<nav><ul><li><a href="/">Home</a><li><a href="/b">B</a></ul></nav>
<div class="cookie-notice"><p>We use cookies here.</p><button>OK</button></div>
%s
<h1>A title of the story</h1>
<p>The first <b>bold</b>&nbsp;words, and more of them &mdash; plainly said.<p>Unclosed one,<br>with a break. It goes on.
<div class="ad"><a href="/buy">Buy this now.</a></div>
<blockquote>He said so, and nobody doubted it at all.</blockquote>
<form action="/s"><label>Mail</label><input><textarea>not this</textarea></form>
%s
<aside class="sidebar"><h3>Related</h3><ul><li><a href="/x">Other</a></ul></aside>
<section class="comments"><div class="comment"><p>I liked it. Really, I did.</p></div></section>
<footer>&copy; 2020 My Site</footer><!-- <p>hidden</p> --></body></html>"""
STORY = (
    "A title of the story The first bold words, and more of them — plainly said. Unclosed one, with a break. It goes on. "
    "He said so, and nobody doubted it at all."
)


def test_leaf_blocks():
    blocks = leaf_blocks(PAGE % ("<article>", "</article>"))
    assert [b.text for b in blocks if "article" in b.inside and b.tag == "p"] == [
        "The first bold words, and more of them — plainly said.",
        "Unclosed one, with a break. It goes on.",
    ]
    assert not any("hidden" in b.text or "var a" in b.text or "No & no" in b.text or "not this" in b.text for b in blocks)
    assert leaf_blocks("") == [] and [b.text for b in leaf_blocks("a < b <i>c</i>d & <p")] == ["a < b cd & <p"]
    assert leaf_blocks("<div>" * 3000 + "deep")[0].text == "deep"


@pytest.fixture(scope="module")
def field(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    return main_text.train(pages)


@pytest.mark.parametrize(
    "around",
    [("<article>", "</article>"), ("<main>", "</main>"), ('<div class="post-body">', "</div>"), ('<div id="content">', "</div>")],
)
def test_main_text(spark, field, around):
    pages = spark.createDataFrame([(1, "u", PAGE % around)], "page_id bigint, url string, html string")
    row = main_text.extract(pages, field).first()
    assert (row.text, row.n_chars) == (STORY, len(STORY))


def test_main_text_on_unseen_layouts(field):
    wrong = total = 0
    for page in main_text.layouts(100, seed=99):
        blocks = leaf_blocks(page)
        labels = field.decode(main_text.block_features(blocks))
        wrong += sum(label != (b.mark or 0) for b, label in zip(blocks, labels, strict=True))
        total += len(blocks)
    assert wrong < 0.02 * total


def test_decode_is_the_best_path(field):
    from itertools import product

    blocks = leaf_blocks(next(main_text.layouts(1, seed=5)))[:9]
    rows = main_text.block_features(blocks)

    def value(path):
        emit = sum(field.weights[field.index[f]] for label, row in zip(path, rows, strict=True) if label for f in row if f in field.index)
        return field.start[path[0]] + emit + sum(field.step[a][b] for a, b in zip(path, path[1:], strict=False))

    assert value(field.decode(rows)) == pytest.approx(max(value(p) for p in product((0, 1), repeat=len(rows))))


def test_main_text_edges(spark, field):
    rows = [(1, None, None), (None, "u", ""), (2, "u", "no tags at all"), (2, "u", "no tags at all"), (3, "u", "<p>" + "A long one, it is. " * 50_000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, text string")
    got = main_text.extract(pages, field).collect()
    assert len(got) == 5 and [r.n_chars for r in got if r.page_id in (1, None)] == [0, 0]
    assert all(r.n_chars == len(r.text) for r in got)
    assert main_text.extract(pages.limit(0), field).count() == 0
    assert main_text.train(pages.limit(0)).index


BAD = {
    "nested": "<div>x",
    "nested with classes": '<div class="a{i} b{i}">x',
    "own elements": "<x-{i}>x",
    "open ends": "</b",
    "open quotes": '<a x="',
    "quoted ends": '<a "b>c"',
    "end tags without a start": "</p>",
    "list items": "<li></li>",
    "comments": "<!--",
    "less than": "<",
}


@pytest.mark.parametrize("piece", list(BAD), ids=str)
@pytest.mark.parametrize("start", ["", "<div>" * 5000, "<li>" + "<ul>" + "<div>" * 5000])
def test_bad_pages_take_linear_time(piece, start):
    size = 1_000_000
    parts, length, i = [start], 0, 0
    while length < size:
        parts.append(BAD[piece].replace("{i}", str(i)))
        length += len(parts[-1])
        i += 1
    begin = time.process_time()
    blocks = leaf_blocks("".join(parts), main_text.KNOWN)
    assert time.process_time() - begin < 20
    assert len(blocks) <= i + 1


def test_tail_of_a_page_is_text():
    assert [b.text for b in leaf_blocks("<p>one</p> two < three </b")] == ["one", "two < three </b"]
    assert [b.text for b in leaf_blocks("<p>one</p> two <!-- not this")] == ["one", "two"]
    assert [b.text for b in leaf_blocks("no tags")] == ["no tags"]
    assert leaf_blocks("") == [] == leaf_blocks("<!-- <p>x</p>")


def test_long_chains_are_learned_to_their_end(spark):
    """What follows an article of more than 400 blocks is told from it, though it looks the same."""
    page = "<article>" + "<p>It is, as said, a line of text.</p>" * 500 + '</article><div class="zzz"><p>It is, as said, a line.</p></div>'
    pages = spark.createDataFrame([(i, "u", page + f"<!-- {i} -->") for i in range(30)], "page_id long, url string, html string")
    field = main_text.train(pages)
    assert "name:zzz" in field.index


def test_one_id_on_most_pages_does_not_pass_the_bound(spark):
    rows = [(1, f"<article><p>Page {i} is a page, no more.</p></article>") for i in range(400)] + [(2, "<main><p>x</p></main>")] * 400
    pages = spark.createDataFrame(rows, "page_id long, html string")
    from ledgerlark.llm.labelled import sample

    assert 5 < sample(pages, 40, F.col("page_id"), F.col("html")).count() <= 80
    assert sample(pages, 2000, F.col("page_id"), F.col("html")).count() == 401
