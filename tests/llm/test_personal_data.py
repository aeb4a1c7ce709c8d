"""Spans of personal data against plain regular expressions, and disguises planted in texts."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerlark.llm.personal_data import KINDS, find, luhn, mask, report, spans
from ledgerlark.llm.rewriting import Rewriting, rewrite

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def good(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(n) <= 255 for n in match.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return {k: [m.span() for m in re.finditer(p, text) if good(k, m.group())] for k, p in PATTERNS.items()}


def test_plain_spans_are_those_of_the_patterns():
    draw = random.Random(5)
    for _ in range(3000):
        text = "".join(draw.choice("aZ09.@+- ()%1é_\n4") for _ in range(draw.randrange(60)))
        assert spans(text)[0] == brute(text), text
    for _ in range(300):
        parts = ["a.b@c-d.e", "1.2.3.4.5.6.7.8", "999.1.1.1", "4736 9625-7309 9581", "+1 (017) 555-7713", "@", "+", " ", ".", "é"]
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(12)))
        assert spans(text)[0] == brute(text), text


def test_spans_go_back_through_edits():
    draw = random.Random(7)
    for _ in range(500):
        text = "".join(draw.choice("abc") for _ in range(draw.randrange(1, 30)))
        now, origins = Rewriting(text), [(i, i + 1) for i in range(len(text))]
        for _ in range(3):
            old, new = draw.choice(["a", "ab", "b", "ca", "cc"]), draw.choice(["", "x", "ab", "bca"])
            after = []
            at = 0
            for m in re.finditer(old, now.text):
                after += origins[at : m.start()]
                held = origins[m.start() : m.end()]
                after += [(held[0][0], held[-1][1])] * len(new)
                at = m.end()
            origins = after + origins[at:]
            now = rewrite(now, re.compile(old), lambda m, new=new: new)
        assert len(origins) == len(now.text)
        for start in range(len(now.text)):
            for end in range(start + 1, len(now.text) + 1):
                assert now.span(start, end) == (origins[start][0], origins[end - 1][1])


DISGUISES = [
    ("email", "john.doe [at] mail7 (dot) example [dot] com"),
    ("email", "und.34 AT mail7 DOT example dot com"),
    ("email", "und.34 at mail7.example.com"),
    ("email", "und.34@mail7 dot example dot com"),
    ("email", "und.34＠mail7．example．com"),
    ("email", "аdmin@mаil.com"),
    ("email", "un​d.34(at)mail7.exam­ple.com"),
    ("email", "user -at- mail -dot- com"),
    ("ip", "97[.]51[.]17[.]173"),
    ("ip", "97 dot 51 dot 17 dot 173"),
    ("ip", "９７.51.17.173"),
    ("card", "four seven three six nine six two five 7309 9581"),
    ("card", "４７３６９６２５７３０９９５８１"),
    ("card", "47З6 9625 7309 9581"),
    ("card", "vier sieben drei sechs neun sechs zwei fünf sieben drei null neun neun fünf acht eins"),
    ("phone", "+1 (five five five) 555-7713"),
    ("phone", "plus one zero one seven five five five seven seven one three"),
    ("phone", "+1 (O17) 555-77l3"),
]


@pytest.mark.parametrize(("kind", "text"), DISGUISES)
@pytest.mark.parametrize(("left", "right"), [("", ""), ("Éauxment: ", ", und."), ("😀 Ofer the ", ".\nThe")])
def test_disguises_are_found_where_they_stand(kind, text, left, right):
    base, added = spans(left + text + right)
    assert (len(left), len(left) + len(text)) in added[kind]
    assert all(s == (len(left), len(left) + len(text)) for k in KINDS for s in added[k])


@pytest.mark.parametrize(
    "text",
    [
        "Look at the end. At it dot, un un un deux la.",
        "Meet at example.com now",
        "one two three four and five",
        "+1 (017) 555-7713 one thing",
        "und.34@mail7.example.com one two three",
        "the [dot] and (at) of things at 5 dot",
        "Ächte für ÉAUX ñ ß",
        "",
        None,
    ],
)
def test_nothing_is_added_to_clean_texts(text):
    base, added = spans(text)
    assert all(not found for found in added.values())
    assert base == brute(text or "")


@pytest.mark.parametrize(
    "piece", ["a", "1", "1.", "@", "a@", "+1 ", "one ", " at a dot", "(at) ", "а", "1 1l", "a dot ", "0"]
)
def test_long_texts_take_linear_time(piece):
    spans(piece * (200_000 // len(piece)))


def test_rows_digest_and_mask(spark, table, rows):
    docs = table(
        (1, "a b.c@d.ef, 97[.]51[.]17[.]173 x", "s"),
        (1, "a b.c@d.ef, 97[.]51[.]17[.]173 x", "s"),
        (None, None, None),
        (9007199254740993, "", "s"),
    )
    found = rows(report(docs))
    empty = hashlib.sha256(b"").hexdigest()
    one = (1, 1, 0, 0, 0, hashlib.sha256(b"email:2:10").hexdigest(), "email:2:10,ip:12:30", 1)
    assert sorted(map(str, found)) == sorted(
        map(str, [one, one, (None, 0, 0, 0, 0, empty, "", 0), (9007199254740993, 0, 0, 0, 0, empty, "", 0)])
    )
    masked = mask(docs)
    assert masked.columns == docs.columns
    assert [r.text for r in masked.filter("doc_id = 1").collect()] == ["a [email], [ip] x"] * 2
    assert masked.filter("doc_id IS NULL").first().text is None
    assert rows(find(docs.limit(0))) == [] and rows(report(docs.limit(0))) == []
    clash = docs.withColumn("found", F.lit(1)).withColumn("doc", F.lit(2))
    assert mask(clash.drop("found")).filter("doc_id = 1").count() == 2
