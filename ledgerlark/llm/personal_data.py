"""Personal data in texts, plain and disguised, with spans in the source text.

Plain identifiers are read off the text itself. For the others a chain of
transducers brings the text to a normal form: look-alike letters and digits
become ASCII, invisible characters go, bracketed or spoken "at" and "dot" become
signs, and spoken digits become digits. Identifiers of the normal form are carried
back, edit by edit, to the characters of the source.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.rewriting import Rewriting, rewrite

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

# --- identifiers -------------------------------------------------------------

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A number inside a run of digits can never begin a match that the run's first digit does not.
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        n = int(digit) * (1 + place % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return 13 <= len(digits) <= 19 and luhn(digits)


def _is_phone(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


def _is_ip(text: str) -> bool:
    parts = [n.lstrip("0") for n in text.split(".")]
    return all(len(n) <= 3 and int(n or "0") <= 255 for n in parts)


def _emails(text: str) -> Iterator[Span]:
    """Met at the signs: a run of letters that no sign ends is never read twice."""
    done, sign = 0, text.find("@")
    while sign >= 0:
        start = sign
        while start > done and text[start - 1] in _LOCAL_SIGNS:
            start -= 1
        domain = _DOMAIN.match(text, sign + 1) if start < sign else None
        if domain:
            yield start, domain.end()
        done = domain.end() if domain else sign + 1
        sign = text.find("@", done)


def plain(text: str) -> dict[str, list[Span]]:
    """Undisguised identifiers by kind: leftmost matches, those that fail the kind's test dropped."""

    def matches(pattern, good):
        return [m.span() for m in pattern.finditer(text) if good(m.group())]

    return {
        "email": list(_emails(text)) if "@" in text else [],
        "ip": matches(_IP, _is_ip),
        "card": matches(_CARD, _is_card),
        "phone": matches(_PHONE, _is_phone) if "+" in text else [],
    }


# --- look-alikes -------------------------------------------------------------

# Cyrillic, Greek and Armenian letters that look like ASCII letters.
LOOKALIKES = {
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P",
    "С": "C", "Т": "T", "У": "Y", "Х": "X", "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x",
    "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "к": "k", "м": "m", "т": "t", "в": "b",
    "н": "h", "г": "r", "п": "n", "ь": "b", "З": "3", "з": "3", "б": "6",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "γ": "y", "ω": "w", "η": "n", "ո": "n", "օ": "o", "ս": "u", "ց": "g", "հ": "h", "զ": "q",
    "ı": "i", "ɡ": "g", "ɑ": "a", "ℓ": "l", "ᴏ": "o", "ǃ": "!",
}
# Dashes, full stops, blanks and signs.
SIGNS = {
    **dict.fromkeys("‐‑‒–—−﹣", "-"), **dict.fromkeys("。｡․•·", "."), **dict.fromkeys("    　", " "),
    "﹫": "@", "＠": "@", "⊕": "+", "➕": "+",
}
# Characters without width.
INVISIBLE = "­᠎​‌‍⁠﻿"
# Blocks with compatibility forms of ASCII characters, and of digits in circles or brackets.
FORMS = ((0x2070, 0x209F), (0x2100, 0x214F), (0x2460, 0x24FF), (0x2776, 0x2793), (0xFF01, 0xFF5E), (0x1D400, 0x1D7FF),
         (0x1F100, 0x1F12F))


def _lookalikes() -> dict[str, str]:
    """What every disguised character stands for."""
    found = {}
    for first, last in FORMS:
        for code in range(first, last + 1):
            shape = unicodedata.normalize("NFKC", chr(code)).strip("().,")
            if len(shape) == 1:
                shape = LOOKALIKES.get(shape, shape)
            if not shape and code in range(0xFF01, 0xFF5F):
                shape = unicodedata.normalize("NFKC", chr(code))
            if shape.isascii() and len(shape) == 1:
                found[chr(code)] = shape
    for code in range(0x80, 0x1FBFF):
        if unicodedata.category(chr(code)) == "Nd":
            found[chr(code)] = str(unicodedata.decimal(chr(code)))
    for code in (*range(0x2776, 0x277F), *range(0x2780, 0x2789), *range(0x278A, 0x2793)):
        found[chr(code)] = str(int(unicodedata.numeric(chr(code)))) if unicodedata.numeric(chr(code)) < 10 else ""
    return {c: shape for c, shape in {**found, **LOOKALIKES, **SIGNS, **dict.fromkeys(INVISIBLE, "")}.items() if c != shape}


FOLDS = _lookalikes()
_FOLDED = frozenset(FOLDS)
_ONE_FOR_ONE = str.maketrans({c: shape for c, shape in FOLDS.items() if len(shape) == 1})
_GONE = re.compile("[" + "".join(re.escape(c) for c, shape in sorted(FOLDS.items()) if not shape) + "]+")


def fold(before: Rewriting) -> Rewriting:
    """Look-alikes as ASCII, invisible characters gone."""
    if before.text.isascii():
        return before
    met = _FOLDED.intersection(before.text)
    if not met:
        return before
    gone = rewrite(before, _GONE, lambda m: "") if any(not FOLDS[c] for c in met) else before
    swapped = Rewriting(gone)
    swapped.text = gone.text.translate(_ONE_FOR_ONE)
    return swapped


# --- signs in brackets and words ---------------------------------------------

# Words for the two signs in English, German, French and Spanish.
_AT = "(?:at|arroba|arobase|arrobas|chez|klammeraffe)"
_DOT = "(?:dot|punkt|point|punto|period)"
_BRACKETED = re.compile(
    rf"[\x20\t]*(?:[\[({{<][\x20]?(?:(?P<at>{_AT}|@)|(?P<dot>{_DOT}|\.))[\x20]?[\])}}>]"
    rf"|(?<=[A-Za-z0-9\x20])[_-](?:(?P<at2>{_AT})|(?P<dot2>{_DOT}))[_-](?=[A-Za-z0-9\x20]))[\x20\t]*",
    re.IGNORECASE,
)
_HINT = re.compile(rf"[\[({{<_-][\x20]?(?:{_AT}|{_DOT}|[@.])[\x20]?[\])}}>_-]", re.IGNORECASE)
_LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9-]{0,62})"
# A spoken sign counts only where the whole address is spoken, or its other parts are plain.
_SPOKEN_AT = re.compile(
    rf"(?<=[A-Za-z0-9])\x20{_AT}\x20(?={_LABEL}(?:(?:\x20{_DOT}\x20|\.){_LABEL}){{1,8}}(?![A-Za-z0-9-]))", re.IGNORECASE
)
_SPOKEN_DOT = re.compile(rf"(?<=[A-Za-z0-9])\x20{_DOT}\x20(?=[A-Za-z0-9])", re.IGNORECASE)
_SPOKEN = tuple(f" {w} " for part in (_AT, _DOT) for w in part[3:-1].split("|"))
_NAME_END = re.compile(r"[A-Za-z0-9._%+-]+$")
_ANY_DOT = re.compile(rf"\x20{_DOT}\x20", re.IGNORECASE)


def signs(before: Rewriting) -> Rewriting:
    """Bracketed "at" and "dot" as signs."""
    if not _HINT.search(before.text):
        return before

    def sign(m):
        inner = "@" if m["at"] or m["at2"] else "."
        left, right = before.text[m.start() - 1 : m.start()], before.text[m.end() : m.end() + 1]
        return inner if left.isascii() and left.isalnum() and right.isascii() and right.isalnum() else None

    return rewrite(before, _BRACKETED, sign)


def spoken(before: Rewriting) -> Rewriting:
    """Spoken "at" as a sign, and "dot" between numbers and in the host of an address.

    "at" alone is a common word: it counts if the host after it has a spoken
    dot, or if the name before it has a digit or a sign as well as a letter.
    """
    low = before.text.lower()
    if not any(w in low for w in _SPOKEN):
        return before

    def at(m):
        host = re.match(rf"{_LABEL}(?:(?:\x20{_DOT}\x20|\.){_LABEL})+", before.text[m.end() : m.end() + 600], re.IGNORECASE)
        name = _NAME_END.search(before.text[max(0, m.start() - 80) : m.start()])[0]
        odd = re.search("[0-9._%+-]", name) and re.search("[A-Za-z]", name)
        return "@" if odd or _ANY_DOT.search(host[0]) else None

    with_at = rewrite(before, _SPOKEN_AT, at)
    hosts = [m.end() for m in re.finditer("@", with_at.text)]
    text, inside = with_at.text, set()
    chain = re.compile(rf"[A-Za-z0-9-]{{1,63}}(?:(?:\x20{_DOT}\x20|\.)[A-Za-z0-9-]{{1,63}})+", re.IGNORECASE)
    for start in hosts:
        found = chain.match(text, start)
        if found:
            inside.update(start + m.start() for m in _SPOKEN_DOT.finditer(found[0]))

    def dot(m):
        numbers = text[m.start() - 1].isdigit() and text[m.end()].isdigit()
        return "." if numbers or m.start() in inside else None

    return rewrite(with_at, _SPOKEN_DOT, dot)


# --- spoken digits -----------------------------------------------------------

# Words for the digits in English, German, French and Spanish.
DIGIT_WORDS = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8",
    "nine": "9", "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "fuenf": "5",
    "sechs": "6", "sieben": "7", "acht": "8", "neun": "9", "zéro": "0", "deux": "2", "trois": "3", "quatre": "4",
    "cinq": "5", "sept": "7", "huit": "8", "neuf": "9", "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4",
    "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
# Words that are digits only beside other digits.
WEAK_WORDS = {"oh": "0", "o": "0", "un": "1", "une": "1", "una": "1", "ein": "1", "eine": "1"}
_NUMBER = "(?:" + "|".join(sorted({*DIGIT_WORDS, *WEAK_WORDS}, key=lambda w: (-len(w), w))) + ")"
_SPOKEN_RUN = re.compile(rf"(?<!\w)(?:plus[\x20-])?{_NUMBER}(?:[\x20.(),-]{{1,3}}(?:{_NUMBER}|[0-9])(?!\w))+", re.IGNORECASE)
_WORD = re.compile(r"\w+", re.UNICODE)
_PLUS = re.compile(r"(?<!\w)plus\x20?(?=[0-9])", re.IGNORECASE)
_LEAST_SPOKEN = 3


def _may_have_runs(low: str) -> bool:
    """Whether three digit words stand close together, by the words alone."""
    for sign in ".,()-":
        low = low.replace(sign, " ")
    words = low.split()
    if DIGIT_WORDS.keys().isdisjoint(words):
        return False
    at = [i for i, w in enumerate(words) if w in DIGIT_WORDS]
    return any(b - a <= 4 * _LEAST_SPOKEN for a, b in zip(at, at[_LEAST_SPOKEN - 1 :], strict=False))


def spoken_digits(before: Rewriting) -> Rewriting:
    """Digits for digit words, in runs of at least three of them; "plus" before digits as a sign."""
    text = before.text
    low = text.lower()
    edits: list[tuple[int, int, str]] = []
    if _may_have_runs(low):
        for run in _SPOKEN_RUN.finditer(text):
            words = list(_WORD.finditer(text, *run.span()))
            if sum(w[0].lower() in DIGIT_WORDS for w in words) < _LEAST_SPOKEN:
                continue
            for at, w in enumerate(words):
                word = w[0].lower()
                digit = DIGIT_WORDS.get(word) or WEAK_WORDS.get(word)
                if not digit:
                    continue
                # A comma or a longer gap between two digits of a run is one blank.
                start = w.start()
                gap = text[words[at - 1].end() : start] if at else ""
                if gap and gap not in (" ", "-", ".") and words[at - 1][0].lower() != "plus" and not {"(", ")"} & set(gap):
                    edits.append((words[at - 1].end(), w.end(), " " + digit))
                else:
                    edits.append((start, w.end(), digit))
    done = Rewriting(before, edits) if edits else before
    return rewrite(done, _PLUS, lambda m: "+") if "plus" in low else done


_MIXED = re.compile(r"(?<=[0-9])[OolI|](?=[0-9OolI|.\x20-]{0,3}[0-9])|(?<![A-Za-z0-9])[OolI|](?=[0-9])|(?<=[0-9])[OolI|](?![A-Za-z0-9@])")
_NEAR = re.compile(r"[0-9][OolI|]|[OolI|][0-9]")
_AS_DIGIT = {"O": "0", "o": "0", "l": "1", "I": "1", "|": "1"}


def letters_as_digits(before: Rewriting) -> Rewriting:
    """O, o, l, I and | among digits as 0 and 1."""
    if not _NEAR.search(before.text):
        return before
    return rewrite(before, _MIXED, lambda m: _AS_DIGIT[m[0]])


CHAIN = (fold, signs, spoken, spoken_digits, letters_as_digits)

# --- both together -----------------------------------------------------------

_GROUP = re.compile("[0-9]+")


def _cards(normal: str, changed) -> Iterator[Span]:
    """Card numbers of the normal form; plain numbers beside a disguised one may be left off."""
    for m in _CARD.finditer(normal):
        if _is_card(m[0]):
            yield m.span()
            continue
        groups = [g.span() for g in _GROUP.finditer(normal, *m.span())]
        odd = [i for i, (a, b) in enumerate(groups) if changed(a, b)]
        if not odd or len(groups) > 40:
            continue
        options = [
            (groups[i][0], groups[j][1])
            for i in range(odd[0] + 1)
            for j in range(odd[-1], len(groups))
            if _is_card(normal[groups[i][0] : groups[j][1]])
        ]
        if options:
            yield max(options, key=lambda s: (s[1] - s[0], -s[0]))


def disguised(text: str, base: dict[str, list[Span]]) -> dict[str, list[Span]]:
    """Spans of identifiers that only the normal form shows, by kind."""
    last = Rewriting(text)
    for step in CHAIN:
        last = step(last)
    if last.text == text:
        return {kind: [] for kind in KINDS}
    normal = last.text

    def changed(start, end):
        a, b = last.span(start, end)
        return text[a:b] != normal[start:end]

    found = {kind: spans for kind, spans in plain(normal).items()}
    found["card"] = list(_cards(normal, changed))
    added = {}
    for kind in KINDS:
        spans = [last.span(*span) for span in found[kind] if changed(*span)]
        held, at, kept = base[kind], 0, []
        for start, end in sorted(set(spans)):
            while at < len(held) and held[at][1] <= start:
                at += 1
            # A span that a plain one holds already adds nothing.
            if not (at < len(held) and held[at][0] <= start and end <= held[at][1]):
                kept.append((start, end))
        added[kind] = kept
    return added


def spans(text: str | None) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Plain and added spans of a text by kind, in code points; a null text has none."""
    if not text:
        return {kind: [] for kind in KINDS}, {kind: [] for kind in KINDS}
    base = plain(text)
    return base, disguised(text, base)


def listed(found: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in sorted(found[kind]))


_SPANS = "array<struct<kind:string,start:long,end:long,plain:boolean>>"
_FOUND = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("plain", pa.bool_())])


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for text in batch.column(0):
            base, added = spans(text.as_py())
            found.append(
                sorted(
                    [(kind, a, b, True) for kind in KINDS for a, b in base[kind]]
                    + [(kind, a, b, False) for kind in KINDS for a, b in added[kind]],
                    key=lambda s: (s[1], s[2], s[0]),
                )
            )
        rows = [[dict(zip(("kind", "start", "end", "plain"), s, strict=True)) for s in row] for row in found]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(_FOUND)), *batch.columns[1:]], ["found", *batch.schema.names[1:]])


def find(docs: DataFrame, text: str = "text", carry: dict[str, Column] | None = None) -> DataFrame:
    """``found`` for every row of ``docs``: kind, start, end (code points, end exclusive), and whether it is plain.

    ``carry`` names what else is returned with it. Nothing is shuffled. A null or empty text has
    nothing in it; repeated rows are searched each; an empty table gives no rows. Texts are
    searched whole, each step in time linear in the text.
    """
    carry = carry or {}
    rows = docs.select(F.col(text).cast("string").alias("text"), *[c.alias(f"_{name}") for name, c in carry.items()])
    kept = ", ".join(f"`_{name}` {rows.schema[f'_{name}'].dataType.simpleString()}" for name in carry)
    out = rows.mapInArrow(_find, f"found {_SPANS}" + (f", {kept}" if kept else ""))
    return out.select("found", *[F.col(f"_{name}").alias(name) for name in carry])


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every identifier in ``text`` replaced by its kind in brackets.

    Overlapping spans become one, named after the first. A null text stays null; other columns,
    whatever their names, are returned as they are.
    """
    whole = find(docs, text, {"doc": F.struct("*")}).select("found", "doc.*")
    merged = F.aggregate(
        "found",
        F.array().cast("array<struct<kind:string,start:long,end:long>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] > s["start"]),
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["kind"].alias("kind"),
                        F.element_at(done, -1)["start"].alias("start"),
                        F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))),
    )
    return _masked(whole, text, merged)


def _masked(whole: DataFrame, text: str, merged: Column) -> DataFrame:
    pieces = F.aggregate(
        merged,
        F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at")),
        lambda so, s: F.struct(
            F.concat(
                so["done"],
                F.substr(F.col(text), (so["at"] + 1).cast("int"), (s["start"] - so["at"]).cast("int")),
                F.lit("["),
                s["kind"],
                F.lit("]"),
            ).alias("done"),
            s["end"].alias("at"),
        ),
        lambda so: F.concat(so["done"], F.substr(F.col(text), (so["at"] + 1).cast("int"))),
    )
    return whole.withColumn(text, F.when(F.size("found") > 0, pieces).otherwise(F.col(text))).drop("found")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", *[f"n_{kind}" for kind in KINDS], "base_sha256", "spans", "n_added"]
    for batch in batches:
        rows = []
        for found in batch.column(0):
            base, every = {k: [] for k in KINDS}, {k: [] for k in KINDS}
            for s in found.as_py():
                every[s["kind"]].append((s["start"], s["end"]))
                if s["plain"]:
                    base[s["kind"]].append((s["start"], s["end"]))
            sha = hashlib.sha256(listed(base).encode()).hexdigest()
            added = sum(map(len, every.values())) - sum(map(len, base.values()))
            rows.append((*[len(base[k]) for k in KINDS], sha, listed(every), added))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
        kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(1), *arrays], names)


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: plain identifiers by kind, a digest of their spans, all spans, and how many were disguised."""
    kind = docs.schema[doc_id].dataType.simpleString()
    found = find(docs, text, {"doc_id": F.col(doc_id)})
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return found.mapInArrow(_digest, f"doc_id {kind}, {counts}, base_sha256 string, spans string, n_added long")
