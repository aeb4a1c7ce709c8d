"""Whole texts as numpy arrays: words, hashes and shingles without a loop per word.

Texts are taken in slices of bounded bytes, and a long text in bounded pieces
cut at word ends, so memory follows the slice and not the longest text times
the width of an array.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SLICE_BYTES = 4_000_000
PIECE_BYTES = 2_000_000

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_FOLD = U64(0xD6E8FEB86659FD93)

# Fixed value: ASCII white space.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"


def table(breaks: bytes) -> np.ndarray:
    """A look-up by byte: 1 where the byte belongs to a word."""
    found = np.ones(256, np.uint8)
    found[list(breaks)] = 0
    return found


BY_SPACE = table(SPACES)
ALPHANUMERIC = table(bytes(b for b in range(128) if not chr(b).isalnum()))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit numbers (the splitmix64 finisher)."""
    y = x >> U64(30)
    y ^= x
    y *= U64(0xBF58476D1CE4E5B9)
    y ^= y >> U64(27)
    y *= U64(0x94D049BB133111EB)
    y ^= y >> U64(31)
    return y


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, U64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of an odd base and of its inverse, modulo 2^64."""
    size = max(1 << 16, 1 << (n - 1).bit_length()) if n else 1 << 16
    if size not in _cache:
        _cache.clear()
        _cache[size] = (_powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size))
    return _cache[size]


def encode(texts, lower: bool) -> list[bytes]:
    """UTF-8 of every text, null as empty; with ``lower``, A-Z are lowered."""
    coded = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    return [c.lower() for c in coded] if lower else coded


def slices(coded: list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes together; a longer text is alone."""
    start = size = 0
    for i, c in enumerate(coded):
        if size and size + len(c) > limit:
            yield start, i
            start, size = i, 0
        size += len(c) + 1
    if start < len(coded):
        yield start, len(coded)


def _piece(data: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.zeros(len(data) + 2, np.int8)
    edge[1:-1] = words[data]
    change = np.diff(edge)
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * up[: len(data)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    return starts, mix64(hashes + (ends - starts).astype(U64) * _FOLD)


def hash_words(coded: list[bytes], words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts in order, and the number of words by text."""
    hashes, counts, _ = place_words(coded, words)
    return hashes, counts


def place_words(coded: list[bytes], words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``hash_words``, and where in the texts, joined by one byte, every word starts."""
    data = np.frombuffer(b" ".join(coded), np.uint8)
    lengths = np.fromiter((len(c) for c in coded), np.int64, len(coded))
    begins = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
    places, hashes, at = [], [], 0
    while at < len(data):
        end = min(at + PIECE_BYTES, len(data))
        while end < len(data):  # to the next byte that ends a word
            stop = np.flatnonzero(words[data[end : end + 4096]] == 0)
            if len(stop):
                end += int(stop[0])
                break
            end = min(end + 4096, len(data))
        starts, found = _piece(data[at:end], words)
        places.append(starts + at)
        hashes.append(found)
        at = end
    if not places:
        return np.zeros(0, U64), np.zeros(len(coded), np.int64), np.zeros(0, np.int64)
    place = np.concatenate(places)
    counts = np.diff(np.append(np.searchsorted(place, begins), len(place)))
    return np.concatenate(hashes), counts, place


def fold(parts: list[np.ndarray]) -> np.ndarray:
    """One hash of several, in order."""
    total = parts[0]
    for part in parts[1:]:
        total = total * _FOLD + part
    return mix64(total)


def shingles(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of all runs of ``size`` words.

    A text of fewer words, but not none, is one shingle.
    """
    text = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    runs = max(0, len(hashes) - size + 1)
    whole = np.flatnonzero(text[:runs] == text[len(text) - runs :]) if runs else np.zeros(0, np.int64)
    found = [fold([hashes[whole + j] for j in range(size)])] if len(whole) else [np.zeros(0, U64)]
    owner = [text[whole]]
    for few in range(1, size):
        short = np.flatnonzero(counts == few)
        if len(short):
            first = ends[short] - few
            found.append(fold([hashes[first + j] for j in range(few)]) + U64(few))
            owner.append(short)
    return np.concatenate(found), np.concatenate(owner)


def weighted(found: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles by text, with their counts, in the order of the texts."""
    _, first, counts = np.unique(
        found + mix64(owner.astype(U64) + U64(1)), return_index=True, return_counts=True
    )
    order = np.argsort(owner[first], kind="stable")
    first, counts = first[order], counts[order]
    return found[first], owner[first], counts
