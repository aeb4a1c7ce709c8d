"""Text transducers that remember where every output character came from.

A rewriting is a text and the list of its edits: an edit says which stretch of
the new text stands for which stretch of the text before. Between edits
characters are copied, so only edits take memory beside the text. Rewritings are
chained, and a span of the last text is carried back through all of them.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable


class Rewriting:
    """``text`` after edits of ``before`` (a text, or the rewriting that made it)."""

    def __init__(self, before: str | Rewriting, edits: Iterable[tuple[int, int, str]] = ()):
        """``edits`` are (start, end, new text) in ascending order without overlap."""
        source = before if isinstance(before, str) else before.text
        self._before = None if isinstance(before, str) else before
        self._from: list[int] = []
        self._to: list[int] = []
        self._start: list[int] = []
        self._end: list[int] = []
        parts, done, length = [], 0, 0
        for start, end, new in edits:
            parts += (source[done:start], new)
            length += start - done
            self._from.append(length)
            length += len(new)
            self._to.append(length)
            self._start.append(start)
            self._end.append(end)
            done = end
        self.text = "".join([*parts, source[done:]]) if parts else source

    def span(self, start: int, end: int) -> tuple[int, int]:
        """Where the characters from ``start`` to before ``end`` stand in the first text.

        A character that an edit made stands for all that the edit replaced.
        """
        if self._from:
            # The edit that the first character is in, else the shift after the last edit before it.
            at = bisect_right(self._to, start)
            inside = at < len(self._from) and self._from[at] <= start
            first = self._start[at] if inside else start + self._shift(at)
            at = bisect_left(self._to, end)
            inside = at < len(self._from) and self._from[at] < end
            last = self._end[at] if inside else end + self._shift(bisect_right(self._from, end - 1))
            start, end = first, last
        return self._before.span(start, end) if self._before else (start, end)

    def _shift(self, edits: int) -> int:
        """How much further on a copied character after so many edits stood before them."""
        return self._end[edits - 1] - self._to[edits - 1] if edits else 0


def rewrite(before: str | Rewriting, pattern: re.Pattern, new: Callable[[re.Match], str | None]) -> Rewriting:
    """Replace every match for which ``new`` gives a text; None leaves it."""
    source = before if isinstance(before, str) else before.text
    found = ((m.start(), m.end(), new(m)) for m in pattern.finditer(source))
    return Rewriting(before, [edit for edit in found if edit[2] is not None])
