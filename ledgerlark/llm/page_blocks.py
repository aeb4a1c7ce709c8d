"""Leaf blocks of an HTML page: runs of text between block-level tags."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

# Fixed values of HTML: elements without an end tag, elements inside a line of
# text, elements whose content is no markup, and elements that a start tag of
# the same group closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
RAW = "script|style|title|textarea|xmp|iframe|noembed|noframes"
SIBLINGS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
SCOPES = frozenset("ul ol dl table select tbody thead tfoot".split())
# Fixed values of HTML: elements that lay out a page. Others are not remembered once another one opens inside.
LAYOUT = frozenset(
    "address article aside blockquote body button canvas caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup html label legend li main menu nav object ol optgroup option "
    "p picture pre search section select summary table tbody td tfoot th thead tr ul video".split()
)
STRUCTURE = frozenset("article main nav header footer aside".split())
# Words of class attributes are remembered for so many open elements that have some, from the innermost; words
# that a caller asks for are remembered always.
NAMED = 16

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{RAW})\b[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<[!?][^>]*+>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)>"
    r"|(?P<text>[^<]++|<)",
    re.S | re.I,
)
_TAIL = re.compile(r"(?P<text>.+)(?P<tag>(?!))?(?P<tag2>(?!))?", re.S)
_NAMES = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_MARK = re.compile(r"\bdata-main=\"?([01])")
_SPLIT = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


class Block(NamedTuple):
    text: str
    tag: str  # of the innermost open element
    plain_tag: str  # of the innermost one that is no page structure
    inside: frozenset[str]  # layout tags of all open elements
    names: frozenset[str]  # words of their class, id, role and itemprop attributes
    linked: int  # characters inside links
    mark: int | None  # of the nearest element with a data-main attribute


class _Open(NamedTuple):
    tag: str
    plain_tag: str
    inside: frozenset[str]
    known: frozenset[str]  # words asked for
    near: tuple[frozenset[str], ...]  # words of the innermost elements that have some
    mark: int | None


_NOTHING = _Open("", "", frozenset(), frozenset(), (), None)


class _Stack:
    """Open elements, and how many of each tag are open, in all and since the last list or table began.

    What an end tag or a sibling looks for is known to be open before the stack is searched for it,
    and what the search passes is closed; so a page takes time linear in its tags.
    """

    def __init__(self) -> None:
        self.items: list[_Open] = []
        self._open: Counter[str] = Counter()
        self._scopes: list[Counter[str]] = [Counter()]

    def top(self) -> _Open:
        return self.items[-1] if self.items else _NOTHING

    def push(self, item: _Open) -> None:
        self.items.append(item)
        self._open[item.tag] += 1
        self._scopes[-1][item.tag] += 1
        if item.tag in SCOPES:
            self._scopes.append(Counter())

    def pop(self) -> str:
        tag = self.items.pop().tag
        if tag in SCOPES:
            self._scopes.pop()
        self._open[tag] -= 1
        self._scopes[-1][tag] -= 1
        return tag

    def close(self, tag: str) -> None:
        """Close the innermost element of a tag and all in it; nothing, if none is open."""
        if self._open[tag] > 0:
            while self.pop() != tag:
                pass

    def close_sibling(self, tags: set[str]) -> None:
        """Close the innermost element of one of the tags that the current list or table holds."""
        if any(self._scopes[-1][tag] > 0 for tag in tags):
            while self.pop() not in tags:
                pass


def _names(attributes: str) -> frozenset[str]:
    found: set[str] = set()
    for groups in _NAMES.findall(attributes):
        found.update(_SPLIT.split(_CAMEL.sub(" ", "".join(groups)).lower()))
    found.discard("")
    return frozenset(found)


def _tokens(page: str) -> Iterator[re.Match]:
    """Tags and texts. After the last end of a tag there can only be text or an open comment, so nothing
    there is read as a tag and given up at the end of the page again and again."""
    end = page.rfind(">") + 1
    comment = page.find("<!--", end)
    yield from _TOKEN.finditer(page, 0, end)
    yield from _TAIL.finditer(page, end, len(page) if comment < 0 else comment)


def leaf_blocks(page: str, known: frozenset[str] = frozenset()) -> list[Block]:
    """The blocks of a page in order, without scripts, styles, comments and titles.

    White space in a block is one space; character references are decoded.
    A break inside a line is a space. End tags without a start are ignored; a
    start tag closes what it cannot stand in. ``known`` are class words that are
    remembered at any depth.
    """
    blocks: list[Block] = []
    stack = _Stack()
    pieces: list[str] = []
    linked = 0
    link_depth = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                top = stack.top()
                names = top.known.union(*top.near)
                blocks.append(Block(text, top.tag, top.plain_tag, top.inside, names, min(linked, len(text)), top.mark))
            pieces.clear()
        linked = 0

    for token in _tokens(page):
        text = token["text"]
        if text is not None:
            pieces.append(text)
            if link_depth:
                linked += len(text)
            continue
        name = token["tag"] or token["tag2"]
        if not name:
            continue
        tag = name.lower()
        closing = token["end"] or token["end2"]
        attributes = token["rest"] or token["rest2"] or ""
        if tag in INLINE:
            if tag == "a":
                link_depth = max(0, link_depth + (-1 if closing else 1))
            elif tag == "br":
                pieces.append(" ")
            continue
        flush()
        link_depth = 0
        if closing:
            stack.close(tag)
            continue
        if stack.top().tag == "p":
            stack.pop()
        if tag in SIBLINGS:
            stack.close_sibling(SIBLINGS[tag])
        if tag in VOID:
            continue
        above = stack.top()
        own = _names(attributes) if attributes else frozenset()
        mark = _MARK.search(attributes) if "data-main" in attributes else None
        stack.push(
            _Open(
                tag,
                above.plain_tag if tag in STRUCTURE else tag,
                above.inside | {tag} if tag in LAYOUT and tag not in above.inside else above.inside,
                above.known | (own & known) if own & known else above.known,
                (own, *above.near)[:NAMED] if own else above.near,
                int(mark[1]) if mark else above.mark,
            )
        )
    flush()
    return blocks
