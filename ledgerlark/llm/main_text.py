"""Main text of web pages by a linear-chain conditional random field.

A page is a chain of leaf blocks; each is main text or not. Features are the
tags and the class words of all open elements, and the look of the text:
length, share of links, punctuation. The field is trained on labelled pages and
decoded by Viterbi. Labelled are pages of the input that say themselves where
their article is (one ``article`` or ``main`` element), and layouts that are
built here with marked parts. Both are also shown with all page-structure tags
hidden, so that the look of the text and the class words carry weight of their
own.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.labelled import sample
from ledgerlark.llm.page_blocks import STRUCTURE, Block, leaf_blocks

# Bounds of the training sample: pages, and characters of a page.
MOST_PAGES = 300
MOST_CHARS = 60_000
LAYOUTS = 240

# Class words that speak for and against main text.
FOR = frozenset("article body content entry main post prose story text".split())
AGAINST = frozenset(
    "ad ads advert advertisement adsbygoogle alert author banner bar bio breadcrumb breadcrumbs byline caption comment "
    "comments consent contact contentinfo cookie cookies copyright credits disclaimer discussion disqus dropdown foot "
    "footer form gdpr head header legal links login masthead menu meta modal nav navbar navigation newsletter notice "
    "notification pagination popup privacy promo promoted reader recommended related replies reply respond search share "
    "sharing shop side sidebar signup site skip social sponsor sponsored subscribe subscription tag tags teaser toc "
    "toolbar top trending warning widget".split()
)


KNOWN = FOR | AGAINST


def block_features(blocks: list[Block], hide_structure: bool = False) -> list[list[str]]:
    """The names of the features that hold for each block."""
    found = []
    for at, block in enumerate(blocks):
        inside = block.inside - STRUCTURE if hide_structure else block.inside
        text = block.text
        words = text.count(" ") + 1
        share = block.linked / len(text)
        row = ["bias", f"tag:{block.plain_tag if hide_structure else block.tag}"]
        row += [f"in:{t}" for t in sorted(inside)]
        row += [f"name:{n}" for n in sorted(block.names)]
        row += ["names for"] * bool(block.names & FOR) + ["names against"] * bool(block.names & AGAINST)
        row.append(f"words:{min(words.bit_length(), 7)}")
        row.append(f"linked:{0 if share == 0 else 1 if share < 0.3 else 2 if share < 0.9 else 3}")
        row.append("ends" if text[-1] in ".!?:;\"'”»…" else "open end")
        row += ["sentences"] * (text.count(". ") > 1) + ["commas"] * (text.count(", ") > 1)
        row += ["copyright"] * ("©" in text or "(c)" in text.lower())
        row += ["first"] * (at == 0) + ["last"] * (at == len(blocks) - 1)
        found.append(row)
    return found


class Field:
    """Weights of a binary chain: features for the label 1, start and steps for both."""

    def __init__(self, pages: list[tuple[list[list[str]], list[int]]], steps: int = 120, rate: float = 0.1):
        names = sorted({f for rows, _ in pages for row in rows for f in row})
        self.index = {name: i for i, name in enumerate(names)}
        self.weights = np.zeros(len(names))
        self.start, self.step = np.zeros(2), np.zeros((2, 2))
        pages = [page for page in pages if page[1]]
        if pages:
            self._train(pages, steps, rate)

    def _train(self, pages, steps: int, rate: float) -> None:
        lengths = np.array([len(y) for _, y in pages])
        longest, count = lengths.max(), len(pages)
        label = np.zeros((count, longest), int)
        inside = np.arange(longest) < lengths[:, None]
        cell, feature = [], []
        for p, (rows, y) in enumerate(pages):
            label[p, : len(y)] = y
            for t, row in enumerate(rows):
                cell += [p * longest + t] * len(row)
                feature += [self.index[f] for f in row]
        cell, feature = np.array(cell), np.array(feature)
        flat = np.concatenate([self.weights, self.start, self.step.ravel()])
        mean, square = np.zeros_like(flat), np.zeros_like(flat)
        n = len(self.weights)
        for turn in range(1, steps + 1):
            self.weights, self.start, self.step = flat[:n], flat[n : n + 2], flat[n + 2 :].reshape(2, 2)
            emit = np.zeros((count, longest, 2))
            emit[:, :, 1] = np.bincount(cell, self.weights[feature], count * longest).reshape(count, longest)
            ahead, back = np.zeros_like(emit), np.zeros_like(emit)
            ahead[:, 0] = emit[:, 0] + self.start
            for t in range(1, longest):
                ahead[:, t] = emit[:, t] + np.logaddexp(*[ahead[:, t - 1, k, None] + self.step[k] for k in (0, 1)])
            for t in range(longest - 2, -1, -1):
                later = emit[:, t + 1] + back[:, t + 1]
                found = np.logaddexp(*[self.step[:, k] + later[:, k, None] for k in (0, 1)])
                back[:, t] = np.where(inside[:, t + 1, None], found, 0)
            total = np.logaddexp(*np.moveaxis((ahead + back)[:, 0], 1, 0))
            marginal = np.exp(ahead + back - total[:, None, None])
            miss = np.where(inside, marginal[:, :, 1] - label, 0).ravel()
            pair = np.exp(
                ahead[:, :-1, :, None] + self.step + (emit + back)[:, 1:, None, :] - total[:, None, None, None]
            ) * inside[:, 1:, None, None]
            steps_seen = np.zeros((2, 2))
            np.add.at(steps_seen, (label[:, :-1][inside[:, 1:]], label[:, 1:][inside[:, 1:]]), 1)
            gradient = np.concatenate(
                [
                    np.bincount(feature, miss[cell], n),
                    marginal[:, 0].sum(axis=0) - np.bincount(label[:, 0], minlength=2),
                    (pair.sum(axis=(0, 1)) - steps_seen).ravel(),
                ]
            ) / count + 1e-3 * flat
            mean = 0.9 * mean + 0.1 * gradient
            square = 0.99 * square + 0.01 * gradient**2
            flat = flat - rate * mean / (1 - 0.9**turn) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-8)
        self.weights, self.start, self.step = flat[:n], flat[n : n + 2], flat[n + 2 :].reshape(2, 2)

    def decode(self, rows: list[list[str]]) -> list[int]:
        """The likeliest labels of a chain; of two equal ways that with label 0."""
        if not rows:
            return []
        index, weights = self.index, self.weights
        (stay0, rise), (fall, stay1) = self.step.tolist()
        best0, best1 = self.start.tolist()
        ways = []
        for t, row in enumerate(rows):
            emit = sum(weights[index[f]] for f in row if f in index)
            if t:
                way = (best1 + fall > best0 + stay0, best1 + stay1 > best0 + rise)
                best0, best1 = max(best0 + stay0, best1 + fall), max(best0 + rise, best1 + stay1)
                ways.append(way)
            best1 += emit
        label = int(best1 > best0)
        labels = [label]
        for way in reversed(ways):
            label = int(way[label])
            labels.append(label)
        return labels[::-1]


_WORDS = (
    "river stone early garden market window answer quiet number people morning reason under between carry letter "
    "winter follow paper simple change water story travel house light remember small father moment"
).split()


def layouts(count: int = LAYOUTS, seed: int = 7) -> Iterator[str]:
    """Pages in common layouts; parts of main text carry data-main="1", others "0"."""
    draw = random.Random(seed)

    def words(low: int, high: int) -> str:
        return " ".join(draw.choice(_WORDS) for _ in range(draw.randint(low, high)))

    def sentence() -> str:
        text = words(4, 18).capitalize()
        return text.replace(" ", ", ", 1) + "." if draw.random() < 0.3 else text + "."

    def paragraph() -> str:
        return f"<p>{' '.join(sentence() for _ in range(draw.choice((1, 1, 2, 3, 5))))}</p>"

    def links(n: int) -> str:
        return "".join(f'<li><a href="/{i}">{words(1, 3).capitalize()}</a></li>' for i in range(n))

    def box(name: str, inner: str, *openings: str) -> str:
        opening = draw.choice(openings)
        tag = opening.split()[0]
        return f'<{opening} data-main="0">{inner}</{tag}>'

    def menu() -> str:
        return box("menu", f"<ul>{links(draw.randint(3, 8))}</ul>", "nav", 'div class="menu"', 'div id="navbar"', 'ul class="nav"')

    def advert() -> str:
        inner = draw.choice((sentence(), paragraph(), f'<a href="/x">{sentence()}</a>', f"{sentence()} {sentence()}"))
        return box("advert", inner, 'div class="ad"', 'div class="advert"', 'aside class="sponsored"', 'div class="promo"', 'div id="ad-top"', 'section class="advertisement"')

    def notice() -> str:
        inner = draw.choice((paragraph(), sentence())) + draw.choice(("", f"<button>{words(1, 2)}</button>"))
        return box("notice", inner, 'div class="cookie-notice"', 'div id="consent"', 'div class="notice" role="alert"', 'div class="gdpr-banner"', 'section class="notice"')

    def header() -> str:
        inner = f"<h1>{words(1, 3).title()}</h1>" * draw.randint(0, 1) + draw.choice((f"<p>{words(2, 6)}</p>", menu(), f"<div>{words(1, 3)}</div>"))
        return box("header", inner, "header", 'div class="site-header"', 'div id="header"', 'div class="masthead"')

    def side() -> str:
        inner = draw.choice((f"<h3>{words(1, 3)}</h3><ul>{links(4)}</ul>", paragraph(), f"<h2>{words(2, 3)}</h2>{paragraph()}"))
        return box("side", inner, "aside", 'div class="sidebar"', 'div id="side"', 'div class="widget"', 'section class="related"', 'aside class="sidebar"')

    def form() -> str:
        inner = f"<label>{words(1, 3)}</label><input><p>{sentence()}</p><button>{words(1, 1)}</button>"
        return box("form", inner, "form", 'form class="newsletter"', 'div class="subscribe"', 'form id="login"')

    def remarks() -> str:
        each = "".join(
            draw.choice((f'<div class="comment"><b>{words(1, 2)}</b>{paragraph()}</div>', f"<li>{paragraph()}</li>", paragraph()))
            for _ in range(draw.randint(1, 5))
        )
        return box("remarks", f"<h2>{words(1, 2)}</h2>" * draw.randint(0, 1) + each, 'section class="comments"', 'div id="comments"', 'div class="discussion"', 'ol class="comment-list"', 'div class="reader-comments"')

    def footer() -> str:
        inner = draw.choice((f"&copy; 2020 {words(1, 3)}", f"<p>&copy; {sentence()}</p>", f"<ul>{links(4)}</ul>", f"<p>{sentence()}</p>"))
        return box("footer", inner, "footer", 'div class="footer"', 'div id="footer"', 'div class="copyright"')

    for _ in range(count):
        opening = draw.choice(
            ("article", "main", "article class=\"post\"", 'div class="content"', 'div id="main"', 'div class="post-body"',
             'section class="story"', 'div class="entry-content"', "div", 'div class="article-text"')
        )
        inner = f"<h1>{words(2, 8).capitalize()}</h1>" * (draw.random() < 0.8)
        for _ in range(draw.choice((1, 2, 3, 5, 8, 14))):
            kind = draw.random()
            inner += (
                paragraph() if kind < 0.72
                else f"<h2>{words(1, 6).capitalize()}</h2>" if kind < 0.8
                else f"<blockquote>{paragraph()}</blockquote>" if kind < 0.84
                else f"<ul><li>{sentence()}</li><li>{words(1, 5)}</li></ul>" if kind < 0.89
                else f"<table><tr><td>{words(1, 3)}</td><td>{words(1, 2)}</td></tr></table>" if kind < 0.91
                else draw.choice((advert, advert, side, form, notice))()
            )
        main = f'<{opening} data-main="1">{inner}</{opening.split()[0]}>'
        top = [part() for part in (notice, header, menu, advert, side) if draw.random() < 0.5]
        bottom = [part() for part in (remarks, side, form, advert, notice, footer) if draw.random() < 0.5]
        draw.shuffle(top)
        page = "".join(top) + main + "".join(bottom)
        if draw.random() < 0.3:
            page = f'<div class="wrapper">{page}</div>'
        yield f"<!DOCTYPE html><html><head><title>{words(1, 5)}</title></head><body>{page}</body></html>"


def own_labels(blocks: list[Block]) -> list[int] | None:
    """Labels of a page that marks its article itself; otherwise None."""
    inside = [{"article", "main"} & b.inside for b in blocks]
    if not any(inside):
        return None
    out = {"nav", "aside", "footer", "form", "header"}
    return [int(bool(i) and not out & b.inside and not b.names & AGAINST) for i, b in zip(inside, blocks, strict=True)]


def train(pages: DataFrame, html: str = "html", page_id: str = "page_id", most_pages: int = MOST_PAGES) -> Field:
    """Fit on about ``most_pages`` pages of up to 60,000 characters that mark
    their article, chosen by a hash of id and text, and on the layouts built here.

    A page counts whole, with all that comes before and after its article; a page that the
    table holds several times counts once. Null pages are not chosen; without any page that marks
    its article the layouts are all there is.
    """
    fits = pages.select(F.col(page_id).alias("id"), F.col(html).alias("html")).filter(F.length("html") <= MOST_CHARS)
    marked = fits.filter(F.col("html").rlike("(?i)<(article|main)[ >]"))
    labelled = []
    for row in sample(marked, most_pages, F.col("id"), F.col("html")).collect():
        blocks = leaf_blocks(row["html"], KNOWN)
        labels = own_labels(blocks)
        if labels:
            labelled.append((blocks, labels))
    for page in layouts():
        blocks = leaf_blocks(page, KNOWN)
        labelled.append((blocks, [b.mark or 0 for b in blocks]))
    return Field([(block_features(b, hide), y) for b, y in labelled for hide in (False, True)])


def extract(pages: DataFrame, field: Field, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page.

    Main blocks in page order, joined by one space; a page without any, a null
    or an empty page has the empty text. Null ids and urls stay; repeated pages
    have equal rows; an empty table gives no rows. Other columns are not read.
    """
    kinds = [pages.schema[c].dataType.simpleString() for c in (page_id, url)]
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for page in batch["html"]:
                blocks = leaf_blocks(page, KNOWN) if page else []
                labels = field.decode(block_features(blocks))
                texts.append(" ".join(b.text for b, label in zip(blocks, labels, strict=True) if label))
            yield batch[["page_id", "url"]].assign(text=texts, n_chars=[len(t) for t in texts])

    return rows.mapInPandas(read, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint")
