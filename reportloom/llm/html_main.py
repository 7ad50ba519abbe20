"""Main text of web pages: flat text blocks, neighbour features, a decision tree trained on a small labelled table."""

from __future__ import annotations

import html
import re
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Features of a block: words and link density of itself and its neighbours, what the elements around it mean (article; menu,
#: footer, form, ...), and of the nearest container whose class or id holds a word of ``_BOILER_WORDS``: words of text
#: outside it, blocks inside it. Such a name is a hint and decides nothing alone: a wrapper named after what the page also
#: has (``has-sidebar``) leaves no text outside.
FEATURES = (
    "words", "links", "words_before", "links_before", "words_after", "links_after", "in_article", "in_boilerplate", "heading", "text_outside", "blocks_inside"
)
#: Largest values of the last two; a block without named container has no text outside and the most blocks inside.
MOST_OUTSIDE, MOST_INSIDE = 99, 9
#: A block outside articles counts as text beside a named container from so many words and below this link density.
PLAIN_WORDS, PLAIN_LINKS = 12, 0.34
#: The labelled blocks; its size is part of this package.
TABLE = Path(__file__).with_name("labelled_blocks.tsv")

# Fixed values of HTML: elements whose contents are not text, elements inside a line, containers.
_RAW = "script|style|noscript|template|textarea|select|option|svg|math|iframe|object|title|canvas|audio|video|head"
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark meter nobr q s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
_CONTAINERS = frozenset("div section nav header footer aside form article main ul ol dl table tr td th body figure dialog menu fieldset details center p".split())
_BOILER_TAGS = frozenset("nav footer aside form menu dialog fieldset button".split())
_BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu".split())
_BOILER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation "
    "breadcrumb breadcrumbs header masthead footer sidebar aside widget comment comments disqus reply replies respond "
    "cookie cookies consent gdpr notice notices alert newsletter subscribe subscription signup login modal popup overlay "
    "related recommended share sharing social pagination pager tags hidden copyright legal disclaimer form".split()
)
_MAIN_WORDS = frozenset("article post entry story content main".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    rf"|<(?P<raw>{_RAW})(?=[\s/>])[^>]*?(?:/>|>.*?(?:</(?P=raw)\s*>|\Z))"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*(?:>|\Z))",
    re.I | re.S,
)
_ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_PARTS = re.compile(r"[a-z]+|[0-9]+")
_HEAD = re.compile(r"<head(?=[\s>]).*?(?:</head\s*>|(?=<body)|\Z)", re.I | re.S)


def _kind(name: str, attrs: str) -> tuple[int, bool]:
    """What a container means (1 article, -1 boilerplate, -2 a header, 0 nothing), and whether its class or id hints at boilerplate."""
    if name in _BOILER_TAGS:
        return -1, False
    said, hint = 1 if name in ("article", "main") else -2 if name == "header" else 0, False
    if len(attrs) > 4:
        for key, value in _ATTR.findall(attrs):
            key, value = key.lower(), value.strip("\"'").lower()
            if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "role" and value in _BOILER_ROLES):
                return -1, False
            if key == "role" and value in ("main", "article"):
                said = 1
            elif key in ("class", "id") and name != "header":  # the names of a header repeat what the element says
                seen = set(_PARTS.findall(value))
                hint = hint or not seen.isdisjoint(_BOILER_WORDS)
                if said == 0 and not seen.isdisjoint(_MAIN_WORDS):
                    said = 1
    if hint and said == 1 and name not in ("article", "main"):
        said = 0
    return said, hint


class Block(NamedTuple):
    """The text between two tags that break a line, and where it stands."""

    text: str
    words: int
    linked: int  # words inside links
    article: bool
    boilerplate: bool
    heading: bool
    named: int  # number of the nearest named container, 0 without one
    marked: bool  # in an article element that is nearer than any named container


def text_blocks(page: str) -> tuple[list[Block], list[int]]:
    """The blocks of a page in page order, and for each named container the next one around it (number 0 stands for the page).

    Character references are decoded and white space inside a block is one space.
    """
    page = _HEAD.sub(" ", page, count=1)
    out: list[Block] = []
    around = [0]
    stack: list[tuple[str, int, int, int]] = []  # open containers: element, meaning, nearest named container before it and its articles
    article = boiler = page_header = link = named = outer = 0
    heading = False
    words: list[str] = []  # pieces of the open block
    linked: list[str] = []

    def close():
        nonlocal words, linked
        if words:
            text = " ".join(html.unescape("".join(words)).split())
            if text:
                inside = len(html.unescape(" ".join(linked)).split()) if linked else 0
                out.append(Block(text, len(text.split()), inside, article > 0, boiler > 0 or (page_header > 0 and article == 0), heading, named, article > outer))
        words, linked = [], []

    def leave(k):
        nonlocal article, boiler, page_header, named, outer
        for _, said, *_ in stack[k:]:
            article, boiler, page_header = article - (said == 1), boiler - (said == -1), page_header - (said == -2)
        named, outer = stack[k][2:]
        del stack[k:]

    at = 0
    for m in _TAG.finditer(page):
        if m.start() > at:
            piece = page[at : m.start()]
            words.append(piece)
            if link:
                linked.append(piece)
        at = m.end()
        name = m["name"]
        if name is None:
            if m["raw"] is not None and m["raw"].lower() not in ("script", "style", "svg", "math"):
                words.append(" ")
            continue
        name = name.lower()
        if name == "a":
            link = 0 if m["end"] else 1
            continue
        if name in _INLINE:
            if name == "br":
                words.append(" ")
            continue
        close()
        link = 0
        if len(name) == 2 and name[0] == "h" and name[1] in "123456":
            heading = not m["end"]
        if name not in _CONTAINERS and name not in _BOILER_TAGS:
            continue
        if m["end"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    leave(k)
                    break
        else:
            if name == "p" and stack and stack[-1][0] == "p":  # an open paragraph ends at the next
                leave(len(stack) - 1)
            said, hint = _kind(name, m["attrs"] or "")
            stack.append((name, said, named, outer))
            article, boiler, page_header = article + (said == 1), boiler + (said == -1), page_header + (said == -2)
            if hint:
                around.append(named)
                named, outer = len(around) - 1, article
    words.append(page[at:])
    close()
    return out, around


def features(blocks: list[Block], around: list[int]) -> np.ndarray:
    """One row of ``FEATURES`` per block; beyond the ends of a page there are no words."""
    n = len(blocks)
    words = np.array([b.words for b in blocks], float)
    links = np.minimum(np.array([b.linked / max(1, b.words) for b in blocks]), 1)
    article, boiler, heading, marked = (np.array([b[k] for b in blocks], bool) for k in (3, 4, 5, 7))
    named = np.array([b.named for b in blocks], np.int64)
    first = np.array(around)[named] == 0  # no named container around the nearest one
    plain = ~boiler & ~heading & (links < PLAIN_LINKS) & (marked | (article & first) | ((named == 0) & (words >= PLAIN_WORDS)))
    text = np.bincount(named, weights=words * plain, minlength=len(around))
    inside = np.bincount(named, minlength=len(around)).astype(float)
    for k in range(len(around) - 1, 0, -1):  # a container stands after the one around it
        text[around[k]] += text[k]
        inside[around[k]] += inside[k]
    outside = np.where(named > 0, text[0] - text[named], 0)
    pad = lambda v, k: np.concatenate(([0.0], v, [0.0]))[k : k + n]
    return np.column_stack(
        (words, links, pad(words, 0), pad(links, 0), pad(words, 2), pad(links, 2), article, boiler, heading, np.minimum(outside, MOST_OUTSIDE), np.where(named > 0, np.minimum(inside[named], MOST_INSIDE), MOST_INSIDE))
    )


def read_table(path: Path = TABLE) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels (1 main text, 0 not) of the labelled blocks."""
    rows = [x.split("\t") for x in path.read_text().splitlines()[1:] if x and not x.startswith("#")]
    values = np.array([[float(v) for v in r[: len(FEATURES) + 1]] for r in rows])
    return values[:, :-1], values[:, -1].astype(int)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 12, least: int = 1):
    """A binary tree of Gini splits: (feature, threshold, left, right), or the share of ones at a leaf."""
    share = float(y.mean()) if len(y) else 0.0
    if depth == 0 or share in (0.0, 1.0) or len(y) < 2 * least:
        return share
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            left = x[:, f] <= cut
            a, b = left.sum(), (~left).sum()
            if a < least or b < least:
                continue
            p, q = y[left].mean(), y[~left].mean()
            cost = a * p * (1 - p) + b * q * (1 - q)
            if best is None or cost < best[0] - 1e-12:
                best = (cost, f, float(cut), left)
    if best is None:
        return share
    _, f, cut, left = best
    return f, cut, grow(x[left], y[left], depth - 1, least), grow(x[~left], y[~left], depth - 1, least)


def decide(tree, x: np.ndarray) -> np.ndarray:
    """Share of ones at the leaf of each row."""
    if isinstance(tree, float):
        return np.full(len(x), tree)
    f, cut, low, high = tree
    left = x[:, f] <= cut
    out = np.empty(len(x))
    out[left], out[~left] = decide(low, x[left]), decide(high, x[~left])
    return out


def extract(pages: DataFrame, table: Path = TABLE, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    The text is the page's blocks that the tree takes for main text, joined by one line feed in page order. Null, empty or
    broken html gives what text it has, possibly none. Repeated rows give repeated results; other columns are not read; an
    empty table gives an empty result. A projection: a page is read whole in its task, nothing is shuffled.
    """
    tree = grow(*read_table(table))
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part, texts = batch.slice(k, 500), []
                for page in part.column(2).to_pylist():
                    blocks, around = text_blocks(page or "")
                    kept = decide(tree, features(blocks, around)) >= 0.5 if blocks else []
                    texts.append("\n".join(b.text for b, keep in zip(blocks, kept) if keep))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [id_col, url_col, "text", "n_chars"]
                )

    return pages.select(id_col, url_col, html_col).mapInArrow(run, f"{id_col} {kinds[0]}, {url_col} {kinds[1]}, text string, n_chars bigint")
