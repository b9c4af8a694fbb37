"""Main text of web pages: flat text blocks, judged by a decision tree on their words, links, places and neighbours."""

from __future__ import annotations

import html as entities
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from feedloom.llm.common import mapped, strings

# Element names of the markup language, and words of class and id names.
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
PLACES = set("article aside blockquote body details dialog div fieldset figure footer form header li main menu nav ol section table td ul p span".split())
AROUND = {"aside", "dialog", "fieldset", "footer", "form", "menu", "nav"}
RAW = set("script style textarea title noscript template svg math select button iframe object canvas audio video option".split())
TO_THE_END = {"script", "style"}
SITE_WORDS = set(
    "ad ads advert adverts advertisement advertisements advertising adsbygoogle sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup comment "
    "comments reply replies respond disqus discussion sidebar related recommended recommendations share sharing social menu "
    "nav navbar navigation breadcrumb breadcrumbs pagination pager footer masthead widget toolbar login search copyright "
    "legal disclaimer byline".split()
)
TEXT_WORDS = set("article post story entry content".split())
# Site words that name a topic just as well, and words at the start or end of a name that tells a state.
TOPICS = set("social legal share sharing search notice notices login sponsor promotion discussion copyright alert consent".split())
STATES = set("no not has with without enabled disabled".split())

_TOKEN = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>""",
    re.S,
)
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_WORDS = re.compile(r"[a-z]+")


def named(attributes: str) -> tuple[bool, bool, bool]:
    """Whether class, id and role name a site element, a text element, a header.

    A whole name such as `sidebar`, or a compound with such a word, is a site element. A compound that tells a state
    (`no-sidebar`, `share-enabled`) says nothing, and words that are topics as well (`legal-news`) do not count where
    the element is named as a text, too.
    """
    parts = [_WORDS.findall(t) for value in _NAMES.findall(attributes) for t in value.lower().split()]
    parts = [t for t in parts if t and t[0] not in STATES and t[-1] not in STATES]
    sure = any(len(t) == 1 and t[0] in SITE_WORDS or t[-1] in SITE_WORDS or not TOPICS.issuperset(SITE_WORDS.intersection(t)) for t in parts)
    topic = any(TOPICS.intersection(t) for t in parts)
    text = any(t[-1] in TEXT_WORDS for t in parts)
    return sure or (topic and not text), any(TEXT_WORDS.intersection(t) for t in parts), any("header" in t for t in parts)


class Block:
    """Text between two block tags: its words, those inside links, and where it stands."""

    __slots__ = ("text", "words", "linked", "site", "inside", "heading")

    def __init__(self, text, words, linked, site, inside, heading):
        self.text, self.words, self.linked, self.site, self.inside, self.heading = text, words, linked, site, inside, heading


def blocks(page: str) -> list[Block]:
    """All text blocks in page order. Unclosed elements end with the page or where an outer one ends."""
    out: list[Block] = []
    stack: list[tuple[str, int, int, int]] = []  # name, site, header, inside
    text: list[str] = []
    linked: list[str] = []
    link, heading = False, False

    def flush() -> None:
        nonlocal text, linked
        whole = " ".join(entities.unescape("".join(text)).split())
        if whole:
            inner = len(entities.unescape(" ".join(linked)).split())
            site = sum(x[1] for x in stack)
            header = sum(x[2] for x in stack)
            inside = sum(x[3] for x in stack)
            site += bool(header and not (inside and heading))
            n = len(whole.split())
            out.append(Block(whole, n, min(inner, n), site > 0, inside > 0, heading))
        text, linked = [], []

    at = 0
    while at < len(page):
        tag = _TOKEN.search(page, at)
        end = tag.start() if tag else len(page)
        if end > at:
            text.append(page[at:end])
            if link:
                linked.append(page[at:end])
        if not tag:
            break
        at = tag.end()
        closing, name, rest = (tag[1], tag[2], tag[3]) if tag[2] else (tag[4], tag[5], tag[6])
        if not name:
            continue
        name = name.lower()
        if name in RAW:
            if not closing and not (rest or "").endswith("/"):
                close = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at)
                if close:
                    at = close.end()
                elif name in TO_THE_END:
                    break
            continue
        if name == "br":
            text.append(" ")
            continue
        if name == "a":
            link = not closing
            continue
        if name in BLOCKS:
            flush()
            link = False
            heading = name in HEADINGS and not closing
        if name in PLACES:
            if closing:
                known = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
                if known is not None:
                    if name == "span" and stack[known][1]:
                        flush()
                    del stack[known:]
            else:
                named_site, named_text, named_header = named(rest or "")
                outer = name in ("html", "body", "main")
                site = int(name in AROUND or (not outer and (named_site or bool(_HIDDEN.search(rest or "")))))
                header = int(name == "header" or (not outer and named_header))
                inside = int(name in ("article", "main") or (not outer and not site and named_text))
                if name == "p":
                    # A paragraph ends the one before it.
                    while stack and stack[-1][0] in ("p", "span"):
                        stack.pop()
                if name not in ("p", "span") or site:
                    if name == "span":
                        flush()
                    stack.append((name, site, header, inside))
    flush()
    return out


# The labelled table: words, share of link words, the same of the block before and after, place (1 inside the
# article, -1 outside it, 0 on a page without one), in a site element or not, and whether it is main text.
LABELLED = np.array(
    [
        (1, 0.0, 0, 0.0, 12, 0.0, 1, 0, 1), (9, 0.0, 0, 0.0, 40, 0.0, 1, 0, 1), (6, 0.0, 3, 1.0, 85, 0.0, 1, 0, 1),
        (60, 0.0, 9, 0.0, 72, 0.0, 1, 0, 1), (140, 0.02, 60, 0.0, 33, 0.0, 1, 0, 1), (3, 0.0, 55, 0.0, 61, 0.0, 1, 0, 1),
        (1, 0.0, 48, 0.0, 2, 0.0, 1, 0, 1), (2, 0.0, 1, 0.0, 90, 0.0, 1, 0, 1), (35, 0.2, 42, 0.0, 12, 0.0, 1, 0, 1),
        (18, 0.4, 66, 0.1, 27, 0.0, 1, 0, 1), (7, 0.3, 33, 0.0, 0, 0.0, 1, 0, 1), (4, 0.0, 70, 0.0, 8, 0.0, 1, 0, 1),
        (12, 0.6, 80, 0.0, 45, 0.1, 1, 0, 1), (5, 0.0, 4, 0.0, 6, 0.0, 1, 0, 1), (400, 0.01, 0, 0.0, 0, 0.0, 1, 0, 1),
        (3, 1.0, 4, 1.0, 3, 1.0, 1, 0, 0), (5, 1.0, 3, 1.0, 0, 0.0, 1, 0, 0), (2, 1.0, 40, 0.0, 2, 1.0, 1, 0, 0),
        (8, 0.0, 40, 0.0, 12, 0.0, 1, 1, 0), (25, 0.1, 60, 0.0, 55, 0.0, 1, 1, 0), (80, 0.0, 44, 0.0, 60, 0.0, 1, 1, 0),
        (1, 0.0, 35, 0.0, 22, 0.0, 1, 1, 0), (150, 0.0, 9, 0.0, 30, 0.0, 1, 1, 0), (3, 1.0, 5, 1.0, 4, 1.0, 1, 1, 0),
        (1, 1.0, 1, 1.0, 1, 1.0, -1, 1, 0), (2, 1.0, 0, 0.0, 2, 1.0, -1, 1, 0), (12, 0.0, 1, 1.0, 9, 0.0, -1, 1, 0),
        (9, 0.0, 70, 0.0, 0, 0.0, -1, 1, 0), (45, 0.0, 12, 0.0, 33, 0.0, -1, 1, 0), (120, 0.05, 20, 0.0, 44, 0.0, -1, 1, 0),
        (6, 0.0, 2, 0.0, 11, 0.0, -1, 0, 0), (30, 0.0, 8, 0.0, 9, 0.0, -1, 0, 0), (90, 0.0, 25, 0.0, 14, 0.0, -1, 0, 0),
        (4, 1.0, 4, 1.0, 9, 0.0, -1, 0, 0), (1, 0.0, 0, 0.0, 1, 0.0, -1, 0, 0), (15, 0.5, 10, 0.3, 60, 0.0, -1, 0, 0),
        (40, 0.0, 35, 0.0, 50, 0.0, 0, 0, 1), (22, 0.0, 6, 0.0, 48, 0.0, 0, 0, 1), (95, 0.05, 22, 0.0, 80, 0.0, 0, 0, 1),
        (16, 0.1, 60, 0.0, 55, 0.0, 0, 0, 1), (8, 0.0, 62, 0.0, 47, 0.0, 0, 0, 1), (5, 0.0, 0, 0.0, 66, 0.0, 0, 0, 1),
        (3, 0.0, 72, 0.0, 39, 0.0, 0, 0, 1), (6, 0.0, 44, 0.0, 58, 0.0, 0, 0, 1), (28, 0.3, 38, 0.0, 41, 0.0, 0, 0, 1),
        (60, 0.0, 50, 0.0, 0, 0.0, 0, 0, 1), (41, 0.05, 70, 0.0, 5, 0.0, 0, 0, 1), (90, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1),
        (33, 0.0, 6, 0.0, 8, 0.0, 0, 0, 1), (26, 0.1, 80, 0.0, 3, 0.5, 0, 0, 1), (150, 0.0, 45, 0.0, 2, 1.0, 0, 0, 1),
        (12, 0.0, 0, 0.0, 30, 0.0, 1, 0, 1), (4, 0.0, 0, 0.0, 3, 0.0, 1, 0, 1), (2, 0.0, 2, 1.0, 7, 0.2, 1, 0, 1),
        (5, 0.0, 6, 0.0, 1, 0.0, 1, 0, 1), (1, 0.0, 1, 0.0, 1, 0.0, 1, 0, 1), (1, 0.0, 1, 0.0, 0, 0.0, 1, 0, 1),
        (30, 0.0, 4, 0.0, 4, 0.0, 0, 0, 1), (48, 0.0, 3, 1.0, 0, 0.0, 0, 0, 1), (75, 0.1, 5, 0.0, 9, 0.0, 0, 0, 1),
        (55, 0.2, 2, 1.0, 2, 1.0, 0, 0, 1), (22, 0.0, 30, 0.0, 0, 0.0, 0, 0, 1), (110, 0.0, 4, 1.0, 100, 0.0, 0, 0, 1),
        (5, 0.0, 4, 0.6, 44, 0.0, 0, 0, 1), (4, 0.0, 2, 1.0, 40, 0.0, 0, 0, 1), (7, 0.0, 0, 0.0, 52, 0.0, 0, 0, 1),
        (9, 0.9, 50, 0.0, 40, 0.0, 0, 0, 0), (5, 1.0, 45, 0.0, 3, 1.0, 0, 0, 0), (24, 0.8, 4, 1.0, 50, 0.0, 0, 0, 0),
        (3, 0.0, 0, 0.0, 4, 0.0, 0, 0, 0), (4, 0.0, 4, 0.0, 0, 0.0, 0, 0, 0), (2, 0.0, 70, 0.0, 0, 0.0, 0, 0, 0),
        (6, 0.0, 90, 0.0, 3, 0.0, 0, 0, 0), (8, 0.0, 60, 0.0, 2, 0.0, 0, 0, 0), (10, 0.2, 40, 0.0, 0, 0.0, 0, 0, 0),
        (3, 1.0, 2, 1.0, 4, 1.0, 0, 0, 0), (2, 1.0, 0, 0.0, 1, 1.0, 0, 0, 0), (7, 0.9, 5, 1.0, 30, 0.0, 0, 0, 0),
        (14, 0.8, 3, 1.0, 6, 0.7, 0, 0, 0), (4, 0.0, 3, 1.0, 5, 0.0, 0, 0, 0), (6, 0.0, 5, 0.0, 3, 0.0, 0, 0, 0),
        (9, 0.2, 4, 0.0, 0, 0.0, 0, 0, 0), (2, 0.0, 8, 0.5, 2, 1.0, 0, 0, 0), (11, 0.6, 7, 0.0, 8, 0.4, 0, 0, 0),
        (30, 0.0, 50, 0.0, 44, 0.0, 0, 1, 0), (4, 0.0, 52, 0.0, 60, 0.0, 0, 1, 0), (70, 0.1, 9, 0.0, 12, 0.0, 0, 1, 0),
        (2, 1.0, 3, 1.0, 2, 1.0, 0, 1, 0), (12, 0.0, 60, 0.0, 0, 0.0, 0, 1, 0), (55, 0.0, 0, 0.0, 70, 0.0, 0, 1, 0),
    ]
)


def grow(rows: np.ndarray, depth: int = 8, leaf: int = 2) -> tuple | float:
    """A decision tree by the Gini index: (column, threshold, tree at most, tree above), or the share of main text."""
    label = rows[:, -1]
    share = float(label.mean())
    if depth == 0 or share in (0.0, 1.0):
        return share
    best = None
    for column in range(rows.shape[1] - 1):
        values = np.unique(rows[:, column])
        for cut in (values[:-1] + values[1:]) / 2:
            left = rows[:, column] <= cut
            if min(left.sum(), (~left).sum()) < leaf:
                continue
            impurity = sum(m.sum() * (p := label[m].mean()) * (1 - p) for m in (left, ~left))
            if best is None or impurity < best[0] - 1e-12:
                best = impurity, column, float(cut)
    if best is None:
        return share
    left = rows[:, best[1]] <= best[2]
    return best[1], best[2], grow(rows[left], depth - 1, leaf), grow(rows[~left], depth - 1, leaf)


def verdict(tree: tuple | float, row: tuple) -> float:
    while isinstance(tree, tuple):
        column, cut, low, high = tree
        tree = low if row[column] <= cut else high
    return tree


@lru_cache(1)
def trained() -> tuple | float:
    return grow(LABELLED)


def main_text(page: str, tree: tuple | float | None = None) -> str:
    """The blocks that the tree takes for main text, in page order."""
    tree = tree or trained()
    found = blocks(page)
    placed = any(b.inside and not b.site for b in found)
    shape = [(b.words, b.linked / b.words) for b in found]
    around = [(0, 0.0), *shape, (0, 0.0)]
    out = []
    for k, b in enumerate(found):
        place = (1 if b.inside else -1) if placed else 0
        if verdict(tree, (*shape[k], *around[k], *around[k + 2], place, int(b.site))) > 0.5:
            out.append(b.text)
    return "\n\n".join(out)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of `pages` (page_id, url, html), row by row and from the whole html.

    A null html is an empty page, which has an empty text. Rows that repeat give equal rows; other columns are not
    read; an empty table gives no rows.
    """
    tree = trained()

    def run(batch):
        texts = [main_text(p, tree) for p in strings(batch, "html")]
        yield {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts, "n_chars": [len(t) for t in texts]}

    kind = pages.schema["page_id"].dataType.simpleString()
    return mapped(pages.select("page_id", "url", "html"), run, f"page_id {kind}, url string, text string, n_chars long", rows=256)
