"""Pattern extraction from HTML columns."""

from __future__ import annotations

import json
import re
from html import unescape
from html.entities import html5

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom import vocab
from feedloom.functions.core import col, first_group
from feedloom.functions.text import squeeze, strip

# Named references from Python's table of the markup standard, and those of them that need no semicolon, longest first.
_NAMED = {name[:-1]: char for name, char in html5.items() if name.endswith(";")} | {"nbsp": " "}
_SHORT = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))
_COMMON = ("amp", "nbsp", "lt", "gt", "quot", "apos")
# Numbers that stand for another character by the standard.
_NUMBERS = {str(n): unescape(f"&#{n};") for n in (0, *range(128, 160))} | {"160": " "}
_REFERENCE = r"^&(#[xX][0-9a-fA-F]{1,6}|#[0-9]{1,7}|[A-Za-z][A-Za-z0-9]*(?=;));?"
_SHORT_REFERENCE = "^&(" + "|".join(_SHORT) + ")"


def _reference(piece: Column, names: Column, numbers: Column) -> Column:
    """A piece that starts with a reference, decoded; any other piece as it is."""
    found = F.regexp_extract(piece, _REFERENCE, 1)
    number = (
        F.when(found.rlike("^#[xX]"), F.conv(F.substring(found, 3, 8), 16, 10))
        .when(found.startswith("#"), F.substring(found, 2, 8))
        .cast("int")
    )
    valid = (number < 0xD800) | ((number > 0xDFFF) & (number < 0x110000))
    char = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")).when(number.isNotNull(), "\ufffd")
    # A literal map is searched from its start, so it is asked once, and not for the names that stand almost everywhere.
    common = F.lit(None).cast("string")
    for name in reversed(_COMMON):
        common = F.when(found == name, _NAMED[name]).otherwise(common)
    named = F.when(found.isin(*_COMMON), common).otherwise(F.try_element_at(names, found))
    char = F.when(found.startswith("#"), F.coalesce(F.try_element_at(numbers, number.cast("string")), char)).when(found != "", named)
    short = F.nullif(F.regexp_extract(piece, _SHORT_REFERENCE, 1), F.lit(""))
    return F.coalesce(
        F.concat(char, F.regexp_replace(piece, _REFERENCE, "")),
        F.concat(F.try_element_at(names, short), F.regexp_replace(piece, _SHORT_REFERENCE, "")),
        piece,
    )


def decode_references(c: Column) -> Column:
    """Numeric and named character references; what they stand for is not decoded again."""
    names = F.from_json(F.lit(json.dumps(_NAMED)), "map<string,string>")
    numbers = F.from_json(F.lit(json.dumps(_NUMBERS)), "map<string,string>")
    pieces = F.transform(F.split(c, "(?=&)"), lambda p: _reference(p, names, numbers))
    return F.when(c.contains("&"), F.array_join(pieces, "")).otherwise(c)


def tag_text(html: Column | str, tag: str) -> Column:
    """Text of the first element with this tag, NULL where there is none."""
    inner = first_group(col(html), rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>")
    return text_of(inner)


def text_of(fragment: Column) -> Column:
    return squeeze(decode_references(F.regexp_replace(fragment, "<[^>]+>", " ")))


def attribute(html: Column | str, tag: str, name: str) -> Column:
    """Attribute of the first such tag that carries it."""
    return first_group(col(html), rf"""(?is)<{tag}\b[^>]*?\b{name}=["']([^"']*)["']""")


def all_elements(html: Column | str, tag: str) -> Column:
    """Inner markup of every element with this tag, in order."""
    return F.regexp_extract_all(col(html), F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>"), F.lit(1))


def all_hrefs(html: Column | str) -> Column:
    return F.regexp_extract_all(
        col(html), F.lit(r"""(?is)<a\b[^>]*?\bhref=["']([^"']*)["']"""), F.lit(1)
    )


def first_match(html: Column | str, patterns) -> Column:
    """First pattern (in order) that matches, trimmed."""
    return strip(F.coalesce(*[first_group(col(html), "(?i)" + p) for p in patterns]))


def matches(html: Column | str, patterns) -> list[Column]:
    return [strip(first_group(col(html), "(?i)" + p)) for p in patterns]


def canonical_link(html: Column | str) -> Column:
    return first_match(html, vocab.CANONICAL_LINK_PATTERNS)


def og_url(html: Column | str) -> Column:
    return first_match(html, vocab.OG_URL_PATTERNS)


def rows_of(html: str, container: str, row: str, cell: str) -> list[list[str]]:
    """Inner markup of the cells of every row of every container, nested ones too, rows and cells in page order.

    One pass over the tags. An element ends at the end tag of its own container's depth, or where the next one of its
    kind starts, if its end tag is left out. A row also has the cells of the containers within its cells. Comments,
    scripts and styles hold no tags.
    """
    tags = re.compile(
        rf"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<(/?)({container}|{row}|{cell})\b[^<>]*>", re.I | re.S
    )
    rows: list[list[list[int]]] = []
    open_: list[list] = []  # one (cells of the open row, open cell) per container around this place

    def end_cell(at: int) -> None:
        if open_[-1][1]:
            open_[-1][1][1] = at
        open_[-1][1] = None

    for m in tags.finditer(html):
        closing, tag = m.group(2), (m.group(3) or "").lower()
        if tag == container and not closing:
            open_.append([None, None])
        elif tag and open_:
            end_cell(m.start())
            if tag == container:
                open_.pop()
            elif tag == row:
                open_[-1][0] = None if closing else []
                if not closing:
                    rows.append(open_[-1][0])
            elif not closing and open_[-1][0] is not None:
                open_[-1][1] = [m.end(), len(html)]
                for around, _ in open_:
                    if around is not None:
                        around.append(open_[-1][1])
    return [[html[a:b] for a, b in cells] for cells in rows]


def container_rows(html: Column | str, container: str, row: str, cell: str) -> Column:
    """`rows_of` as array<array<string>>, NULL without such a container; one Arrow-batched pass over the markup.

    Depth can't be counted by a pattern, and arrays of the JVM have no running sum, so this is Python; markup that
    holds no container never leaves the JVM.
    """

    @F.pandas_udf("array<array<string>>")
    def find(pages: pd.Series) -> pd.Series:
        return pages.map(lambda h: None if h is None else rows_of(h, container, row, cell))

    c = col(html)
    return find(F.when(c.rlike(rf"(?i)<{container}\b"), c))
