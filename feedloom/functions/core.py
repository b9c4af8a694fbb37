"""Small building blocks shared by the column functions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Character classes spelled out, so that the JVM regex engine agrees with Unicode text rules.
SPACE = r"[\p{IsWhite_Space}\x1c-\x1f]"
WORD = r"[\p{L}\p{N}_]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pin(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row.

    A plain projection would let Catalyst copy an expensive expression into every
    filter pushed below it; a one-row generator keeps the filter above.
    """
    kept = [c for c in df.columns if c not in columns]
    fields = [c.alias(name) for name, c in columns.items()]
    return df.select(*kept, F.inline(F.array(F.struct(*fields))))


def keep(df: DataFrame, condition: Column) -> DataFrame:
    """Filter on an expensive condition, evaluated once, above the projections it refers to."""
    return pin(df, _keep=condition).where("_keep").drop("_keep")


def any_of(words: Iterable[str]) -> str:
    """Regex alternation of literal words."""
    return "|".join(_escape(w) for w in words)


def _escape(word: str) -> str:
    # re.escape also escapes spaces and '#', which the JVM engine accepts.
    return re.escape(word)


def has_any(text: Column, words: Iterable[str]) -> Column:
    """True if any of the literal words occurs as a substring.

    Plain searches in a row are faster on long texts than one regex alternation, and stop at
    the first hit.
    """
    hit = F.lit(False)
    for i, w in enumerate(words):
        hit = text.contains(w) if i == 0 else hit | text.contains(w)
    return hit


def has_word(text: Column, words: Iterable[str]) -> Column:
    """True if any of the words occurs between word boundaries.

    The regex runs only on texts that contain one of the words at all.
    """
    words = list(words)
    if not words:
        return F.lit(False)
    return has_any(text, words) & text.rlike(rf"(?U)\b(?:{any_of(words)})\b")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_group(c: Column, pattern: str, group: int = 1) -> Column:
    """`regexp_extract` with NULL for no match and for an empty group."""
    return blank_to_null(F.regexp_extract(c, pattern, group))


def lookup_map(values: Mapping) -> Column:
    """A small fixed table as a literal map."""
    flat = []
    for key, value in values.items():
        flat += [F.lit(key), F.lit(value)]
    return F.create_map(*flat)


def map_get(values: Mapping, key: Column) -> Column:
    return F.try_element_at(lookup_map(values), key)
