"""Who published a URL: outlet name and domain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom import vocab
from feedloom.functions.core import any_of, blank_to_null, col, first_group, map_get
from feedloom.functions.text import strip
from feedloom.functions.urls import publication_domain


def source_domain(url: Column | str) -> Column:
    """Publication domain of an http(s) URL, `unknown` for anything else."""
    u = strip(F.coalesce(col(url), F.lit("")))
    host = F.regexp_extract(u, r"^https?://(?:[^/?#]*@)?([^/?#:@]*)", 1)
    return F.when(u.rlike("^https?://"), publication_domain(host)).otherwise("unknown")


def _capitalize(c: Column) -> Column:
    return strip(F.concat(F.upper(F.left(c, F.lit(1))), F.lower(F.substring(c, 2, 1 << 30))))


def _humanize(label: Column) -> Column:
    words = strip(F.translate(label, "-_", "  "))
    spaced = F.when(
        (F.length(words) >= 12) & ~words.contains(" "),
        F.regexp_replace(words, "(?i)(" + any_of(vocab.LABEL_ENDINGS) + ")$", " $1"),
    ).otherwise(words)
    return F.coalesce(map_get(vocab.LABEL_NAMES, F.lower(words)), _capitalize(spaced))


def source_name(domain: Column | str) -> Column:
    """Readable outlet name. Refers to the domain often: pass an existing column."""
    d = col(domain)
    known = F.coalesce(
        map_get(vocab.OUTLETS_BY_HOST, d),
        map_get(
            vocab.OUTLETS_BY_SUFFIX,
            first_group(d, r"^(?:[\p{L}\p{N}_.-]+\.)?(" + any_of(vocab.OUTLETS_BY_SUFFIX) + ")$"),
        ),
    )
    parts = F.split(d, r"\.")
    is_uk = d.rlike(r"\.(?:" + any_of(vocab.UK_SECOND_LEVEL) + r")\.uk$")
    core = F.regexp_replace(d, r"(?:^|\.)(?:" + any_of(vocab.DROPPED_TLDS) + ")$", "")
    labels = F.split(core, r"\.")
    last = F.try_element_at(labels, F.lit(-1))
    token = F.when(
        (F.size(labels) >= 2) & (F.length(last) <= 2), F.try_element_at(labels, F.lit(-2))
    ).otherwise(last)
    label = F.when(
        (F.size(labels) >= 2) & token.isin(*vocab.ACRONYM_LABELS), F.upper(token)
    ).when((F.size(labels) >= 2) & (token == "wbd"), F.lit("Warner Bros. Discovery"))
    return (
        F.when(d == "unknown", "Unknown")
        .when(known.isNotNull(), known)
        .when(is_uk, _capitalize(F.translate(F.try_element_at(parts, F.lit(-3)), "-_", "  ")))
        .when(core == "", d)
        .otherwise(F.coalesce(label, _humanize(token)))
    )
