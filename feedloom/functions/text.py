"""Text columns: titles, summaries, types, genres, content buckets."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom import vocab
from feedloom.functions.core import (
    SPACE,
    WORD,
    any_of,
    blank_to_null,
    col,
    has_any,
    has_word,
    map_get,
)


def squeeze(c: Column | str) -> Column:
    """Runs of whitespace become one space; no leading or trailing space. NULL stays NULL."""
    return F.trim(F.regexp_replace(col(c), SPACE + "+", " "))


def strip(c: Column | str) -> Column:
    """Remove leading and trailing Unicode whitespace."""
    return F.regexp_replace(col(c), f"^{SPACE}+|{SPACE}+$", "")


def clean_text(c: Column | str, fallback: str = "") -> Column:
    text = F.coalesce(squeeze(c), F.lit(""))
    return text if fallback == "" else F.coalesce(blank_to_null(text), F.lit(fallback))


def clean_lower(c: Column | str) -> Column:
    return clean_text(F.lower(col(c)))


def clamp_summary(clean: Column | str, limit: int = vocab.SUMMARY_CHARS) -> Column:
    """Clean text up to `limit` characters, otherwise cut at a word end with the cut marked.

    Takes a column that `clean_text` made, so that the text is cleaned once.
    """
    text = col(clean)
    head = F.rtrim(F.left(text, F.lit(limit)))
    head = F.regexp_replace(head, " [^ ]*$", "")
    head = F.regexp_replace(head, "[ ,;:\\-–—]+$", "")
    # Three dots unless the kept text already ends a sentence.
    marked = F.regexp_replace(head, r"(?s)^(|.*[^.!?])$", "$1...")
    return F.when(F.length(text) <= limit, text).otherwise(marked)


def normalize_title(c: Column | str, fallback: str = vocab.UNKNOWN_TITLE) -> Column:
    """Drop a trailing outlet name, a trailing year or series marker, and dangling separators."""
    text = clean_text(c, fallback)
    text = F.regexp_replace(
        text,
        rf"\s+[-|–—]\s+(?:[A-Za-z](?:{WORD}|[ .&+:'/-]){{1,60}}|(?:{WORD}|[.-])+\.[a-z]{{2,}})\s*$",
        "",
    )
    text = F.regexp_replace(text, rf"(?i)\s+[-|–—]\s+(?:{WORD}|[.-])+\.[a-z]{{2,}}\s*$", "")
    text = F.regexp_replace(text, r"(?i)\s*\((?:\p{Nd}{4}|TV Series|TV Mini Series)\)\s*$", "")
    text = F.regexp_replace(squeeze(text), r"^[ \-|]+|[ \-|]+$", "")
    return F.coalesce(blank_to_null(text), F.lit(fallback))


def title_signature(c: Column | str) -> Column:
    """Title fingerprint: no articles, no punctuation, one space between words."""
    text = F.lower(normalize_title(c))
    text = F.regexp_replace(text, rf"(?<!{WORD})(?:the|a|an)(?!{WORD})", "")
    text = F.regexp_replace(text, r"[^\p{L}\p{N}_\s]", "")
    return squeeze(text)


def normalize_type(lowered: Column | str) -> Column:
    """Media type of a clean lower-case label (see `type_label`)."""
    text = col(lowered)
    return (
        F.when(text.contains("doc"), "documentary")
        .when(text.contains("anime"), "anime")
        .when(has_any(text, ("tv", "series", "show", "season", "episode")), "series")
        .otherwise("movie")
    )


def type_label(c: Column | str, fallback: str = "movie") -> Column:
    return F.lower(clean_text(c, fallback))


def extract_type(lowered: Column | str, default: Column | str = "movie") -> Column:
    """Media type named in a lower-case text."""
    text = col(lowered)
    default = F.lit(default) if isinstance(default, str) else default
    return (
        F.when(text.contains("documentary"), "documentary")
        .when(text.contains("anime"), "anime")
        .when(has_any(text, ("season", "episode", "series", "tv")), "series")
        .when(has_any(text, ("movie", "film")), "movie")
        .otherwise(default)
    )


def extract_terms(lowered: Column | str, terms=vocab.GENRE_NAMES) -> Column:
    """Which of the terms occur in a lower-case text, in list order."""
    text = col(lowered)
    hits = F.array(*[F.when(text.contains(t.lower()), F.lit(t)) for t in terms])
    return F.array_compact(hits)


def normalize_platform(c: Column | str, fallback: str = "multi_platform") -> Column:
    text = F.lower(clean_text(c, fallback))
    known = F.coalesce(map_get(vocab.PLATFORM_ALIASES, text), text)
    return F.when(known.isin(*vocab.PLATFORMS), known).otherwise(fallback)


def title_case(c: Column) -> Column:
    """Upper-case the first letter of every run of letters."""
    runs = F.split(c, r"(?<!\p{L})(?=\p{L})")
    return F.array_join(
        F.transform(runs, lambda r: F.concat(F.upper(F.left(r, F.lit(1))), F.lower(F.substring(r, 2, 1 << 30)))),
        "",
    )


def normalize_genres(c: Column) -> Column:
    """Array of genre names: cleaned, title-cased, distinct, sorted. NULL gives an empty array."""
    cleaned = F.filter(F.transform(c, lambda g: title_case(clean_text(g))), lambda g: g != "")
    return F.coalesce(F.sort_array(F.array_distinct(cleaned)), F.array().cast("array<string>"))


def split_genres(c: Column | str) -> Column:
    """A genre list given as one string."""
    return F.split(col(c), "[,/|]")


def sanitize_title(c: Column | str) -> Column:
    """Cut a trailing service name."""
    raw = col(c)
    cut = strip(F.regexp_replace(raw, "(?i)" + vocab.SERVICE_TITLE_TAIL, ""))
    return F.coalesce(blank_to_null(cut), strip(raw))


@F.pandas_udf(T.StringType())
def unescape_html(text: pd.Series) -> pd.Series:
    """Every named and numeric character reference; Spark has no built-in for the full table."""
    return text.map(html.unescape, na_action="ignore")


def strip_tags(c: Column) -> Column:
    return squeeze(F.regexp_replace(c, "<[^>]+>", " "))


def sanitize_overview(c: Column | str) -> Column:
    """Decode character references, then drop tags and squeeze whitespace."""
    return strip_tags(unescape_html(F.coalesce(col(c), F.lit(""))))


def clean_chart_title(c: Column | str) -> Column:
    """Drop a leading rank and a trailing season or series marker."""
    text = F.regexp_replace(strip(F.coalesce(col(c), F.lit(""))), vocab.CHART_RANK_PREFIX, "")
    text = F.regexp_replace(text, "(?i)" + vocab.CHART_SEASON_SUFFIX, "")
    return F.regexp_replace(text, r"^[ :\-]+|[ :\-]+$", "")


def strip_list_number(c: Column | str) -> Column:
    return strip(F.regexp_replace(col(c), r"^\d+\.\s*", ""))


def search_title(c: Column | str) -> Column:
    """Title without trailer, service and headline noise."""
    raw = col(c)
    text = F.regexp_replace(raw, "(?iU)" + vocab.SEARCH_TRAILING_NOISE, "")
    text = F.regexp_replace(text, "(?iU)" + vocab.SEARCH_SEASON, "")
    text = F.regexp_replace(text, "(?iU)" + vocab.SEARCH_SUFFIXES, "")
    text = F.regexp_replace(text, "(?iU)" + vocab.SEARCH_PREFIXES, "")
    text = strip(F.regexp_replace(squeeze(text), r"[:\-–—|]+\s*$", ""))
    return F.coalesce(blank_to_null(text), strip(raw))


def title_core(raw: Column, cleaned: Column) -> Column:
    """A quoted phrase of at least three characters, else the cleaned title."""
    matched = raw.rlike(vocab.QUOTED_TITLE)
    return F.when(matched, strip(F.regexp_extract(raw, vocab.QUOTED_TITLE, 1))).otherwise(cleaned)


def search_keys(core: Column, cleaned: Column) -> Column:
    """Search phrases from most to least specific: core, cleaned, first four words, first three."""
    words = F.split(squeeze(F.coalesce(blank_to_null(core), cleaned)), " ")
    phrases = F.array_compact(
        F.array(
            blank_to_null(core),
            blank_to_null(cleaned),
            F.when(F.size(words) > 4, F.array_join(F.slice(words, 1, 4), " ")),
            F.when(F.size(words) > 6, F.array_join(F.slice(words, 1, 3), " ")),
        )
    )
    # A phrase stays if its lower-case form has not occurred before.
    lowered = F.transform(phrases, lambda p: F.lower(strip(p)))
    return F.filter(
        phrases,
        lambda p, i: (strip(p) != "") & (F.array_position(lowered, F.lower(strip(p))) == i + 1),
    )


def topic_text(title: Column | str, overview: Column | str) -> Column:
    """What the topic lists are matched against."""
    return F.lower(F.concat_ws(" ", clean_text(title), clean_text(overview)))


def topic_match(text: Column | str, allow=vocab.TOPIC_ALLOW, deny=vocab.TOPIC_DENY) -> Column:
    """No denied word as a whole word, and at least one allowed term as a substring.

    `text` is an existing `topic_text` column.
    """
    text = col(text)
    return has_any(text, allow) & ~has_word(text, deny)


def merged_text(title: Column | str, overview: Column | str) -> Column:
    """Title and overview as they are, in lower case."""
    return F.lower(
        F.concat_ws(" ", F.coalesce(col(title), F.lit("")), F.coalesce(col(overview), F.lit("")))
    )


def relevance_match(
    text: Column | str,
    source_url: Column,
    exclude=(),
    signals=(),
    extra_signals=(),
    trusted=(),
    include=(),
) -> Column:
    """Exclusions first, then both signal lists, then a trusted domain or an include word.

    `text` is an existing `merged_text` column.
    """
    text = col(text)
    url = F.lower(F.coalesce(source_url, F.lit("")))

    def lower(words):
        return [w.lower() for w in words]

    keep = ~has_any(text, lower(exclude))
    if signals:
        keep = keep & has_any(text, lower(signals))
    if extra_signals:
        keep = keep & has_any(text, lower(extra_signals))
    if include:
        keep = keep & (has_any(url, lower(trusted)) | has_any(text, lower(include)))
    return keep


def relevance_by_rules(text: Column | str, source_url: Column, rules: Column) -> Column:
    """`relevance_match` with the word lists as arrays of a struct, in lower case; an empty or null list asks for nothing."""
    text = col(text)
    url = F.lower(F.coalesce(source_url, F.lit("")))

    def any_in(where: Column, words: str) -> Column:
        return F.coalesce(F.exists(rules[words], lambda w: where.contains(w)), F.lit(False))

    def asked(words: str) -> Column:
        return F.coalesce(F.size(rules[words]), F.lit(0)) > 0

    keep = ~any_in(text, "exclude")
    for words in ("signals", "extra_signals"):
        keep = keep & (~asked(words) | any_in(text, words))
    return keep & (~asked("include") | any_in(url, "trusted") | any_in(text, "include"))


def infer_content_type(feed: Column, media_type: Column, text: Column | str) -> Column:
    """`text` is an existing `topic_text` column."""
    feed = F.lower(F.coalesce(feed, F.lit("")))
    documentary = (clean_lower(media_type) == "documentary") | has_word(col(text), ["documentary"])
    return (
        F.when(documentary, "review")
        .when(feed == "trending", "trending")
        .when(feed == "upcoming", "upcoming_release")
        .when(feed == "cinema_releases", "cinema_release")
        .when(feed.isin("netflix", "disney_plus", "prime_video", "hbo_max"), "platform_release")
        .otherwise("review")
    )


def content_bucket(explicit: Column, feed: Column, media_type: Column, text: Column | str) -> Column:
    """An allowed explicit value wins; otherwise inferred, `review` where the topic does not fit."""
    given = clean_text(explicit)
    return (
        F.when(given.isin(*vocab.CONTENT_TYPES), given)
        .when(~topic_match(text), "review")
        .otherwise(infer_content_type(feed, media_type, text))
    )


def parse_year(c: Column | str) -> Column:
    return F.regexp_extract(col(c), "(?:19|20)[0-9]{2}", 0).try_cast("int")


def coerce_rating(c: Column | str) -> Column:
    """Number clamped to 0..10; NULL for anything that is not a number."""
    text = strip(col(c))
    numeric = text.rlike(r"(?i)^[+-]?(?:\d+\.?\d*(?:e[+-]?\d+)?|\.\d+(?:e[+-]?\d+)?|inf|infinity|nan)$")
    return F.when(numeric, F.greatest(F.lit(0.0), F.least(F.lit(10.0), text.try_cast("double"))))


def quality_score(
    domain: Column,
    poster: Column,
    published_at: Column,
    article_url: Column,
    title: Column,
    merged: Column | str,
    topic: Column | str,
    allow=vocab.TOPIC_ALLOW,
    deny=vocab.TOPIC_DENY,
    clickbait=vocab.CLICKBAIT,
    generic=vocab.GENERIC_TITLES,
    trusted=vocab.TRUSTED_DOMAIN_PARTS,
) -> Column:
    """Points for a known outlet, picture, time, link and topic; deductions for poor titles.

    `merged` and `topic` are existing `merged_text` and `topic_text` columns.
    """

    def points(condition: Column, n: int) -> Column:
        return F.when(condition, n).otherwise(0)

    def present(c: Column) -> Column:
        return F.coalesce(c != "", F.lit(False))

    trimmed = strip(F.coalesce(title, F.lit("")))
    return (
        points(has_any(F.lower(F.coalesce(domain, F.lit(""))), trusted), 3)
        + points(present(poster), 2)
        + points(present(published_at), 2)
        + points(present(article_url), 2)
        + points(topic_match(topic, allow, deny), 2)
        - points(has_any(col(merged), clickbait), 3)
        - points(F.lower(trimmed).isin(*generic), 3)
        - points(F.length(trimmed) < 8, 4)
    )


def listing_overview(lead: Column, description: Column) -> Column:
    """A lead sentence followed by the description where there is one."""
    return strip(F.concat_ws(" ", lead, blank_to_null(description)))


def theatrical_overview(distributor: Column, theaters: Column) -> Column:
    return F.concat_ws(
        " ",
        F.lit("Movie currently playing in cinema theaters."),
        F.concat(F.lit("Distributed by "), blank_to_null(distributor), F.lit(".")),
        F.when(
            theaters != 0,
            F.concat(F.lit("Showing in "), F.format_number(theaters, 0), F.lit(" theaters.")),
        ),
    )
