"""Row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom import vocab
from feedloom.functions import images, text
from feedloom.functions.core import keep, pin
from feedloom.functions.urls import with_page
from feedloom.schema import FEED_ITEM, FEEDS


def feeds_where(feeds=FEEDS, **want) -> list[str]:
    """Names of the feeds whose registry entry has the given values."""
    names = ("feed", "feed_ord", "kind", "min_title", "cap", "needs_page", "once_per_url")
    return [
        row[0] for row in feeds if all(row[names.index(key)] == value for key, value in want.items())
    ]


def is_chart(feeds=FEEDS) -> Column:
    charts = feeds_where(feeds, kind="chart")
    return F.coalesce(F.col("feed").isin(*charts), F.lit(False)) if charts else F.lit(False)


def per_feed(name: str, default: int, feeds=FEEDS) -> Column:
    """A number of the registry by the row's feed; `default` for feeds it does not list."""
    at = ("feed", "feed_ord", "kind", "min_title", "cap").index(name)
    values = F.create_map(*[F.lit(x) for row in feeds for x in (row[0], row[at])]) if feeds else None
    return F.lit(default) if values is None else F.coalesce(F.try_element_at(values, F.col("feed")), F.lit(default))


def drop_reserved_titles(items: DataFrame, feeds=FEEDS) -> DataFrame:
    """No source URL, placeholder or generic titles, and titles too short for their feed."""
    title = text.strip("title")
    shortest = per_feed("min_title", vocab.MIN_TITLE, feeds)
    return keep(
        items.where(F.col("source_url") != ""),
        ~F.lower("title").isin(*vocab.RESERVED_TITLES)
        & ~F.lower(title).isin(*vocab.GENERIC_TITLES)
        & (F.length(title) >= shortest),
    )


def topic_gate(
    items: DataFrame, allow=vocab.TOPIC_ALLOW, deny=vocab.TOPIC_DENY, feeds=FEEDS
) -> DataFrame:
    """Rows on topic; chart rows always pass."""
    on_topic = text.topic_match("_text", allow, deny)
    if "feed" in items.columns:
        on_topic = is_chart(feeds) | on_topic
    return keep(pin(items, _text=text.topic_text("title", "overview")), on_topic).drop("_text")


def relevance_gate(entries: DataFrame, rules: dict) -> DataFrame:
    """Keep entries that match the word lists of a source (see `relevance_match`)."""
    df = pin(entries, _text=text.merged_text("title", "overview"))
    return keep(df, text.relevance_match("_text", F.col("source_url"), **rules)).drop("_text")


def valid_page_gate(items: DataFrame, feeds=FEEDS) -> DataFrame:
    """For feeds that need it: the article or source URL must be a concrete content page."""
    needed = feeds_where(feeds, needs_page=True)
    exempt = ~F.coalesce(F.col("feed").isin(*needed), F.lit(False)) if needed else F.lit(True)
    df = with_page(items, article_url=("_ac", "_aok"), source_url=("_sc", "_sok"))
    return df.where(exempt | F.col("_aok") | F.col("_sok")).drop("_ac", "_aok", "_sc", "_sok")


def with_quality(items: DataFrame, **lists) -> DataFrame:
    c = F.col
    df = pin(
        items,
        _merged=text.merged_text("title", "overview"),
        _topic=text.topic_text("title", "overview"),
    )
    score = text.quality_score(
        c("source_domain"),
        c("poster_image_url"),
        c("published_at").cast("string"),
        c("article_url"),
        c("title"),
        "_merged",
        "_topic",
        **lists,
    )
    return pin(df, quality=score).drop("_merged", "_topic")


def quality_gate(
    items: DataFrame, min_score: int = vocab.MIN_QUALITY, feeds=FEEDS, **lists
) -> DataFrame:
    """Rows scoring at least `min_score`; chart rows always pass."""
    scored = with_quality(items, **lists)
    return scored.where(is_chart(feeds) | (F.col("quality") >= min_score)).drop("quality")


def schema_gate(items: DataFrame, schema: T.StructType = FEED_ITEM) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the record, and the rows that do not.

    A missing column or a genre column that is no array is an error of the whole frame;
    a row without a title or genre array goes to the second result.
    """
    missing = [f.name for f in schema if f.name not in items.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    if not isinstance(items.schema["genres"].dataType, T.ArrayType):
        raise ValueError("genres must be an array")
    fits = F.col("title").isNotNull() & F.col("genres").isNotNull()
    return items.where(fits), items.where(~fits)


def clean_image_columns(items: DataFrame) -> DataFrame:
    """Drop known logos and enlarge small thumbnails in both image columns."""
    return items.withColumns(
        {n: images.clean_image(n) for n in ("poster_image_url", "backdrop_image_url")}
    )
