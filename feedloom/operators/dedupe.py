"""First-seen-wins de-duplication. The order is always explicit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions import text
from feedloom.functions.core import blank_to_null, pin
from feedloom.functions.urls import with_page, with_signature
from feedloom.operators.gates import is_chart
from feedloom.operators.keyed import first_by, lookup
from feedloom.schema import FEEDS, ORDER


def with_dedupe_key(items: DataFrame) -> DataFrame:
    """Add `dedupe_key`: the page signature, else title signature, year, type and source."""
    c = F.col
    df = with_page(items, article_url=("_ac", "_aok"), source_url=("_sc", "_sok"))
    df = df.withColumn("_page", F.when(c("_aok"), c("_ac")).when(c("_sok"), c("_sc")))
    # One signature serves both forms: of the page, or else of the source.
    df = with_signature(df, _sig=F.coalesce("_page", "_sc"))
    df = pin(df, _title=text.title_signature("title"))
    plain = F.lower(
        F.regexp_replace(
            F.split_part(text.clean_text("source_url"), F.lit("?"), F.lit(1)), "/+$", ""
        )
    )
    by_title = F.concat_ws(
        "|",
        "_title",
        F.coalesce(c("year").cast("string"), F.lit("")),
        text.normalize_type(text.type_label("type")),
        F.coalesce(blank_to_null(c("_sig")), plain),
    )
    key = F.when(c("_page").isNotNull(), F.concat(F.lit("url|"), "_sig")).otherwise(by_title)
    return df.withColumn("dedupe_key", key).drop("_ac", "_aok", "_sc", "_sok", "_page", "_sig", "_title")


def chart_key():
    """Chart rows share a list URL, so they are told apart by title, type and year."""
    return F.concat_ws(
        "|",
        F.lower(text.strip("title")),
        F.coalesce("type", F.lit("")),
        F.coalesce(F.col("year").cast("string"), F.lit("")),
    )


def dedupe_articles(items: DataFrame, by=("feed",), order=ORDER) -> DataFrame:
    keyed = with_dedupe_key(items)
    return first_by(keyed, [*by, "dedupe_key"], list(order)).drop("dedupe_key")


def dedupe_charts(items: DataFrame, by=("feed",), order=ORDER) -> DataFrame:
    keyed = items.withColumn("_key", chart_key())
    return first_by(keyed, [*by, "_key"], list(order)).drop("_key")


def with_feed_key(items: DataFrame, feeds=FEEDS) -> DataFrame:
    """Add `dedupe_key` by the rule of the row's kind of feed."""
    return with_dedupe_key(items).withColumn(
        "dedupe_key", F.when(is_chart(feeds), chart_key()).otherwise(F.col("dedupe_key"))
    )


def dedupe_feeds(items: DataFrame, feeds=FEEDS, order=ORDER) -> DataFrame:
    """Both rules in one shuffle: each row carries the key of its kind of feed."""
    return first_by(with_feed_key(items, feeds), ["feed", "dedupe_key"], list(order)).drop("dedupe_key")


def dedupe_by_title(df: DataFrame, by: list, order: list, title: str = "title", url: str | None = None) -> DataFrame:
    """First row per lower-cased title (and URL, where given) inside one source."""
    df = df.withColumn("_title", F.lower(title))
    keys = [*by, "_title"] + ([url] if url else [])
    return first_by(df, keys, order).drop("_title")


def near_title_groups(df: DataFrame, order: str, title: str = "title") -> DataFrame:
    """Groups of rows whose titles have the same signature: size, spellings, first row."""
    return (
        df.withColumn("title_key", text.title_signature(title))
        .groupBy("title_key", title)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_first"))
        .groupBy("title_key")
        .agg(
            F.sum("_n").alias("n_rows"),
            F.count(F.lit(1)).alias("n_spellings"),
            F.min("_first").alias("first_row"),
        )
    )


def titles_across_platforms(items: DataFrame, platform: str = "platform") -> DataFrame:
    """Page signature, else title signature, year and type; with the platforms that carry it."""
    c = F.col
    df = with_page(items, article_url=("_ac", "_aok"))
    df = with_signature(df, _sig=c("_ac"))
    df = pin(df, _title=text.title_signature("title"))
    key = F.when(c("_aok"), F.concat(F.lit("url|"), "_sig")).otherwise(
        F.concat_ws(
            "|",
            "_title",
            F.coalesce(c("year").cast("string"), F.lit("")),
            text.normalize_type(text.type_label("type")),
        )
    )
    return (
        df.select(key.alias("title_key"), platform)
        .groupBy("title_key", platform)
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("title_key")
        .agg(
            F.sum("_n").alias("n_rows"),
            F.count(F.lit(1)).alias("n_platforms"),
            F.sort_array(F.collect_list(platform)).alias("platforms"),
        )
    )


def drop_seen_in_earlier_feeds(items: DataFrame, order: list, feeds=FEEDS) -> DataFrame:
    """A page URL stays only in the first feed (and row) that carries it.

    Applies to the feeds registered for it, in feed order. Rows without a concrete page URL
    and rows of other feeds pass; they get a key of their own, so they spread evenly.
    """
    ranks = {row[0]: row[1] for row in feeds if row[6]}
    feed_rank = F.coalesce(
        *[F.when(F.col("feed") == name, rank) for name, rank in ranks.items()], F.lit(-1)
    )
    df = with_page(items.withColumn("_rank", feed_rank), article_url=("_ac", "_aok"))
    checked = (F.col("_rank") >= 0) & F.col("_aok")
    df = with_signature(df, _sig=F.when(checked, F.col("_ac")))
    df = df.withColumns(
        {
            "_row_feed": F.when(~checked, F.col("feed")),
            **{f"_row_{i}": F.when(~checked, F.col(c)) for i, c in enumerate(order)},
        }
    )
    own = ["_row_feed", *[f"_row_{i}" for i in range(len(order))]]
    kept = first_by(df, ["_sig", *own], ["_rank", *order])
    return kept.drop("_rank", "_ac", "_aok", "_sig", *own)


def drop_seen_before(items: DataFrame, seen: DataFrame, spread_by: list) -> DataFrame:
    """Incremental form: drop rows whose page signature is in a table of signatures seen earlier."""
    df = with_page(items, article_url=("_ac", "_aok"))
    df = with_signature(df, signature=F.when(F.col("_aok"), F.col("_ac")))
    known = seen.select("signature").distinct().withColumn("_known", F.lit(True))
    return (
        lookup(df, known, ["signature"], spread_by)
        .where(F.col("_known").isNull())
        .drop("_ac", "_aok", "_known")
    )
