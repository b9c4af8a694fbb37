"""Raw records to the fixed feed record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom import vocab
from feedloom.functions import dates, outlets, text
from feedloom.functions.core import blank_to_null, pin
from feedloom.functions.urls import with_page


def normalize_items(raw: DataFrame, run_at) -> DataFrame:
    """One record per raw row: titles, dates, genres, links and attribution in fixed form.

    `run_at` is the run time as a timestamp column or literal; it is a parameter so that a
    rerun gives the same rows. Columns outside the record (feed, order) pass through.
    """
    run_at = F.lit(run_at).cast("timestamp") if isinstance(run_at, str) else run_at
    c = F.col

    df = pin(raw, source_url=text.clean_text("source_url"))
    df = with_page(df, article_url=("_ac", "_aok"), source_url=("_sc", "_sok"))
    df = df.withColumn(
        "article_url",
        F.when(c("_aok"), c("_ac"))
        .when(c("_sok"), c("_sc"))
        .otherwise(F.coalesce(blank_to_null(c("_sc")), c("source_url"))),
    ).drop("_ac", "_aok", "_sc", "_sok")
    # Groups of heavy columns are pinned one after the other, so that the generated code of
    # each stays small enough to be compiled.
    df = pin(df, source_domain=outlets.source_domain("article_url"))
    df = pin(
        df,
        source_name=outlets.source_name("source_domain"),
        year=text.parse_year(F.coalesce(blank_to_null(c("year")), c("title"))),
        rating=text.coerce_rating("rating"),
    )
    stated = F.coalesce(blank_to_null(c("published_raw")), blank_to_null(c("published_at_hint")))
    df = pin(df, published_at=dates.parse_published(stated))
    df = pin(
        df, published_at=F.coalesce(c("published_at"), dates.parse_published("release_date"))
    )
    df = pin(df, release_date=dates.parse_release_date("release_date"))
    df = pin(
        df,
        title=text.normalize_title("title"),
        overview=text.clean_text("overview", vocab.NO_OVERVIEW),
        type=text.type_label("type"),
        platform=text.normalize_platform("platform"),
    )
    df = df.withColumn("genres", text.normalize_genres(c("genres")))
    df = pin(df, overview=text.clamp_summary("overview"), type=text.normalize_type("type"))
    df = pin(df, _topic=text.topic_text("title", "overview"))
    df = pin(
        df, content_type=text.content_bucket(c("content_type"), c("feed"), c("type"), "_topic")
    ).drop("_topic")
    df = df.withColumns({"scraped_at": run_at, "updated_at": run_at})
    drop = {"published_raw", "published_at_hint"}
    extra = [n for n in df.columns if n not in vocab.FEED_COLUMNS and n not in drop]
    return df.select(*extra, *vocab.FEED_COLUMNS)


def finalize_links(items: DataFrame) -> DataFrame:
    """After enrichment: fill the backdrop from the poster and prefer a concrete page as the link."""
    c = F.col
    df = items.withColumns(
        {
            "backdrop_image_url": F.coalesce(
                blank_to_null(c("backdrop_image_url")), c("poster_image_url")
            ),
            "article_url": F.coalesce(blank_to_null(c("article_url")), c("source_url")),
        }
    )
    df = with_page(df, article_url=("_ac", "_aok"), source_url=("_sc", "_sok"))
    return df.withColumn(
        "article_url", F.when(c("_sok") & ~c("_aok"), c("source_url")).otherwise(c("article_url"))
    ).drop("_ac", "_aok", "_sc", "_sok")


def published_form(items: DataFrame) -> DataFrame:
    """Dates and instants as the text of the published files."""
    return items.withColumns(
        {
            "release_date": F.date_format("release_date", "yyyy-MM-dd"),
            "scraped_at": dates.iso_offset(F.col("scraped_at")),
            "published_at": dates.iso_z(F.col("published_at")),
            "updated_at": dates.iso_z(F.col("updated_at")),
        }
    )


