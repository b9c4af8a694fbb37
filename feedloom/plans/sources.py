"""From landed files to raw records, one function per kind of source."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedloom import vocab
from feedloom.functions import html, text
from feedloom.functions.core import blank_to_null, pin
from feedloom.operators import combine, enrich, gates, keyed, rank
from feedloom.schema import RAW_ITEM, conform
from feedloom.session import settle
from feedloom.sources import documents, pages as html_pages, syndication

# A source plug-in: (spark, config) -> raw records. None means the source failed.
FeedSource = Callable[[SparkSession, dict], DataFrame]

# Word lists of the discovery and cinema sources.
RULES = {
    "trending": {"signals": vocab.STREAMING_SIGNALS, "extra_signals": vocab.TRENDING_SIGNALS},
    "upcoming": {"exclude": vocab.UPCOMING_EXCLUDE},
    "cinema_releases": {"signals": vocab.THEATRICAL_SIGNALS},
}
RULE_LISTS = ("exclude", "signals", "extra_signals", "trusted", "include")
FEED_RULES = "feed string, platform string, default_type string, " + ", ".join(f"{c} array<string>" for c in RULE_LISTS)


def feed_rules(spark: SparkSession, rules: dict[str, dict], platforms: dict[str, str], default_type: str = "movie") -> DataFrame:
    """One row per feed: its platform, its default type and its word lists in lower case."""
    rows = []
    for feed, platform in platforms.items():
        lists = [[w.lower() for w in rules.get(feed, {}).get(c, ())] for c in RULE_LISTS]
        rows.append((feed, platform, rules.get(feed, {}).get("default_type", default_type), *lists))
    return spark.createDataFrame(rows, FEED_RULES)


def syndication_items(
    entries: DataFrame,
    pages: DataFrame,
    rules: dict,
    platform: str,
    default_type: str = "movie",
    n: int = vocab.FEED_CAP,
) -> DataFrame:
    """Entries of one feed's syndication sources to raw records.

    `entries` carries `feed`, `source_ord` and `entry_ord` (1-based per source). Links are
    resolved first because relevance may depend on the source URL.
    """
    row = ["feed", "source_ord", "entry_ord"]
    resolved = enrich.resolve_article_urls(entries, pages, row)
    read = syndication.entry_texts(resolved)
    relevant = text.relevance_match("merged", F.col("source_url"), **rules)
    taken = rank.cascade_with_budget(read, relevant, n, ["feed"], "source_ord", "entry_ord")
    return syndication.to_raw_items(taken, platform, default_type)


def file_name(file: str = "file") -> Column:
    """Last part of a file's path."""
    return F.regexp_extract(file, r"([^/]+)$", 1)


def syndication_job(
    spark: SparkSession,
    path: str,
    files: DataFrame,
    rules: DataFrame,
    pages: DataFrame,
    n: int = vocab.FEED_CAP,
    name: Column | None = None,
) -> DataFrame:
    """Landed RSS and Atom files of all feeds to raw records, in one pass.

    `files(name, feed, source_ord)` says which feed and source a file belongs to; `name` reads the name from a file's
    path, its last part if not given. Entries of files without a row are left out. `rules` is a table as of
    `feed_rules`; entries of a feed without a row are left out too. `pages(url, final_url, html)` resolves links.
    """
    entries = syndication.read_syndication(spark, path).withColumn("name", file_name() if name is None else name)
    placed = entries.join(files, "name").withColumn("source_ord", F.col("source_ord").cast("long")).drop("file", "name")
    placed = settle(placed.withColumn("page_ord", F.lit(0).cast("long")), "entries")
    resolved = enrich.resolve_article_urls(placed, pages, ["feed", "source_ord", "entry_ord"])
    # The word lists meet the rows where they are judged, so they take part in no shuffle.
    ruled = syndication.entry_texts(resolved).join(rules, "feed")
    lists = F.struct(*RULE_LISTS)
    judged = pin(ruled, _keep=text.relevance_by_rules("merged", F.col("source_url"), lists)).drop(*RULE_LISTS)
    judged = settle(judged.where("_keep"), "relevant")
    taken = rank.cascade_with_budget(judged, F.col("_keep"), n, ["feed"], "source_ord", "entry_ord")
    return syndication.to_raw_items(taken, F.col("platform"), F.col("default_type"))


def chart_items(
    replies: DataFrame, by: list[str], label: Column, n: int = vocab.TOP_PER_TYPE
) -> DataFrame:
    """Chart replies (movies and series per chart) to ranked raw records."""
    flat = documents.flatten_chart_edges(replies, by).withColumns(
        {
            "type": F.when(F.col("object_type") == "MOVIE", "movie").otherwise("series"),
            "type_ord": F.when(F.col("object_type") == "MOVIE", 0).otherwise(1),
        }
    )
    ranked = rank.rank_chart(flat, by, "type_ord", ["pos"], n)
    return documents.chart_items(ranked, label)


def top_list_titles(lists: DataFrame, n: int = vocab.TOP_PER_TYPE) -> DataFrame:
    """First `n` different titles of each list page, in page order: (feed, type, title, pos).

    `lists(feed, type, html)`. The title is the first cell of a table row without its rank and season; titles that
    differ in case only are one, spelt as the first of them. Rows without cells or title are left out.
    """
    rows = html_pages.extract_rows(lists, ["feed", "type"])
    first = F.coalesce(html.text_of(F.get("cells", F.lit(0))), F.lit(""))
    named = pin(rows, title=text.clean_chart_title(first)).where("title <> ''")
    once = keyed.first_by(named.select("feed", "type", "title", "row_pos"), ["feed", "type", F.lower("title")], ["row_pos"])
    return keyed.ranked_by(once, ["feed", "type"], ["row_pos"], n, "pos").drop("row_pos")


def search_hits(replies: DataFrame) -> DataFrame:
    """Search replies (title, json) to one row per hit: `title`, `hit_ord` from 1, and the hit's columns as `hit_*`.

    Of several replies for one title the smallest text counts. Broken replies have no hits.
    """
    once = replies.groupBy("title").agg(F.min("json").alias("json"))
    flat = documents.flatten_chart_edges(once.withColumnRenamed("title", "_asked"), ["_asked"])
    renamed = [F.col(c).alias(f"hit_{c}") for c in flat.columns if c not in ("_asked", "pos")]
    return flat.select(F.col("_asked").alias("title"), (F.col("pos") + 1).alias("hit_ord"), *renamed)


def top_list_items(
    lists: DataFrame, backups: DataFrame, replies: DataFrame, platform: str, label: str, n: int = vocab.TOP_PER_TYPE
) -> DataFrame:
    """Official top lists to raw records: titles per type, filled from a backup list, described by search replies.

    `lists(feed, type, list_url, html)` has one page per feed and type (`movie` or `series`), `backups(feed, type, html)` the
    pages that fill lists of fewer than `n` titles, `replies(title, json)` what a search for a title found. A title takes
    the best hit: the list's type before the other, then search order. A title without a hit keeps an address of its own
    below the list's, so that rows of one list are never taken for copies. A feed without a list page but with a backup
    gets the backup's titles, and addresses only where there are hits.
    """
    c = F.col
    own = settle(top_list_titles(lists, n), "top-lists")
    spare = top_list_titles(backups, n)
    placed = combine.top_up(own, spare, n, ["feed", "type"], "title", ["pos"])
    addresses = keyed.first_by(lists.select("feed", "type", "list_url"), ["feed", "type"], ["list_url"])
    want = F.when(c("type") == "series", "SHOW").otherwise("MOVIE")
    chart = settle(placed.join(addresses, ["feed", "type"], "left").withColumn("want", want), "top-titles")
    hits = settle(search_hits(replies), "search-hits")
    found = enrich.lookup_preferred(chart, hits, "title", "want", "hit_object_type", "hit_ord", "hit_title", ["feed", "type", "position"])
    rank_text = c("position").cast("string")
    address = blank_to_null("hit_source_url")
    year = c("hit_year").cast("string")
    lead = F.concat(F.lit(f"{label} Top "), rank_text, F.lit(" "), c("type"), F.lit("."))
    return found.select(
        "feed",
        F.when(c("type") == "series", 1).otherwise(0).cast("long").alias("page_ord"),
        c("position").cast("long").alias("entry_ord"),
        "title",
        year.alias("year"),
        "type",
        F.lit(platform).alias("platform"),
        year.alias("release_date"),
        year.alias("published_raw"),
        text.listing_overview(lead, c("hit_description")).alias("overview"),
        F.coalesce("hit_genres", F.array().cast("array<string>")).alias("genres"),
        c("hit_poster_image_url").alias("poster_image_url"),
        c("hit_poster_image_url").alias("backdrop_image_url"),
        F.coalesce(address, c("list_url")).alias("source_url"),
        F.coalesce(address, F.concat(c("list_url"), F.lit("#"), rank_text, F.lit("-"), c("type"))).alias("article_url"),
        F.lit("platform_release").alias("content_type"),
    )


def theatrical_items(
    charts: DataFrame, details: DataFrame, run_date: Column, n: int = vocab.FEED_CAP
) -> DataFrame:
    """Box-office pages in order of preference to raw records of the first page with rows.

    `charts(feed, source_ord, html)`, `details(url, html)`.
    """
    rows = html_pages.chart_rows(charts, ["feed", "source_ord"], run_date)
    first = rank.first_non_empty_source(rows, ["feed"], "source_ord", ["feed", "source_ord", "row_pos"])
    top = rank.cap_raw(first, n, ["feed"], ["source_ord", "row_pos"])
    detailed = enrich.enrich_details(
        top, html_pages.detail_pages(details), "page_url", ["feed", "source_ord", "row_pos"]
    )
    return html_pages.theatrical_items(
        detailed.withColumns({"page_ord": F.lit(0), "entry_ord": F.col("row_pos")})
    )


def gather(spark: SparkSession, sources: dict[str, FeedSource], config: dict) -> DataFrame:
    """Raw records of all sources of a feed; a source that raises while being set up is left out."""
    frames: dict[str, DataFrame | None] = {}
    for name, source in sources.items():
        try:
            frames[name] = source(spark, config)
        except Exception:  # noqa: BLE001 - one broken source must not stop the feed
            frames[name] = None
    return combine.union_sources(frames)


SOURCE_REPORT = "source string, source_ord long, status string, n_rows long, error string"


def land_sources(spark: SparkSession, sources: dict[str, FeedSource], config: dict, path: str) -> tuple[DataFrame, DataFrame]:
    """Raw records of all sources of a feed, each written by a job of its own, and the report of the run.

    A source that raises, while being set up or while running, is left out; the others stay. Of a source the rows of its
    folder below `path` count, which Spark marks when the job is complete, so the union never holds half a source. The
    report has a row per source in order: `status` is `ok` or `error`, `n_rows` what it delivered, counted while writing
    (null if it failed), `error` the first line of what went wrong. Running again replaces the folders.
    """
    frames: dict[str, DataFrame | None] = {}
    report = []
    for order, (name, source) in enumerate(sources.items()):
        folder = os.path.join(path, f"source={order:04d}")
        counted = Observation(f"source-{order}")
        try:
            rows = conform(source(spark, config))
            rows.observe(counted, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(folder)
            frames[name] = spark.read.schema(RAW_ITEM).parquet(folder)
            report.append((name, order, "ok", counted.get["n"], None))
        except Exception as broken:  # noqa: BLE001 - one broken source must not stop the feed
            frames[name] = None
            report.append((name, order, "error", None, (str(broken).splitlines() or [type(broken).__name__])[0]))
    return conform(combine.union_sources(frames)), spark.createDataFrame(report, SOURCE_REPORT)
