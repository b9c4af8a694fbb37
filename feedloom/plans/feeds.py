"""The feed job: raw records to published feeds, in a fixed order of steps."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators import combine, dedupe, enrich, gates, normalize, rank
from feedloom.operators.fingerprint import feed_fingerprint
from feedloom.operators.keyed import ranked_by
from feedloom.schema import FEEDS, ORDER, RAW_ITEM, conform, feed_registry
from feedloom.session import settle
from feedloom.sources import published

ROW_ID = ["feed", *ORDER]


@dataclass
class Lookups:
    """Landed tables the enrichment steps read."""

    pages: DataFrame  # url, html
    header_checks: DataFrame  # url, status, content_type, failed
    catalog: DataFrame  # search_key, search_type, image_path


@dataclass
class Fallback:
    """Rows for feeds that end up empty or thin: a RAW_ITEM table, and one row for other feeds."""

    rows: DataFrame
    default: dict = field(default_factory=dict)


def _enriched(items: DataFrame, lookups: Lookups, feeds) -> DataFrame:
    """Image checks and page pictures for article feeds, catalog pictures for all."""
    chart = gates.is_chart(feeds)
    charts = items.where(chart)
    articles = items.where(~chart)
    articles = settle(enrich.validate_images(articles, lookups.header_checks, ROW_ID), "checked")
    articles = enrich.enrich_from_pages(articles, lookups.pages, lookups.header_checks, ROW_ID)
    pictured = settle(articles.unionByName(charts), "pictured")
    return enrich.lookup_progressive(pictured, lookups.catalog, ROW_ID)


def process_items(
    raw: DataFrame, run_at: str, lookups: Lookups | None = None, feeds=FEEDS, catalog: DataFrame | None = None
) -> DataFrame:
    """Cap, normalise, gate, enrich, de-duplicate, order and cap.

    Without `lookups` the enrichment steps are left out, as for fallback rows, of which chart
    rows still get pictures from `catalog`. Every lookup
    reads its rows more than once, so the rows are written out before each of them.
    """
    items = rank.cap_raw(raw, feeds=feeds)
    items = normalize.normalize_items(items, run_at)
    items = gates.drop_reserved_titles(items, feeds)
    items = gates.topic_gate(items, feeds=feeds)
    items = gates.clean_image_columns(items)
    if lookups is not None:
        items = _enriched(settle(items, "gated"), lookups, feeds)
    elif catalog is not None:
        items = settle(items, "gated")
        chart = gates.is_chart(feeds)
        items = enrich.lookup_progressive(items.where(chart), catalog, ROW_ID).unionByName(items.where(~chart))
    items = normalize.finalize_links(items)
    items = gates.valid_page_gate(items, feeds)
    items = gates.quality_gate(items, feeds=feeds)
    items, _ = gates.schema_gate(items)
    items = dedupe.dedupe_feeds(items, feeds)
    return settle(rank.final_order_cap(items, feeds=feeds), "processed")


def _placed(items: DataFrame, source_ord: int) -> DataFrame:
    """Feed position as the order of rows that go through the last steps again."""
    return items.withColumns(
        {
            "source_ord": F.lit(source_ord).cast("long"),
            "page_ord": F.lit(0).cast("long"),
            "entry_ord": F.col("feed_pos").cast("long"),
        }
    )


def build_feeds(
    spark: SparkSession,
    raw: DataFrame,
    run_at: str,
    lookups: Lookups,
    fallback: Fallback,
    feeds=FEEDS,
) -> DataFrame:
    """All feeds of a run as one table with `feed`, `feed_pos` and the record columns."""
    registry = feed_registry(spark, feeds)
    items = _placed(process_items(conform(raw), run_at, lookups, feeds), 0)

    covered = combine.fallback_for(registry, fallback.rows, fallback.default)
    spare = _placed(process_items(conform(covered, RAW_ITEM), run_at, None, feeds, lookups.catalog), 1)
    # Every feed has its spare rows now, so no default is needed below.
    filled = settle(combine.fill_empty_feeds(items, registry, spare, {}), "filled")

    def finish(rows: DataFrame) -> DataFrame:
        return rank.final_order_cap(dedupe.dedupe_feeds(rows.drop("feed_pos"), feeds), feeds=feeds)

    boosted = combine.boost_low_feeds(filled, registry, spare, {}, finish, ROW_ID)
    unique = dedupe.drop_seen_in_earlier_feeds(boosted, ["feed_pos"], feeds)
    # Capped feeds: positions follow each other again.
    unique = ranked_by(unique, ["feed"], ["feed_pos"], rank.largest_cap(feeds), "_at")
    unique = unique.drop("feed_pos").withColumnRenamed("_at", "feed_pos")
    ordered = unique.drop(*[c for c in unique.columns if c in RAW_ITEM.names and c in ORDER + ["source"]])
    return normalize.published_form(ordered)


def publish_feeds(
    spark: SparkSession, feeds: DataFrame, path: str, run_id: str, run_at: str, registry=FEEDS
) -> bool:
    """Write the feeds of a run, then metadata if anything changed; returns whether it did.

    Metadata is computed from the written files, so the feed plan runs once and a lost
    executor costs no more than the step it was in.
    """
    target = os.path.join(path, "runs", run_id)
    published.write_feeds(feeds, target)
    written = published.read_feed_lines(spark, target)
    meta = feed_fingerprint(written, ["feed_pos"], max_rows=rank.largest_cap(registry))
    return published.write_meta(spark, meta, os.path.join(path, "meta"), run_id, run_at)


