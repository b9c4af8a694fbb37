"""Feed hashes, change detection and counts per source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom import vocab
from feedloom.operators.keyed import ranked_by

STAMPS = ("scraped_at", "updated_at")
HASH_SLICE = 15


def canonical_json(columns, exclude=()) -> Column:
    """Compact JSON of a row with sorted keys and explicit nulls."""
    names = sorted(c for c in columns if c not in exclude)
    return F.to_json(F.struct(*names), {"ignoreNullFields": "false"})


def feed_fingerprint(
    feeds: DataFrame,
    order: list,
    by: str = "feed",
    columns=vocab.FEED_COLUMNS,
    exclude=STAMPS,
    max_rows: int = 1000,
) -> DataFrame:
    """Count and SHA-256 of each feed as one JSON array in feed order.

    For capped feeds: a feed above `max_rows` is an error, never cut, because an ordered hash
    needs the whole feed in one place. Use `large_feed_fingerprint` for uncapped tables.
    `exclude=()` hashes the run stamps too.
    """
    rows = feeds.select(by, *order, canonical_json(columns, exclude).alias("_json"))
    placed = ranked_by(rows, [by], order, max_rows + 1, "_pos")
    grouped = placed.groupBy(by).agg(
        F.count(F.lit(1)).alias("count"), F.collect_list(F.struct("_pos", "_json")).alias("_rows")
    )
    body = F.array_join(F.sort_array("_rows")["_json"], ",")
    digest = F.sha2(F.concat(F.lit("["), body, F.lit("]")), 256)
    too_long = F.raise_error(F.lit(f"feed has more than {max_rows} rows: use large_feed_fingerprint"))
    return grouped.select(
        by,
        "count",
        F.when(F.col("count") > max_rows, too_long.cast("string")).otherwise(digest).alias("hash"),
    )


def large_feed_fingerprint(df: DataFrame, by: list, columns=None, exclude=()) -> DataFrame:
    """Count and order-insensitive hash of each group, for groups of any size.

    The leading hex digits of each row's SHA-256 are added up as exact decimals, so the sum
    is combined on the map side and does not depend on row order or partitioning.
    """
    names = columns or [c for c in df.columns if c not in by]
    part = F.conv(F.left(F.sha2(canonical_json(names, exclude), 256), F.lit(HASH_SLICE)), 16, 10)
    return df.select(*by, part.cast("decimal(28,0)").alias("_part")).groupBy(*by).agg(
        F.count(F.lit(1)).alias("count"), F.sum("_part").cast("string").alias("hash")
    )


def detect_changes(previous: DataFrame, current: DataFrame, by: list[str] | str = "feed") -> DataFrame:
    """Old and new hash side by side per feed; `changed` also for added and removed feeds."""
    by = [by] if isinstance(by, str) else by
    old = previous.select(*by, F.col("hash").alias("old_hash"))
    new = current.select(*by, F.col("hash").alias("new_hash"), "count")
    return old.join(new, by, "full_outer").withColumn(
        "changed", ~F.col("old_hash").eqNullSafe(F.col("new_hash"))
    )


def next_version(changes: DataFrame, previous_version: DataFrame, run_at: str) -> DataFrame:
    """One row `version, updated_at, changed`: one higher if anything changed, else kept (at least 1)."""
    c = F.col
    facts = changes.select("changed").unionByName(
        previous_version.select("version", "updated_at"), allowMissingColumns=True
    )
    summed = facts.agg(
        F.coalesce(F.bool_or("changed"), F.lit(False)).alias("changed"),
        F.coalesce(F.max("version"), F.lit(0)).alias("_version"),
        F.max("updated_at").alias("_updated_at"),
    )
    kept = F.greatest(c("_version"), F.lit(1))
    return summed.select(
        F.when(c("changed"), c("_version") + 1).otherwise(kept).alias("version"),
        F.when(c("changed"), F.lit(run_at))
        .otherwise(F.coalesce("_updated_at", F.lit(run_at)))
        .alias("updated_at"),
        "changed",
    )


def source_stats(
    raw: DataFrame, media_types=("movie", "series", "documentary", "anime"), by=("feed", "source"), type_col: str = "type"
) -> DataFrame:
    """Rows per source in total and per media type."""
    return raw.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(type_col) == t).alias(f"n_{t}") for t in media_types],
    )


def failed_sources(stats: DataFrame, expected: DataFrame, by=("feed", "source")) -> DataFrame:
    """Expected sources that delivered nothing."""
    return expected.select(*by).join(stats.select(*by), list(by), "left_anti")
