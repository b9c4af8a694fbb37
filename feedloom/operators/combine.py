"""Putting sources together: unions, top-ups and fallbacks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.keyed import first_by, lookup, ranked_by
from feedloom.schema import RAW_ITEM


def union_sources(frames: dict[str, DataFrame | None]) -> DataFrame:
    """All sources of a feed in priority order, tagged with `source` and `source_ord`.

    A source that failed (None) contributes nothing; missing columns become NULL. If all
    failed, the result is an empty table of raw records.
    """
    tagged = [
        df.withColumns({"source": F.lit(name), "source_ord": F.lit(i)})
        for i, (name, df) in enumerate(frames.items())
        if df is not None
    ]
    if not tagged:
        return SparkSession.active().createDataFrame([], RAW_ITEM)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def top_up(
    primary: DataFrame, backup: DataFrame, n: int, by: list[str], title: str, order: list
) -> DataFrame:
    """Fill each list up to `n` with backup titles it does not have, in backup order.

    Titles compare in lower case. A list that needs filling holds fewer than `n` titles, so
    the first `2n` distinct backup titles always suffice.
    """
    columns = [*by, title, *order]
    own = ranked_by(primary.select(*columns), by, order, n, "position").withColumn(
        "from_backup", F.lit(False)
    )
    spare = first_by(backup.select(*columns), [*by, F.lower(title)], order)
    spare = first_by(spare, by, order, 2 * n).withColumn("from_backup", F.lit(True))
    both = own.drop("position").unionByName(spare)
    # The list's own rows come first, so a backup title it has is dropped here.
    fresh = both.withColumn("_title", F.lower(title))
    backup_new = fresh.where("from_backup").join(
        fresh.where(~F.col("from_backup")).select(*by, "_title"), [*by, "_title"], "left_anti"
    )
    merged = fresh.where(~F.col("from_backup")).unionByName(backup_new.select(*fresh.columns))
    return ranked_by(merged.drop("_title"), by, ["from_backup", *order], n, "position")


def feed_counts(items: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows per registered feed, including feeds without rows."""
    counts = items.groupBy("feed").agg(F.count(F.lit(1)).alias("n_rows"))
    return registry.select("feed").join(counts, "feed", "left").fillna(0, ["n_rows"])


def fallback_for(feeds: DataFrame, fallback: DataFrame, default: dict) -> DataFrame:
    """Fallback rows of the given feeds; a feed the table does not cover gets one default row.

    `default` holds the values of that row by column name.
    """
    covered = fallback.select("feed").distinct().withColumn("_covered", F.lit(True))
    marked = feeds.select("feed").join(covered, "feed", "left")
    own = fallback.join(marked.where("_covered").select("feed"), "feed", "left_semi")
    rest = marked.where("_covered is null").select(
        "feed", *[F.lit(value).alias(name) for name, value in default.items()]
    )
    return own.unionByName(rest, allowMissingColumns=True)


def fill_empty_feeds(
    items: DataFrame, registry: DataFrame, fallback: DataFrame, default: dict
) -> DataFrame:
    """Feeds without any row get their (processed) fallback rows."""
    empty = feed_counts(items, registry).where("n_rows = 0")
    return items.unionByName(fallback_for(empty, fallback, default), allowMissingColumns=True)


def boost_low_feeds(
    items: DataFrame,
    registry: DataFrame,
    fallback: DataFrame,
    default: dict,
    reprocess,
    spread_by: list,
    minimum: int = 2,
) -> DataFrame:
    """Feeds with fewer than `minimum` rows: their rows plus fallback, processed again.

    `reprocess` de-duplicates, sorts and caps; the rows of other feeds pass untouched.
    """
    low = feed_counts(items, registry).where(F.col("n_rows") < minimum).select("feed")
    marked = lookup(items, low.withColumn("_low", F.lit(True)), ["feed"], spread_by)
    fine = marked.where("_low is null").drop("_low")
    thin = marked.where("_low").drop("_low")
    boosted = reprocess(
        thin.unionByName(fallback_for(low, fallback, default), allowMissingColumns=True)
    )
    return fine.unionByName(boosted, allowMissingColumns=True)
