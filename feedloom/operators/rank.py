"""Limits, chart ranks and source order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom import vocab
from feedloom.functions.core import col
from feedloom.operators.gates import is_chart, per_feed
from feedloom.operators.keyed import first_by, lookup, ranked_by
from feedloom.schema import FEEDS, ORDER


def largest_cap(feeds) -> int:
    return max([vocab.FEED_CAP, *(row[4] for row in feeds)])


def cap_raw(raw: DataFrame, n: int | None = None, by=("feed",), order=ORDER, feeds=FEEDS) -> DataFrame:
    """First rows per feed in source order, before any gate: `n`, or as many as the registry says.

    The comparison with the largest cap is a group limit before the shuffle, that with the feed's own follows.
    """
    if n is not None or "feed" not in raw.columns:
        return first_by(raw, list(by), list(order), n or vocab.FEED_CAP)
    first = ranked_by(raw, list(by), list(order), largest_cap(feeds), "_at")
    return first.where(F.col("_at") <= per_feed("cap", vocab.FEED_CAP, feeds)).drop("_at")


def final_order_cap(
    items: DataFrame, n: int | None = None, order=ORDER, feeds=FEEDS, by=("feed",)
) -> DataFrame:
    """Newest release first, then title descending, then source order; charts keep source order.

    Keeps `n` rows, or as many as the registry says. Adds `feed_pos`, the 1-based position in the feed.
    """
    chart = is_chart(feeds)
    keys = [
        F.when(~chart, F.col("release_date")).desc_nulls_last(),
        F.when(~chart, F.col("title")).desc_nulls_last(),
        *order,
    ]
    if n is not None:
        return ranked_by(items, list(by), keys, n, "feed_pos")
    first = ranked_by(items, list(by), keys, largest_cap(feeds), "feed_pos")
    return first.where(F.col("feed_pos") <= per_feed("cap", vocab.FEED_CAP, feeds))


def rank_chart(
    entries: DataFrame,
    by: list,
    type_ord: str,
    order: list,
    n: int = vocab.TOP_PER_TYPE,
    title: str = "title",
) -> DataFrame:
    """Rank per chart and type over titles not seen before in the chart.

    A title counts where it occurs first (types in `type_ord` order); empty titles never
    count; ranks restart per type.
    """
    named = entries.withColumn("_title", F.lower(F.trim(title))).where("_title <> ''")
    fresh = first_by(named, [*by, "_title"], [type_ord, *order]).drop("_title")
    return ranked_by(fresh, [*by, type_ord], order, n, "rank")


#: How far a source is ever read, and entries looked at for each missing row.
SCAN_LIMIT = 400
SCAN_STEP = 25


def scan_budget_size(need: Column) -> Column:
    """How many entries of a source are looked at to find `need` relevant ones."""
    return F.least(F.lit(SCAN_LIMIT), F.greatest(need * SCAN_STEP, need + 20))


def scan_budget(
    entries: DataFrame, relevant: Column, n: int, by: list, pos: str
) -> DataFrame:
    """First `n` relevant entries among the first entries the budget allows (`pos` is 1-based)."""
    window_size = min(SCAN_LIMIT, max(n * SCAN_STEP, n + 20))
    scanned = entries.where(F.col(pos) <= window_size).where(relevant)
    return first_by(scanned, by, [pos], n)


def cascade_sources(entries: DataFrame, n: int, by: list, source_ord: str, pos: list) -> DataFrame:
    """Sources in order, each giving what is still missing, until `n` rows are there."""
    return first_by(entries, by, [source_ord, *pos], n)


def cascade_with_budget(
    entries: DataFrame, relevant: Column, n: int, by: list[str], source_ord: str, pos: str
) -> DataFrame:
    """`cascade_sources` where each source is scanned only as far as its open need allows.

    The budget of a source depends on what earlier sources gave, so the need is folded over
    the sources of a feed. A source contributes at most `SCAN_LIMIT` positions to the fold. One whose
    first hit lies in the k-th step of the scan gives a row whenever k rows are missing, so of
    each k only the first `n` sources can count; the fold sees no more than those.
    """
    near = entries.where(F.col(pos) <= SCAN_LIMIT).where(relevant)
    per_source = near.groupBy(*by, source_ord).agg(
        F.collect_list(pos).alias("_hits"), F.ceil(F.min(pos) / SCAN_STEP).alias("_step")
    )
    per_feed = first_by(per_source, [*by, "_step"], [source_ord], n).groupBy(*by).agg(
        F.sort_array(F.collect_list(F.struct(F.col(source_ord).alias("s"), "_hits"))).alias("_all")
    )

    def step(state, source):
        need = state["need"]
        limit = scan_budget_size(need)
        within = F.slice(F.sort_array(F.filter(source["_hits"], lambda p: p <= limit)), F.lit(1), need)
        return F.struct(
            (need - F.size(within)).alias("need"),
            F.concat(
                state["taken"],
                F.transform(within, lambda p: F.struct(source["s"].alias("s"), p.alias("p"))),
            ).alias("taken"),
        )

    kinds = dict(entries.dtypes)
    start = F.struct(
        F.lit(n).alias("need"),
        F.array().cast(f"array<struct<s:{kinds[source_ord]},p:{kinds[pos]}>>").alias("taken"),
    )
    taken = F.aggregate("_all", start, step, lambda s: s["taken"])
    chosen = per_feed.select(*by, F.explode(taken).alias("_t")).select(
        *by, F.col("_t.s").alias(source_ord), F.col("_t.p").alias(pos)
    )
    return near.join(chosen, [*by, source_ord, pos], "left_semi")


def first_non_empty_source(
    entries: DataFrame, by: list[str], source_ord: str, spread_by: list
) -> DataFrame:
    """Only the rows of the first source that has any, per feed."""
    first = entries.groupBy(*by).agg(F.min(source_ord).alias("_first"))
    return (
        lookup(entries, first, by, spread_by, how="inner")
        .where(F.col(source_ord) == F.col("_first"))
        .drop("_first")
    )


def paged_take(
    entries: DataFrame, by: list, page: str, total: Column | str, order: list, n: int, max_pages: int = 5
) -> DataFrame:
    """Pages 1 to `max_pages` (fewer where the source has fewer) until `n` rows are there.

    Pages are read whole: a page is read if fewer than `n` rows came before it, and the
    result is cut to `n` afterwards, which is the same as the first `n` rows.
    """
    pages = entries.where(F.col(page) <= F.least(col(total), F.lit(max_pages)))
    return first_by(pages, by, [page, *order], n)
