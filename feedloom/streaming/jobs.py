"""Continuous versions: first arrival per page, feed refresh, six-hour charts."""

from __future__ import annotations

import os

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from feedloom.functions.urls import with_page, with_signature
from feedloom.operators import dedupe, rank
from feedloom.operators.fingerprint import feed_fingerprint
from feedloom.operators.keyed import first_by, ranked_by
from feedloom.operators.normalize import published_form
from feedloom.schema import FEEDS, ORDER
from feedloom.session import is_folder
from feedloom.sources import published

RUN_EVERY = "6 hours"


def with_page_signature(items: DataFrame) -> DataFrame:
    """Add `signature`, the key of `stream_first_arrivals` for articles; NULL without a page."""
    df = with_page(items, article_url=("_ac", "_aok"))
    return with_signature(df, signature=F.when(F.col("_aok"), F.col("_ac"))).drop("_ac", "_aok")


def stream_first_arrivals(stream: DataFrame, time: str, keys: list[str], horizon: str) -> DataFrame:
    """First arrival per key; repeats within the horizon are dropped, state is forgotten after it.

    This is first *arrival*, not smallest order: a late row cannot replace one already sent.
    """
    timed = stream.withColumn(time, F.col(time).cast("timestamp"))
    return timed.withWatermark(time, horizon).dropDuplicatesWithinWatermark(keys)


def run_counts(stream: DataFrame, time: str, keys: list[str], every: str = RUN_EVERY) -> DataFrame:
    """Events per key and run bucket."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, every)
    return timed.groupBy(F.window(time, every).alias("run"), *keys).agg(F.count(F.lit(1)).alias("n"))


def write_updates(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Changed buckets of every micro-batch, one folder per batch: replaying a batch replaces it."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(path, f"batch={batch_id}"))

    return (
        counts.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(save)
        .start()
    )


def top_per_run(updates: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Latest count of each bucket, then the top `n` keys per run."""
    latest = first_by(updates, ["run", *keys], [F.col("batch").desc()])
    return ranked_by(latest, ["run"], [F.desc("n"), *keys], n, "rank")


def _batch_ids(spark: SparkSession, path: str) -> list[str]:
    """Folders `batch=<id>` below a path."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    return [s.getPath().getName() for s in fs.listStatus(root)]


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Folders of all batches, oldest first."""
    names = [n for n in _batch_ids(spark, path) if n.startswith("batch=")]
    return [os.path.join(path, n) for n in sorted(names, key=lambda n: int(n.split("=")[1]))]


def _last_before(spark: SparkSession, path: str, batch_id: int) -> str | None:
    """Folder of the batch before this one; batches without a folder are passed over."""
    for at in range(batch_id - 1, -1, -1):
        folder = os.path.join(path, f"batch={at}")
        if is_folder(spark, folder):
            return folder
    return None


def fresh_items(items: DataFrame, forget_after: int | None = None, time: str = "scraped_at", feeds=FEEDS) -> DataFrame:
    """Of a stream of normalised items, those whose feed and key were not seen before; within a batch the first in order.

    The signatures seen are keyed state of the stream: a batch reads and writes the state of its own keys only, however
    many batches there were, and a batch that is repeated after a failure starts from the state before it. With
    `forget_after`, seconds, a signature is dropped when the stream's `time` is so far past the row that brought it, and
    it may come again; a row without a time is kept for good.
    """
    key = F.concat_ws("|", "feed", "dedupe_key")
    keyed = dedupe.with_feed_key(items, feeds).withColumn("signature", key).drop("dedupe_key")
    order, timeout = list(ORDER), GroupStateTimeout.NoTimeout
    if forget_after is not None:
        keyed, timeout = keyed.withWatermark(time, "0 seconds"), GroupStateTimeout.EventTimeTimeout

    def pick(_, parts, state):
        if state.hasTimedOut:
            state.remove()
            return
        known, best = state.exists, None
        for part in parts:
            if not known and len(part):
                part = part if best is None else pd.concat([best, part])
                # Most keys come once; sorting a single row costs more than all else here.
                best = part if len(part) == 1 else part.sort_values(order, kind="stable", na_position="first").head(1)
        if known or best is None:
            return
        state.update((True,))
        if forget_after is not None and pd.notna(best[time].iloc[0]):
            until = int(best[time].iloc[0].timestamp() + forget_after) * 1000
            state.setTimeoutTimestamp(max(until, state.getCurrentWatermarkMs() + 1))
        yield best

    return keyed.groupBy("signature").applyInPandasWithState(pick, keyed.schema, "seen boolean", "append", timeout).drop("signature")


def merge_batch(
    spark: SparkSession, fresh: DataFrame, batch_id: int, path: str, run_at: str, feeds=FEEDS
) -> bool:
    """Merge the fresh items of a micro-batch into the feeds; returns whether they changed.

    The new feeds are the top rows of the previous feeds and the fresh items, which equals the top rows of everything
    seen. A batch reads its items and the capped feeds of the batch before. All folders carry the batch id: a repeated
    batch overwrites its own output.
    """
    feed_path = os.path.join(path, "feeds")
    previous = _last_before(spark, feed_path, batch_id)
    rows = fresh if previous is None else fresh.unionByName(spark.read.parquet(previous).drop("feed_pos"))
    target = os.path.join(feed_path, f"batch={batch_id}")
    rank.final_order_cap(rows, feeds=feeds).write.mode("overwrite").parquet(target)

    current = published_form(spark.read.parquet(target))
    meta = feed_fingerprint(current, ["feed_pos"], max_rows=rank.largest_cap(feeds))
    return published.write_meta(spark, meta, os.path.join(path, "meta"), f"batch-{batch_id}", run_at)


def stream_refresh_feeds(
    stream: DataFrame, to_items, path: str, checkpoint: str, run_at: str, feeds=FEEDS, forget_after: int | None = None
) -> StreamingQuery:
    """Refresh feeds from a stream; `to_items` turns its rows into normalised items, row by row."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch.sparkSession, batch, batch_id, path, run_at, feeds)

    return (
        fresh_items(to_items(stream), forget_after, feeds=feeds)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(merge)
        .start()
    )


def latest_feeds(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(_folders(spark, os.path.join(path, "feeds"))[-1])
