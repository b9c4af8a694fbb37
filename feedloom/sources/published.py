"""Published feeds and their metadata on disk."""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom import vocab
from feedloom.functions.core import first_group
from feedloom.operators.fingerprint import detect_changes, next_version
from feedloom.operators.keyed import ranked_by
from feedloom.schema import FEED_ITEM, FEED_META, FEED_VERSION
from feedloom.session import settle


def read_feeds(spark: SparkSession, path: str) -> DataFrame:
    """Feed files holding one JSON array each: one row per item, with `feed` and `feed_pos`.

    The schema is fixed, because columns that are null throughout cannot be inferred. A file
    is one published feed (capped), so it fits one row; array positions keep the order.
    """
    text = spark.read.text(path, wholetext=True)
    items = F.from_json("value", T.ArrayType(FEED_ITEM))
    feed = F.url_decode(first_group(F.input_file_name(), r"([^/]+?)\.json$"))
    return text.select(feed.alias("feed"), F.posexplode(items).alias("_pos", "_item")).select(
        "feed", (F.col("_pos") + 1).alias("feed_pos"), "_item.*"
    )


def canonical_columns(df: DataFrame) -> list[str]:
    """Record columns in fixed order, then any others alphabetically."""
    known = [c for c in vocab.FEED_COLUMNS if c in df.columns]
    return known + sorted(c for c in df.columns if c not in known)


def write_feeds(feeds: DataFrame, path: str, order=("feed_pos",), mode: str = "overwrite") -> None:
    """Feeds as JSON lines, one folder per feed, in canonical column order.

    Rows are range-partitioned by feed and position, so a feed of any size is written by
    many tasks and its files still sort into feed order.
    """
    columns = canonical_columns(feeds.drop("feed", *order))
    (
        feeds.repartitionByRange("feed", *order)
        .sortWithinPartitions("feed", *order)
        .select("feed", *order, *columns)
        .write.mode(mode)
        .option("ignoreNullFields", "false")
        .option("encoding", "UTF-8")
        .partitionBy("feed")
        .json(path)
    )


def read_feed_lines(spark: SparkSession, path: str) -> DataFrame:
    """What `write_feeds` wrote."""
    fields = [T.StructField("feed", T.StringType()), T.StructField("feed_pos", T.IntegerType())]
    return spark.read.schema(T.StructType(fields + FEED_ITEM.fields)).json(path)


def write_feed_arrays(
    feeds: DataFrame, path: str, order=("feed_pos",), max_rows: int = 1000, mode: str = "overwrite"
) -> None:
    """Capped feeds as one JSON array per feed, the format `read_feeds` reads (below `feed=...`).

    A feed above `max_rows` is an error: an array has to be built in one place.
    """
    columns = canonical_columns(feeds.drop("feed", *order))
    body = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    placed = ranked_by(
        feeds.select("feed", *order, body.alias("_json")), ["feed"], list(order), max_rows + 1, "_pos"
    )
    grouped = placed.groupBy("feed").agg(
        F.count(F.lit(1)).alias("_n"), F.collect_list(F.struct("_pos", "_json")).alias("_rows")
    )
    too_long = F.raise_error(F.lit(f"feed has more than {max_rows} rows: use write_feeds"))
    array = F.concat(F.lit("["), F.array_join(F.sort_array("_rows")["_json"], ",\n"), F.lit("]"))
    (
        grouped.select(
            "feed", F.when(F.col("_n") > max_rows, too_long.cast("string")).otherwise(array).alias("value")
        )
        .write.mode(mode)
        .partitionBy("feed")
        .text(path)
    )


def read_feed_arrays(spark: SparkSession, path: str) -> DataFrame:
    """What `write_feed_arrays` wrote; `feed` comes from the folder names."""
    text = spark.read.text(path, wholetext=True)
    items = F.from_json("value", T.ArrayType(FEED_ITEM))
    return text.select("feed", F.posexplode(items).alias("_pos", "_item")).select(
        "feed", (F.col("_pos") + 1).alias("feed_pos"), "_item.*"
    )


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder on the cluster's file system."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _latest(spark: SparkSession, path: str) -> str | None:
    """Folder of the highest version whose tables are both complete."""
    versions = [name for name in _names(spark, path) if re.match(r"v\d{9}-", name)]
    for name in sorted(versions, reverse=True):
        base = os.path.join(path, name)
        if all(_exists(spark, os.path.join(base, t, "_SUCCESS")) for t in ("feed_meta", "feed_version")):
            return base
    return None


def read_meta(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Latest committed `feed_meta` and `feed_version`; empty before the first run."""
    base = _latest(spark, path)
    if base is None:
        return _empty(spark, FEED_META), _empty(spark, FEED_VERSION)
    return (
        spark.read.schema(FEED_META).parquet(os.path.join(base, "feed_meta")),
        spark.read.schema(FEED_VERSION).parquet(os.path.join(base, "feed_version")),
    )


def write_meta(spark: SparkSession, meta: DataFrame, path: str, run_id: str, run_at: str) -> bool:
    """Commit new metadata only if a hash or the set of feeds changed; returns whether it did.

    `meta` has one row per feed. The new tables go to a folder of their own, named after the
    version and the run; readers take the highest version that is complete, so they never see
    half a run, nothing committed is replaced, and a run that broke off can be repeated.
    """
    meta = settle(meta.select("feed", F.col("count").cast("long"), "hash"), "meta")
    old_meta, old_version = read_meta(spark, path)
    changes = detect_changes(old_meta, meta)
    version = next_version(changes, old_version, run_at)
    row = version.first()
    if not row["changed"] and not old_version.isEmpty():
        return False
    base = os.path.join(path, f"v{row['version']:09d}-{run_id}")
    meta.write.mode("overwrite").parquet(os.path.join(base, "feed_meta"))
    spark.createDataFrame([(row["version"], row["updated_at"])], FEED_VERSION).write.mode(
        "overwrite"
    ).parquet(os.path.join(base, "feed_version"))
    return True
