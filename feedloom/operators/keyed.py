"""Keyed building blocks: first rows per key, positions, and lookups that survive hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.functions.core import col
from feedloom.session import settle

#: Rows of one key that one task joins; a key with more rows gets as many salts as it needs.
ROWS_PER_TASK = 1_000_000
#: Partitions for rows without a key.
SALTS = 32


def first_by(df: DataFrame, keys: list, order: list, n: int = 1) -> DataFrame:
    """The first `n` rows per key in the given order.

    The comparison with a constant lets Spark plan a group limit, so every input
    partition sends at most `n` rows per key, however hot the key is.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def ranked_by(df: DataFrame, keys: list, order: list, n: int, name: str = "rank") -> DataFrame:
    """Like `first_by`, keeping the position as a column."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)


def enumerate_positions(
    df: DataFrame, keys: list[str], order: list, bucket: Column | None = None, name: str = "rank"
) -> DataFrame:
    """1-based position of every row in its list, for lists of any length and any order columns.

    Rows are numbered within (list, bucket) and shifted by the size of the earlier buckets, so a long list is
    spread over many tasks; only one row per bucket is summed up along the list. Without `bucket` the rows are
    written once in ranges of (list, order): Spark cuts the ranges at splitters from a sample of the rows, so
    strings and skewed numbers spread as well as dense ids do. A given `bucket` must never decrease along the
    order and saves that step. Rows that tie in the whole order share a range and are numbered in any order.
    """
    if bucket is None:
        ranged = df.repartitionByRange(*keys, *order).withColumn("_bucket", F.spark_partition_id())
        df = settle(ranged, "ranges")
    else:
        df = df.withColumn("_bucket", bucket)
    # One column that is never NULL, in which NULL keys are equal: the window and the join share one shuffle.
    df = df.withColumn("_list", F.struct(*keys) if keys else F.lit(0))
    within = Window.partitionBy("_list", "_bucket").orderBy(*order)
    along = Window.partitionBy("_list").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy("_list", "_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_list", "_bucket", F.coalesce(F.sum("_rows").over(along), F.lit(0)).alias("_before"))
    )
    numbered = df.withColumn("_within", F.row_number().over(within))
    position = (F.col("_within") + F.col("_before")).cast("long")
    return (
        numbered.join(offsets, ["_list", "_bucket"])
        .withColumn(name, position)
        .drop("_list", "_bucket", "_within", "_before")
    )


def key_counts(rows: DataFrame, on: list[str]) -> DataFrame:
    """Distinct non-null keys with their number of rows in `_rows`.

    The filter keeps the count in the plan, so that every use of the result shares one shuffle.
    """
    counted = rows.dropna(subset=on).groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    return counted.where("_rows > 0")


def salts_of(counts: DataFrame, on: list[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Number of salts of every key that fills more than one task: rows divided by `rows_per_task`."""
    salts = F.ceil(F.col("_rows") / rows_per_task).cast("int").alias("_salts")
    return counts.select(*on, salts).where("_salts > 1")


def lookup(
    rows: DataFrame,
    table: DataFrame,
    on: list[str],
    spread_by: list,
    *,
    how: str = "left",
    counts: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    salts: int = SALTS,
) -> DataFrame:
    """Join rows to a table with at most one row per key.

    The rows of a key are spread over as many salts as their counted number needs, rows without a key over
    `salts`, by a hash of `spread_by` (columns that identify the row, so a retried task spreads them the same
    way); only the table rows of spread keys are repeated. There is at most one spread key per task's worth of
    rows, and Spark broadcasts their list only below its own size limit. `counts` takes the `key_counts` of the
    rows where they exist already.
    """
    counts = key_counts(rows, on) if counts is None else counts
    spread = salts_of(counts, on, rows_per_task)
    missing = F.lit(False)
    for k in on:
        missing = missing | F.col(k).isNull()
    row_hash = F.xxhash64(*[col(c) for c in spread_by])
    many = F.when(missing, salts).otherwise(F.coalesce("_salts", F.lit(1)))
    left = rows.join(spread, on, "left").withColumn("_salt", F.pmod(row_hash, many).cast("int")).drop("_salts")
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    right = table.join(spread, on, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    return left.join(right, [*on, "_salt"], how).drop("_salt")
