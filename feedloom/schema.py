"""Record types and the feed registry table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from feedloom import vocab

RAW_ITEM = T.StructType(
    [
        T.StructField("feed", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("source_ord", T.LongType()),
        T.StructField("page_ord", T.LongType()),
        T.StructField("entry_ord", T.LongType()),
    ]
    + [
        T.StructField(name, T.ArrayType(T.StringType()) if name == "genres" else T.StringType())
        for name in (
            "title",
            "year",
            "type",
            "platform",
            "release_date",
            "published_raw",
            "published_at_hint",
            "overview",
            "genres",
            "poster_image_url",
            "backdrop_image_url",
            "rating",
            "trailer_url",
            "source_url",
            "article_url",
            "content_type",
        )
    ]
)

ORDER = ["source_ord", "page_ord", "entry_ord"]

_SPECIAL = {"year": T.IntegerType(), "genres": T.ArrayType(T.StringType()), "rating": T.DoubleType()}

FEED_ITEM = T.StructType(
    [T.StructField(name, _SPECIAL.get(name, T.StringType())) for name in vocab.FEED_COLUMNS]
)

FEED_META = T.StructType(
    [
        T.StructField("feed", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("hash", T.StringType()),
    ]
)

FEED_VERSION = T.StructType(
    [T.StructField("version", T.IntegerType()), T.StructField("updated_at", T.StringType())]
)

# feed, position, kind, shortest title kept, rows kept, page URL required,
# takes part in the cross-feed URL check
FEEDS = (
    ("trending", 0, "discovery", 8, vocab.FEED_CAP, True, True),
    ("upcoming", 1, "discovery", 8, vocab.FEED_CAP, False, True),
    ("netflix", 2, "chart", 2, vocab.FEED_CAP, False, False),
    ("disney_plus", 3, "chart", 2, vocab.FEED_CAP, False, False),
    ("prime_video", 4, "chart", 2, vocab.FEED_CAP, False, False),
    ("hbo_max", 5, "chart", 2, vocab.FEED_CAP, False, False),
    ("cinema_releases", 6, "cinema", 8, vocab.FEED_CAP, True, False),
)
FEEDS_TYPE = (
    "feed string, feed_ord int, kind string, min_title int, cap int, "
    "needs_page boolean, once_per_url boolean"
)


def feed_registry(spark: SparkSession, rows=FEEDS) -> DataFrame:
    """The feeds as a table: one row per feed."""
    return spark.createDataFrame(list(rows), FEEDS_TYPE)


def conform(df: DataFrame, schema: T.StructType = RAW_ITEM) -> DataFrame:
    """Select the columns of `schema` in order, cast, with NULL for missing ones."""
    from pyspark.sql import functions as F

    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
