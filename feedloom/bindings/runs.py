"""Queries that go through files or streams: round trips, the full feed job, continuous jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.bindings import pages as page_queries
from feedloom.bindings import sql as q
from feedloom.bindings.registry import query
from feedloom.functions import dates, text
from feedloom.operators import enrich, fingerprint, gates, keyed, normalize
from feedloom.plans import feeds as feed_plan
from feedloom.plans import sources as source_jobs
from feedloom.schema import ORDER
from feedloom.session import is_folder, settle, work_dir
from feedloom.sources import published, syndication
from feedloom.streaming import jobs

RUN_AT = "2024-06-01 00:00:00"


def _with_order(df):
    return df.withColumns(
        {
            "source_ord": F.lit(0).cast("long"),
            "page_ord": F.lit(0).cast("long"),
            "entry_ord": F.col("page_id").cast("long"),
        }
    )


def _feed_items(t):
    """Every page as a normalised record in its feed, with its position."""
    placed = keyed.enumerate_positions(
        page_queries.raw_items(t), ["feed"], ["page_id"], F.floor(F.col("page_id") / 1_000_000), "feed_pos"
    )
    items = normalize.normalize_items(placed, RUN_AT)
    return normalize.published_form(items.drop("page_id"))


_FEED_ROWS = (
    page_queries.RAW_CTE
    + """SELECT feed, row_number() OVER (PARTITION BY feed ORDER BY page_id) AS feed_pos, title, type, overview, article_url,
      CASE WHEN page_id % 2 = 0 THEN 3 ELSE 0 END AS n_genres, page_id % 3 = 0 AS unrated FROM m"""
)


def _summary(df):
    return df.select(
        "feed",
        F.col("feed_pos").cast("long").alias("feed_pos"),
        "title",
        "type",
        "overview",
        "article_url",
        F.size("genres").alias("n_genres"),
        F.col("rating").isNull().alias("unrated"),
    )


@query("feed_files", _FEED_ROWS)
def feed_files(t):
    """Feeds of any size written as JSON lines per feed and read back."""
    path = work_dir(t.spark, "feeds")
    published.write_feeds(_feed_items(t), path)
    return _summary(published.read_feed_lines(t.spark, path))


@query("feed_arrays", "SELECT * FROM (" + _FEED_ROWS + ") WHERE feed_pos <= 20")
def feed_arrays(t):
    """Feeds capped at 20 rows written as one JSON array per feed and read back."""
    path = work_dir(t.spark, "arrays")
    published.write_feed_arrays(_feed_items(t).where("feed_pos <= 20"), path)
    return _summary(published.read_feed_arrays(t.spark, path))


@query(
    "meta_versions",
    """WITH h AS (SELECT lang, (SELECT count(*) FROM documents d WHERE d.lang = l.lang) AS n FROM (SELECT DISTINCT lang FROM documents) l)
    SELECT lang AS feed, CAST(n AS BIGINT) AS count, 3 AS version, '2024-01-04T00:00:00Z' AS updated_at FROM h WHERE lang <> 'de'""",
)
def meta_versions(t):
    """Metadata written for four runs: first, unchanged, one feed changed, one feed removed."""
    path = work_dir(t.spark, "meta")
    docs = t.documents.select(F.col("lang").alias("feed"), "doc_id", "n_chars")
    runs = [docs, docs, docs.withColumn("n_chars", F.col("n_chars") + 1), docs.where("lang <> 'de'")]
    for day, rows in enumerate(runs, start=1):
        meta = fingerprint.large_feed_fingerprint(rows, ["feed"])
        published.write_meta(t.spark, meta, path, f"run-{day}", f"2024-01-0{day}T00:00:00Z")
    meta, version = published.read_meta(t.spark, path)
    stamp = version.first()
    return meta.select(
        "feed", "count", F.lit(stamp["version"]).alias("version"), F.lit(stamp["updated_at"]).alias("updated_at")
    )


def _escaped(c):
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(c, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


@query(
    "syndication_files",
    rf"""WITH x AS (SELECT doc_id, source, regexp_replace(text, '[\x00-\x08\x0b\x0c\x0e-\x1f]', '', 'g') AS text FROM documents),
    d AS (SELECT doc_id, source, {q.squeeze("split_part(text, chr(10), 1)")} AS title, {q.squeeze('text')} AS overview FROM x)
    SELECT doc_id, title, overview, '2024-05-06' AS release_date, '2024-05-07T04:30:00Z' AS published_at,
      'https://x.example/a/' || doc_id || '|https://id.example/' || doc_id || '|https://news.google.com/rss/' || doc_id
        || '|https://' || source || '.example/' AS candidates,
      'https://i.example/' || doc_id || '.jpg' AS media_url FROM d""",
)
def syndication_files(t):
    """Documents written as RSS items and read by the XML source."""
    # XML cannot carry control characters.
    docs = t.documents.withColumn("text", F.regexp_replace("text", r"[\x00-\x08\x0b\x0c\x0e-\x1f]", ""))
    key = F.col("doc_id").cast("string")
    # The summary is HTML inside XML, so its text is escaped twice.
    summary = F.concat(
        F.lit('<a href="//x.example/a/'), key, F.lit('">x</a> '), _escaped("text"),
        F.lit('<img class="c" src="//i.example/'), key, F.lit('.jpg"/>'),
    )
    summary = F.regexp_replace(summary, ">x</a> ", "></a> ")
    item = F.concat(
        F.lit("<item><title>"), _escaped(F.split_part("text", F.lit("\n"), F.lit(1))),
        F.lit("</title><link>https://news.google.com/rss/"), key,
        F.lit('</link><guid isPermaLink="false">https://id.example/'), key,
        F.lit("</guid><pubDate>Mon, 06 May 2024 23:30:00 -0500</pubDate><description>"), _escaped(summary),
        F.lit('</description><source url="https://'), "source", F.lit('.example/">'), "source",
        F.lit("</source></item>"),
    )
    path = work_dir(t.spark, "syndication")
    docs.select(item.alias("value")).write.text(path)
    entries = syndication.entry_texts(syndication.read_syndication(t.spark, path))
    return entries.select(
        F.regexp_extract("id", r"(\d+)$", 1).cast("long").alias("doc_id"),
        text.squeeze("title").alias("title"),
        "overview",
        dates.parse_release_date("published").cast("string").alias("release_date"),
        dates.iso_z(dates.parse_published("published")).alias("published_at"),
        F.array_join("candidate_urls", "|").alias("candidates"),
        "media_url",
    )


JOB_RULES = {"alpha": {"signals": ["thsh", "Rere"], "exclude": ["ndnd"]}, "beta": {"include": ["erer", "on the"], "trusted": ["/7"]}}
JOB_ROWS = 300


@query(
    "syndication_job",
    rf"""WITH x AS (SELECT doc_id, doc_id // 25 AS source_ord, doc_id % 25 + 1 AS entry_ord, regexp_replace(text, '[\x00-\x08\x0b\x0c\x0e-\x1f]', '', 'g') AS text
      FROM documents),
    d AS (SELECT *, CASE WHEN source_ord % 2 = 0 THEN 'alpha' ELSE 'beta' END AS feed, {q.squeeze('text')} AS overview,
      'https://variety.com/2024/film/news/some-story-' || doc_id || '/' AS url,
      lower({q.squeeze("split_part(text, chr(10), 1)")} || ' ' || {q.squeeze('text')}) AS merged FROM x),
    k AS (SELECT *, row_number() OVER (PARTITION BY feed ORDER BY source_ord, entry_ord) AS rn FROM d WHERE
      (feed = 'alpha' AND (contains(merged, 'thsh') OR contains(merged, 'rere')) AND NOT contains(merged, 'ndnd'))
      OR (feed = 'beta' AND (contains(merged, 'erer') OR contains(merged, 'on the') OR contains(url, '/7'))))
    SELECT feed, source_ord, entry_ord, CASE feed WHEN 'alpha' THEN 'cinema' ELSE 'multi_platform' END AS platform, overview,
      url AS article_url, 'Mon, 06 May 2024 23:30:00 -0500' AS published_raw, 'https://i.example/' || doc_id || '.jpg' AS poster_image_url
    FROM k WHERE rn <= {JOB_ROWS}""",
)
def syndication_job(t):
    """Documents landed as RSS and Atom files, by the file-to-source table and the word lists of two feeds to raw records."""
    key = F.col("doc_id").cast("string")
    docs = t.documents.withColumns(
        {
            "text": F.regexp_replace("text", r"[\x00-\x08\x0b\x0c\x0e-\x1f]", ""),
            "batch": F.floor(F.col("doc_id") / 25),
            "_url": F.concat(F.lit("https://variety.com/2024/film/news/some-story-"), key, F.lit("/")),
            "_image": F.concat(F.lit("https://i.example/"), key, F.lit(".jpg")),
        }
    )
    title = _escaped(F.split_part("text", F.lit("\n"), F.lit(1)))
    # The summary is HTML inside XML, so its text is escaped twice.
    summary = _escaped(_escaped(F.col("text")))
    item = F.concat(
        F.lit("<item><title>"), title, F.lit("</title><link>"), "_url", F.lit('</link><guid isPermaLink="false">'), key,
        F.lit("</guid><pubDate>Mon, 06 May 2024 23:30:00 -0500</pubDate><description>"), summary,
        F.lit('</description><enclosure type="image/jpeg" url="'), "_image", F.lit('"/></item>'),
    )
    entry = F.concat(
        F.lit('<entry><title type="text">'), title, F.lit('</title><link rel="enclosure" type="image/jpeg" href="'), "_image",
        F.lit('"/><link href="'), "_url", F.lit('"/><id>'), key, F.lit("</id><published>Mon, 06 May 2024 23:30:00 -0500</published><summary>"),
        summary, F.lit("</summary></entry>"),
    )
    path = work_dir(t.spark, "landed")
    landed = docs.select("batch", "doc_id", F.when(F.col("batch") % 3 == 2, entry).otherwise(item).alias("value"))
    ordered = landed.repartition("batch").sortWithinPartitions("batch", "doc_id").select("batch", "value")
    ordered.write.partitionBy("batch").text(path)
    feed = F.when(F.col("batch") % 2 == 0, "alpha").otherwise("beta")
    files = docs.select("batch").distinct().select(
        F.col("batch").cast("string").alias("name"), feed.alias("feed"), F.col("batch").alias("source_ord")
    )
    rules = source_jobs.feed_rules(t.spark, JOB_RULES, {"alpha": "cinema", "beta": "multi_platform"})
    pages = t.pages.select("url", F.col("url").alias("final_url"), "html")
    name = F.regexp_extract("file", r"/batch=([^/]+)/", 1)
    raw = source_jobs.syndication_job(t.spark, path, files, rules, pages, JOB_ROWS, name)
    return raw.select("feed", "source_ord", "entry_ord", "platform", "overview", "article_url", "published_raw", "poster_image_url")


@query(
    "landed_sources",
    """SELECT 'pages' AS source, 0 AS source_ord, 'ok' AS status, count(*) AS n_rows, count(*) AS n_read FROM pages
    UNION ALL SELECT 'missing', 1, 'error', NULL, 0
    UNION ALL SELECT 'documents', 2, 'ok', count(*), count(*) FROM documents
    UNION ALL SELECT 'unset', 3, 'error', NULL, 0
    UNION ALL SELECT 'films', 4, 'ok', count(*), count(*) FROM part WHERE p_size > 100""",
)
def landed_sources(t):
    """Sources landed one by one: two with rows, one whose folder is missing, one without its setting, one that finds nothing."""
    titled = {
        "pages": lambda spark, config: t.pages.select(F.col("url").alias("title"), F.col("page_id").alias("entry_ord")),
        "missing": lambda spark, config: spark.read.parquet(work_dir(spark, "nothing")),
        "documents": lambda spark, config: t.documents.select(F.split_part("text", F.lit("\n"), F.lit(1)).alias("title")),
        "unset": lambda spark, config: t.pages.where(config["rule"]),
        "films": lambda spark, config: t.part.where("p_size > 100").select(F.col("p_name").alias("title")),
    }
    raw, report = source_jobs.land_sources(t.spark, titled, {}, work_dir(t.spark, "landing"))
    read = raw.groupBy("source").agg(F.count(F.lit(1)).alias("n_read"))
    return report.join(read, "source", "left").fillna(0, ["n_read"]).select("source", "source_ord", "status", "n_rows", "n_read")


# --- streams ----------------------------------------------------------------------------


def _stream(t, name: str):
    """A given table as a file stream, be it one file or a folder of files."""
    reader = t.spark.readStream.schema(getattr(t, name).schema)
    path = f"{t.root}/{name}.parquet"
    if is_folder(t.spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(t.root)


@query("stream_first_arrivals", "SELECT DISTINCT event_type, user_id FROM events")
def stream_first_arrivals(t):
    """First arrival per (type, user) within a horizon longer than the data."""
    path, checkpoint = work_dir(t.spark, "arrivals"), work_dir(t.spark, "arrivals-checkpoint")
    first = jobs.stream_first_arrivals(_stream(t, "events"), "ts", ["event_type", "user_id"], "60 days")
    run = (
        first.select("event_type", "user_id")
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .format("parquet")
        .start(path)
    )
    run.awaitTermination()
    return t.spark.read.schema("event_type string, user_id long").parquet(path)


@query(
    "six_hour_charts",
    """WITH c AS (SELECT time_bucket(INTERVAL 6 HOUR, ts) AS run, event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2, 3),
    r AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY n DESC, event_type, user_id) AS rank FROM c)
    SELECT strftime(run, '%Y-%m-%d %H') AS run, event_type, user_id, n, rank FROM r WHERE rank <= 3""",
)
def six_hour_charts(t):
    path, checkpoint = work_dir(t.spark, "charts"), work_dir(t.spark, "charts-checkpoint")
    counts = jobs.run_counts(_stream(t, "events"), "ts", ["event_type", "user_id"])
    jobs.write_updates(counts, path, checkpoint).awaitTermination()
    top = jobs.top_per_run(t.spark.read.parquet(path), ["event_type", "user_id"], 3)
    return top.select(
        F.date_format("run.start", "yyyy-MM-dd HH").alias("run"), "event_type", "user_id", "n", "rank"
    )


_REFRESHED = (
    page_queries.RAW_CTE
    + f""", k AS (SELECT *, CASE WHEN page_id % 5 < 4 THEN strftime(day, '%Y-%m-%d') END AS release_date,
        {q.signature('article_url')} AS sig,
        coalesce(CASE WHEN page_id % 3 = 2 THEN '19' || lpad(CAST(page_id % 100 AS VARCHAR), 2, '0')
          ELSE nullif(regexp_extract(raw_title, '(19|20)[0-9][0-9]'), '') END, '') AS year FROM m),
    d AS (SELECT *, row_number() OVER (PARTITION BY feed,
        CASE WHEN feed IN ('netflix', 'disney_plus', 'prime_video', 'hbo_max') THEN concat_ws('|', lower(trim(title)), type, year) ELSE sig END ORDER BY page_id) AS rn FROM k),
    r AS (SELECT feed, page_id AS entry_ord, title, row_number() OVER (PARTITION BY feed ORDER BY
        CASE WHEN feed IN ('netflix', 'disney_plus', 'prime_video', 'hbo_max') THEN NULL ELSE release_date END DESC NULLS LAST,
        CASE WHEN feed IN ('netflix', 'disney_plus', 'prime_video', 'hbo_max') THEN NULL ELSE title END DESC NULLS LAST, page_id) AS feed_pos
      FROM d WHERE rn = 1)
    SELECT feed, CAST(entry_ord AS BIGINT) AS entry_ord, title, feed_pos FROM r WHERE feed_pos <= 20"""
)


@query("stream_refresh", _REFRESHED)
def stream_refresh(t):
    """Pages arriving in two batches in page order, merged into feeds; equals one batch over all."""
    spark = t.spark
    source, target = work_dir(spark, "arriving"), work_dir(spark, "refreshed")
    checkpoint = work_dir(spark, "refreshed-checkpoint")
    middle = F.lit(t.pages.agg(F.percentile_approx("page_id", 0.5)).first()[0])

    class Arrived:
        def __init__(self, pages):
            self.pages = pages

    def to_items(batch):
        return normalize.normalize_items(_with_order(page_queries.raw_items(Arrived(batch))), RUN_AT)

    # Of rows with one key the first arrival stays, so later pages must not overtake earlier ones.
    for part in (F.col("page_id") <= middle, F.col("page_id") > middle):
        t.pages.where(part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(t.pages.schema).parquet(source)
        jobs.stream_refresh_feeds(stream, to_items, target, checkpoint, "2024-06-01T00:00:00Z").awaitTermination()
    return jobs.latest_feeds(spark, target).select("feed", "entry_ord", "title", "feed_pos")


# --- the feed job -----------------------------------------------------------------------

#: A feed without rows of its own: it lives on the fallback table.
EMPTY_FEED = "hbo_max"


def _built_feeds(t):
    """All pages as raw records of a run; chart rows share the URL of their list, one feed is empty."""
    named = _with_order(page_queries.raw_items(t))
    own = [name for name in page_queries.FEED_NAMES if name != EMPTY_FEED]
    placed = F.element_at(F.array(*[F.lit(x) for x in own]), (F.pmod("page_id", F.lit(len(own))) + 1).cast("int"))
    raw = named.withColumn("feed", placed)
    chart = gates.is_chart(feed_plan.FEEDS)
    raw = raw.withColumns(
        {
            "source_url": F.when(chart, F.concat(F.lit("https://lists.example/"), "feed")).otherwise(F.col("source_url")),
            "article_url": F.when(~chart, F.col("article_url")),
        }
    )
    replies = named.where("title <> ''").groupBy(F.lower("title").alias("phrase")).agg(F.min("page_id").alias("p"))
    catalog = enrich.catalog_from_replies(
        replies.select(
            "phrase", F.lit("movie").alias("search_type"), F.lit(200).alias("status"),
            F.concat(F.lit('<img src="/t/p/w94_and_h141_bestv2/p'), "p", F.lit('.jpg">')).alias("html"),
        )
    )
    lookups = feed_plan.Lookups(t.pages.select("url", "html"), page_queries._header_checks(t), catalog)
    # The fallback table covers every feed, the empty one included.
    return feed_plan.build_feeds(t.spark, raw, RUN_AT, lookups, feed_plan.Fallback(named))


@query("feed_job")
def feed_job(t):
    """The whole job from raw records to ordered feeds."""
    return _built_feeds(t).select(
        "feed", F.col("feed_pos").cast("long").alias("feed_pos"), "title", "type", "article_url", "poster_image_url"
    )


@query("feed_job_published")
def feed_job_published(t):
    """The job published twice: the second run changes nothing, so the version stays."""
    path = work_dir(t.spark, "job")
    built = settle(_built_feeds(t), "built")
    for day in (1, 2):
        feed_plan.publish_feeds(t.spark, built, path, f"run-{day}", f"2024-06-0{day}T00:00:00Z")
    meta, version = published.read_meta(t.spark, f"{path}/meta")
    stamp = version.first()
    return meta.select(
        "feed", "count", F.lit(stamp["version"]).alias("version"), F.lit(stamp["updated_at"]).alias("updated_at")
    )
