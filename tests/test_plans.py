"""The whole feed job on a hand-written run, and the shape of some plans."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from feedloom.plans import feeds as job
from feedloom.plans import sources as source_jobs
from feedloom.schema import RAW_ITEM, conform
from feedloom.session import work_dir
from feedloom.sources import published
from tests.test_queries import SF_DIR

RUN_AT = "2024-06-01 00:00:00"


def raw(spark, rows):
    columns = sorted({k for r in rows for k in r})
    data = [tuple(r.get(c) for c in columns) for r in rows]
    ints = {"source_ord", "page_ord", "entry_ord"}
    schema = ", ".join(f"{c} {'int' if c in ints else 'string'}" for c in columns)
    return conform(spark.createDataFrame(data, schema), RAW_ITEM)


def item(feed, n, title, link, **more):
    return {
        "feed": feed, "source_ord": 0, "page_ord": 0, "entry_ord": n, "title": title, "source_url": link,
        "overview": "A film.", "type": "movie", "platform": "cinema", **more,
    }


@pytest.fixture(scope="module")
def run(spark):
    rows = [
        item("trending", 1, "Great new film - Outlet", "https://o.example/2024/05/great", release_date="2024-05-01"),
        item("trending", 2, "Great film repeated", "http://o.example/2024/05/great?utm_source=x"),
        item("trending", 3, "Stock market news film", "https://o.example/2024/05/stock"),
        item("trending", 4, "Homepage of a film site", "https://o.example/"),
        item("trending", 5, "Another fine film", "https://o.example/2024/05/fine", release_date="2024-05-03"),
        item("upcoming", 1, "Great new film again", "https://o.example/2024/05/great/"),
        item("upcoming", 2, "Upcoming film one", "https://o.example/a/b/1"),
        item("upcoming", 3, "Upcoming film two", "https://o.example/a/b/2", poster_image_url="http://img.example/p.jpg"),
        item("netflix", 1, "Up", "https://l.example/x", type="series"),
        item("netflix", 2, "UP", "https://l.example/x", type="series"),
        item("netflix", 3, "It", "https://l.example/x", type="movie"),
    ]
    fallback = [
        item("hbo_max", 1, "Spare film", "https://f.example/a/b/c"),
        item("cinema_releases", 1, "Spare cinema film", "https://f.example/a/b/d"),
    ]
    pages = spark.createDataFrame(
        [("https://o.example/2024/05/fine", '<meta property="og:image" content="https://img.example/fine.jpg">')],
        "url string, html string",
    )
    checks = spark.createDataFrame([], "url string, status int, content_type string, failed boolean")
    catalog = spark.createDataFrame([("it", "movie", "/it.jpg")], "search_key string, search_type string, image_path string")
    default = {
        "source_ord": 0, "page_ord": 0, "entry_ord": 1, "title": "Demo film item", "source_url": "https://f.example/x/y/z",
        "overview": "Demo film.", "type": "movie",
    }
    built = job.build_feeds(
        spark, raw(spark, rows), RUN_AT, job.Lookups(pages, checks, catalog),
        job.Fallback(raw(spark, fallback), default),
    )
    return built.cache()


def test_feeds(run):
    got = {}
    for r in run.orderBy("feed", "feed_pos").collect():
        got.setdefault(r["feed"], []).append(r["title"])
    assert got == {
        "trending": ["Another fine film", "Great new film"],
        "upcoming": ["Upcoming film two", "Upcoming film one"],
        "netflix": ["Up", "It"],
        "disney_plus": ["Demo film item"],
        "prime_video": ["Demo film item"],
        "hbo_max": ["Spare film"],
        "cinema_releases": ["Spare cinema film"],
    }


def test_enrichment(run):
    by_title = {r["title"]: r for r in run.collect()}
    assert by_title["Another fine film"]["poster_image_url"] == "https://img.example/fine.jpg"
    assert by_title["Upcoming film two"]["backdrop_image_url"] == "https://img.example/p.jpg"
    assert by_title["It"]["poster_image_url"] == "https://image.tmdb.org/t/p/w500/it.jpg"
    fine = by_title["Another fine film"]
    assert (fine["release_date"], fine["published_at"]) == ("2024-05-03", "2024-05-03T00:00:00Z")
    assert (fine["source_name"], fine["source_domain"], fine["content_type"]) == ("Example", "o.example", "trending")


def test_publishing(spark, run):
    path = work_dir(spark, "publish-test")
    assert job.publish_feeds(spark, run, path, "run-1", RUN_AT)
    assert not job.publish_feeds(spark, run, path, "run-2", RUN_AT)
    meta, version = published.read_meta(spark, f"{path}/meta")
    assert version.first()["version"] == 1 and meta.count() == 7


def test_syndication_plan(spark):
    entries = spark.createDataFrame(
        [
            ("upcoming", 0, 1, "New film - Netflix news", "About a <b>film</b> &amp; more", "Fri, 07 Aug 2026 23:30:00 -0500",
             "https://news.google.com/rss/1", ["https://o.example/2026/08/a", "https://news.google.com/rss/1"]),
            ("upcoming", 0, 2, "NFL draft day", "", None, "https://o.example/2026/08/b", ["https://o.example/2026/08/b"]),
            ("upcoming", 1, 1, "A series", "anime season", None, "https://news.google.com/rss/3", ["https://news.google.com/rss/3"]),
        ],
        "feed string, source_ord int, entry_ord int, title string, summary string, published string, link string, candidate_urls array<string>",
    ).withColumn("media_url", F.lit(None).cast("string"))
    pages = spark.createDataFrame([], "url string, final_url string, html string")
    got = source_jobs.syndication_items(entries, pages, source_jobs.RULES["upcoming"], "multi_platform")
    rows = got.orderBy("source_ord", "entry_ord").collect()
    assert [(r["title"], r["type"], r["year"], r["article_url"], r["source_url"]) for r in rows] == [
        ("New film", "movie", "2026", "https://o.example/2026/08/a", "https://o.example/2026/08/a"),
        ("A series", "anime", None, None, "https://news.google.com/rss/3"),
    ]
    assert rows[0]["overview"] == "About a film & more"


def test_gather_isolates_failures(spark):
    def good(session, config):
        return session.createDataFrame([("x",)], "title string")

    def bad(session, config):
        raise OSError("gone")

    got = source_jobs.gather(spark, {"bad": bad, "good": good}, {})
    assert got.select("source", "source_ord").collect() == [("good", 1)]


def test_feed_job_over_pages(spark):
    feeds = {}
    for r in entry.queries()["feed_job"](spark, SF_DIR).orderBy("feed", "feed_pos").collect():
        feeds.setdefault(r["feed"], []).append(r)
    # The feed without rows of its own lives on the fallback table.
    assert set(feeds) == {"trending", "upcoming", "netflix", "disney_plus", "prime_video", "hbo_max", "cinema_releases"}
    for name, rows in feeds.items():
        assert [r["feed_pos"] for r in rows] == list(range(1, len(rows) + 1)) and len(rows) <= 20
        links = {r["article_url"] for r in rows}
        if name in ("netflix", "disney_plus", "prime_video"):
            # Chart rows share the URL of their list and are told apart by title, type and year.
            assert links == {f"https://lists.example/{name}"} and len(rows) > 1
        elif name != "hbo_max":
            assert len(links) == len(rows)
    later = {r["article_url"] for r in feeds["upcoming"]}
    assert not later & {r["article_url"] for r in feeds["trending"]}


def plan(spark, name):
    return entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_what_they_need(spark):
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in plan(spark, "raw_cap")
    assert "ReadSchema: struct<page_id:bigint,url:string>" in plan(spark, "url_canonical")
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,40.0)" in plan(spark, "first_non_empty_source")


def test_python_runs_only_where_registered(spark):
    for name in ("normalize_items", "article_dedupe", "topic_gate", "quality_gate", "image_gate", "date_parse"):
        assert "Python" not in plan(spark, name) and "ArrowEval" not in plan(spark, name)


def test_no_cartesian_products(spark):
    for name in entry.queries():
        if name.startswith(("stream_", "six_hour", "feed_", "meta_", "syndication_")):
            continue
        text = plan(spark, name)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def cells(*titles):
    return "<table><tr><th>x</th></tr>" + "".join(f"<tr><td>{t}</td><td>9</td></tr>" for t in titles) + "</table>"


def test_top_lists(spark):
    lists = spark.createDataFrame(
        [("a", "movie", "https://l/a", cells("1 One", "<b>2</b> ONE", "3 Two: Season 4", "", " ")), ("a", "series", "https://l/s", None),
         ("b", "movie", "https://l/b", cells()), (None, "movie", None, cells("Lost"))],
        "feed string, type string, list_url string, html string",
    )
    backups = spark.createDataFrame(
        [("a", "movie", cells("two", "Three", "Four")), ("c", "series", cells("Only"))], "feed string, type string, html string"
    )
    node = lambda kind, title, path: f'{{"node":{{"objectType":"{kind}","content":{{"title":"{title}","fullPath":"{path}"}}}}}}'
    replies = spark.createDataFrame(
        [("One", '{"edges":[' + node("SHOW", "One!", "/s") + "," + node("MOVIE", "One", "/m") + "]}"), ("Two", "{broken"), ("Only", None)],
        "title string, json string",
    )
    got = source_jobs.top_list_items(lists, backups, replies, "netflix", "L", 3).where("feed is not null")
    rows = sorted((r.feed, r.page_ord, r.entry_ord, r.title, r.article_url, r.overview) for r in got.collect())
    assert [(f, t) for f, _, _, t, _, _ in rows] == [("a", "One"), ("a", "Two"), ("a", "Three"), ("c", "Only")]
    assert rows[0][4].endswith("/m") and rows[1][4] == "https://l/a#2-movie" and rows[2][4] == "https://l/a#3-movie" and rows[3][4] is None
    assert rows[1][5] == "L Top 2 movie." and rows[3][5] == "L Top 1 series."
    empty = source_jobs.top_list_items(lists.limit(0), backups.limit(0), replies.limit(0), "netflix", "L")
    assert empty.count() == 0


def test_search_replies_make_the_catalog(spark):
    from feedloom.operators.enrich import catalog_from_replies

    image = lambda p: f'<img src="https://x/t/p/w94_and_h141_face/{p}.jpg"> <img src="/t/p/w500/zz.jpg">'
    rows = [("One", "tv", 200, image("b")), ("one", "tv", 200, image("a")), ("One", "movie", 200, "none"), ("Two", "tv", 404, image("c")),
            ("Three", "tv", None, image("c")), (None, "tv", 200, image("c")), ("Four", "tv", 200, None)]
    replies = spark.createDataFrame(rows, "phrase string, search_type string, status int, html string")
    assert [tuple(r) for r in catalog_from_replies(replies).collect()] == [("one", "tv", "/a.jpg")]
    assert catalog_from_replies(replies.limit(0)).count() == 0


def test_sources_that_fail_while_running_are_left_out(spark, tmp_path):
    def titles(*names):
        return lambda spark, config: spark.createDataFrame([(n,) for n in names], "title string")

    def breaks(spark, config):
        return titles("x", "y")(spark, config).withColumn("title", F.when(F.col("title") == "y", F.raise_error(F.lit("bad page"))).otherwise("x"))

    corrupt = tmp_path / "landed"
    corrupt.mkdir()
    (corrupt / "part.parquet").write_bytes(b"PAR1 not a table PAR1")
    sources = {
        "one": titles("a", "b"), "breaks": breaks, "corrupt": lambda s, c: s.read.schema("title string").parquet(str(corrupt)),
        "none": titles(), "setting": lambda s, c: c["missing"], "two": titles("c"),
    }
    for _ in range(2):
        raw, report = source_jobs.land_sources(spark, sources, {}, str(tmp_path / "run"))
        found = {r.source: (r.status, r.n_rows, r.error is None) for r in report.collect()}
        assert found == {"one": ("ok", 2, True), "breaks": ("error", None, False), "corrupt": ("error", None, False),
                         "none": ("ok", 0, True), "setting": ("error", None, False), "two": ("ok", 1, True)}
        assert sorted((r.source, r.source_ord, r.title) for r in raw.collect()) == [("one", 0, "a"), ("one", 0, "b"), ("two", 5, "c")]
    raw, report = source_jobs.land_sources(spark, {"only": breaks}, {}, str(tmp_path / "other"))
    assert raw.count() == 0 and raw.columns == RAW_ITEM.names and report.count() == 1


def test_published_arrays_are_read_in_order(spark, tmp_path):
    (tmp_path / "a feed.json").write_text('[{"title": "b", "rating": 7.5, "genres": ["x"]},\n{"title": "a", "year": 1999, "extra": 1}]')
    (tmp_path / "none.json").write_text("[]")
    (tmp_path / "broken.json").write_text("[{")
    rows = published.read_feeds(spark, str(tmp_path)).where("title is not null").orderBy("feed", "feed_pos").collect()
    assert [(r.feed, r.feed_pos, r.title, r.rating, r.year) for r in rows] == [("a feed", 1, "b", 7.5, None), ("a feed", 2, "a", None, 1999)]
