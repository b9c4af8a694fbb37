"""Registry limits, character references, broken items, escaped documents and chart keys in the stream."""

import os
import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from tests.check import TESTDATA

import __spark_entry__ as entry
from feedloom import vocab
from feedloom.bindings import QUERIES
from feedloom.functions import html, text, urls
from feedloom.operators import combine, gates, rank
from feedloom.plans import sources as source_jobs
from feedloom.schema import RAW_ITEM, conform
from feedloom.session import work_dir
from feedloom.sources import documents, pages, syndication

FEEDS = (("big", 0, "discovery", 30, 100, False, True),)


def raw(spark, rows):
    return conform(spark.createDataFrame(rows, "feed string, source_ord int, page_ord int, entry_ord int, title string, source_url string"))


def test_caps_come_from_the_registry(spark):
    rows = raw(spark, [(f, 0, 0, k, "t", "u") for f in ("big", "other") for k in range(120)])
    sizes = {r["feed"]: r["count"] for r in rank.cap_raw(rows, feeds=FEEDS).groupBy("feed").count().collect()}
    assert sizes == {"big": 100, "other": 20}
    sizes = {r["feed"]: r["count"] for r in rank.final_order_cap(rows, feeds=FEEDS).groupBy("feed").count().collect()}
    assert sizes == {"big": 100, "other": 20}


def test_shortest_title_comes_from_the_registry(spark):
    rows = raw(spark, [("big", 0, 0, 0, "x" * 29, "u"), ("big", 0, 0, 1, "x" * 30, "u"), ("other", 0, 0, 2, "x" * 8, "u")])
    assert {len(r.title) for r in gates.drop_reserved_titles(rows, FEEDS).collect()} == {30, 8}


def test_all_sources_failed(spark):
    assert combine.union_sources({"a": None}).schema == RAW_ITEM


def test_character_references(values):
    texts = ["Caf&eacute; &#8217;Tis &ndash; &#x27;x&apos; &hellip;", "a &amp;lt; b", "&nosuch; & &#0; &#x1F600;", "plain", "&nbsp;x&#160;y", None]
    texts += ["it&#146;s &nbsp x &#0;", "AT&ampT &copy2024 &notit; &#x80 &#65 &#xD800;", "a&b=1&c", "&hellip &eacute"]
    assert values(texts, html.text_of) == [
        "Café ’Tis – 'x' …", "a &lt; b", "&nosuch; & \ufffd 😀", "plain", "x y", None,
        "it’s x \ufffd", "AT&T ©2024 ¬it; € A \ufffd", "a&b=1&c", "&hellip é",
    ]


def test_control_characters_of_a_query_stay(values):
    got = values(["https://a.example/x?a=p%01q&b=2", "https://a.example/x?c=%02&utm_source=1", "https://a.example/x?a=1&b=x=y"], urls.canonical_url)
    assert got == ["https://a.example/x?a=p%01q&b=2", "https://a.example/x?c=%02", "https://a.example/x?a=1&b=x%3Dy"]


def test_escaped_slash_is_found(spark):
    docs = spark.createDataFrame([(1, r'{"_type":"a\/b"}'), (2, '{"_type":"c"}')], "id int, t string")
    assert [r.id for r in documents.find_nodes(docs, ["id"], "t", "_type", "a/b").collect()] == [1]


def test_rows_of_all_tables(spark):
    page = "<table><tr><td>a</td></tr></table><p>x</p><table><tr><td>b</td></tr></table>"
    got = pages.extract_rows(spark.createDataFrame([(1, page)], "id int, html string"), ["id"]).orderBy("row_pos").collect()
    assert [r.cells for r in got] == [["a"], ["b"]]


def test_items_are_numbered_and_broken_ones_counted(spark):
    path = work_dir(spark, "rss")
    item = "<item><title>{}</title><link>http://x/{}</link></item>"
    spark.createDataFrame([("\n".join(item.format(k, k) for k in range(5)),)], "v string").coalesce(1).write.text(os.path.join(path, "a"))
    bad = item.format(1, 1) + "\n<item><title>x</titl></item>\n" + item.format(2, 2)
    spark.createDataFrame([(bad,)], "v string").coalesce(1).write.text(os.path.join(path, "b"))
    entries = syndication.read_syndication(spark, f"{path}/*")
    assert sorted(r.entry_ord for r in entries.where(F.col("file").contains("/a/")).collect()) == [1, 2, 3, 4, 5]
    assert entries.where(F.col("file").contains("/b/")).count() == 2
    assert syndication.broken_items(spark, f"{path}/*").agg(F.sum("n_broken")).first()[0] == 1


def test_items_are_numbered_over_small_splits(spark):
    """A file cut into many splits keeps its order; Atom entries are read too."""
    path = work_dir(spark, "rss")
    item = "<item><title>{}</title><guid>{}</guid></item>"
    atom = (
        '<entry><title type="text">A &amp; b</title><link rel="enclosure" type="image/png" href="https://i.example/p.png"/>'
        '<link href="https://e.example/1"/><id>e1</id><published>2024-05-06T00:00:00Z</published><content>long</content>'
        '<source><title>s</title><link href="https://s.example/"/></source></entry>'
    )
    rows = "\n".join(item.format(k, k) for k in range(400))
    spark.createDataFrame([(f"<rss>{rows}</rss>",)], "v string").coalesce(1).write.text(os.path.join(path, "a"))
    spark.createDataFrame([(f"<feed>{atom}{atom.replace('e1', 'e2')}</feed>",)], "v string").coalesce(1).write.text(os.path.join(path, "b"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        items = syndication.read_items(spark, f"{path}/*")
        got = {(r.file[-30:], r.guid): r.entry_ord for r in items.collect()}
        blocks = syndication._records(spark, f"{path}/a", "item", syndication.ITEM).select("_block").distinct().count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert blocks > 3
    assert {int(g): n for (_, g), n in got.items() if g[0] != "e"} == {k: k + 1 for k in range(400)}
    assert {g: n for (_, g), n in got.items() if g[0] == "e"} == {"e1": 1, "e2": 2}
    entry = syndication.read_syndication(spark, f"{path}/b").where("id = 'e1'").first()
    assert (entry.title, entry.summary, entry.link, entry.source_href) == ("A & b", "long", "https://e.example/1", "https://s.example/")
    assert entry.candidate_urls == ["https://e.example/1", "https://i.example/p.png", "https://s.example/"]
    assert entry.media_url == "https://i.example/p.png"


def test_rules_from_a_table_equal_given_ones(spark):
    texts = ["a trailer for x", "release date of y", "Trailer x release", "podcast trailer", ""]
    rules = {
        "p": {"signals": ["Trailer"], "exclude": ["podcast"]},
        "q": {"include": ["y"], "trusted": ["good.example"], "extra_signals": ["release"]},
        "r": {},
    }
    table = source_jobs.feed_rules(spark, rules, dict.fromkeys(rules, "multi_platform"))
    rows = [(f, t.lower(), u) for f in rules for t in texts for u in ("https://good.example/a", "", None)]
    df = spark.createDataFrame(rows, "feed string, merged string, url string").join(table, "feed")
    lists = F.struct(*source_jobs.RULE_LISTS)
    one = F.lit(False)
    for feed, given in rules.items():
        one = F.when(F.col("feed") == feed, text.relevance_match("merged", F.col("url"), **given)).otherwise(one)
    got = df.select(text.relevance_by_rules("merged", F.col("url"), lists).alias("a"), one.alias("b")).collect()
    assert all(r.a == r.b for r in got) and {r.a for r in got} == {True, False}


def cleaned_title(title):
    out = title
    for pattern in (vocab.SEARCH_TRAILING_NOISE, vocab.SEARCH_SEASON, vocab.SEARCH_SUFFIXES, vocab.SEARCH_PREFIXES):
        out = re.sub(pattern, "", out, flags=re.I)
    return re.sub(r"[:\-–—|]+\s*$", "", re.sub(r"\s+", " ", out).strip()).strip() or title.strip()


def candidates(doc_id, body):
    plain = re.sub(r"\s+", " ", (body or "").split("\n")[0].split(".")[0]).strip()
    title = (f"{plain} - Netflix announces more", f"Watch {plain} season 12", f"{plain} Official Trailer drops", f"Everyone is in ‘{plain} ’ today")[doc_id % 4]
    quoted, clean = re.search(vocab.QUOTED_TITLE, title), cleaned_title(title)
    core = quoted[1].strip() if quoted else clean
    words = (core or clean).split()
    out = [core, clean, " ".join(words[:4]) if len(words) > 4 else "", " ".join(words[:3]) if len(words) > 6 else ""]
    return [c for n, c in enumerate(out) if c.strip() and c.lower().strip() not in [o.lower().strip() for o in out[:n]]]


NOISY = [
    "", None, "Top 'Scary Movie' here", "Dune: Part Two - what we know", "Watch the men in black | Hulu", "“It” gets a new trailer", "Is it", "Here's what is new: Every show",
    "First look at a very long headline of many words", "Where will Dune go – and why", "\"A\" and 'Bcd' show", "12 shows coming in 2024 by x", "season 3", "Announces every", "- : |",
]


def test_search_candidates_of_every_document(spark):
    rows = [(4 * n + k, t) for n, t in enumerate(NOISY) for k in range(4)]
    got = QUERIES["search_candidates"](SimpleNamespace(documents=spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    assert {r.doc_id: r.candidates for r in got} == {i: candidates(i, t) for i, t in rows}


def test_search_candidates_of_the_given_documents(spark):
    folder = os.path.join(TESTDATA, "sf0.001")
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    got = {r.doc_id: r.candidates for r in entry.queries()["search_candidates"](spark, folder).collect()}
    assert got == {r.doc_id: candidates(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
