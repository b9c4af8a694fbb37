"""Table jobs on small frames, against brute force."""

import hashlib
import json
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from feedloom.operators import combine, dedupe, enrich, fingerprint, gates, keyed, rank
from feedloom.schema import FEED_META
from feedloom.session import work_dir
from feedloom.sources import documents, published
from feedloom.streaming import jobs


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_spreads_hot_and_missing_keys(spark):
    rows = spark.range(1000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.col("id").cast("string")).alias("k"),
    )
    table = spark.createDataFrame([("hot", 1), ("1", 2), ("500", 3), ("unused", 4)], "k string, v int")
    plain = {(r["id"], r["v"]) for r in rows.join(table, "k", "left").collect()}
    salted = keyed.lookup(rows, table, ["k"], ["id"], rows_per_task=5, salts=8)
    got = salted.collect()
    assert len(got) == 1000 and {(r["id"], r["v"]) for r in got} == plain
    inner = keyed.lookup(rows, table, ["k"], ["id"], how="inner", rows_per_task=5, salts=8)
    assert inner.count() == rows.join(table, "k").count()


def test_hot_rows_go_to_several_partitions(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(4000).select("id", F.lit("hot").alias("k"))
        table = spark.createDataFrame([("hot", 1)], "k string, v int")
        joined = keyed.lookup(rows, table, ["k"], ["id"], rows_per_task=5, salts=32)
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(sizes) > 4 and max(r["count"] for r in sizes) < 2000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_positions_equal_row_number(spark):
    df = spark.range(500).select(
        F.col("id").alias("o"), F.when(F.col("id") % 3 == 0, None).otherwise("a").alias("k")
    )
    got = keyed.enumerate_positions(df, ["k"], ["o"], F.floor(F.col("o") / 17)).collect()
    want = df.withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy("o"))).collect()
    assert {(r["k"], r["o"], r["rank"]) for r in got} == {(r["k"], r["o"], r["rank"]) for r in want}


def test_positions_in_sampled_ranges(spark):
    """A hot list in order of skewed strings, NULLs among keys and order, falling order."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        i = F.col("id")
        key = F.when(i % 10 == 0, F.concat(F.lit("k"), i % 3)).when(i % 10 == 1, None).otherwise("hot")
        text = F.when(i % 50 == 3, None).otherwise(F.concat(F.lit("a" * 12), F.sha1(i.cast("string"))))
        df = spark.range(4_000).select(i, key.alias("k"), text.alias("o"))
        order = [F.desc_nulls_first("o"), "id"]
        got = keyed.enumerate_positions(df, ["k"], order)
        want = df.withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy(*order)))
        assert sorted(map(tuple, got.select("id", "rank").collect())) == sorted(map(tuple, want.select("id", "rank").collect()))
        plain = keyed.enumerate_positions(df.select("id"), [], ["id"]).collect()
        assert all(r["id"] + 1 == r["rank"] for r in plain)
        hot = keyed.enumerate_positions(df, ["k"], order).where("k = 'hot'")
        sizes = [r["count"] for r in hot.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) > 3 and max(sizes) < 2_000
        assert keyed.enumerate_positions(df.limit(0), ["k"], order).count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_first_by_limits_before_the_shuffle(spark):
    df = spark.range(100).select("id", (F.col("id") % 5).alias("k"))
    plan = plan_of(keyed.first_by(df, ["k"], ["id"]))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_dedupe_does_not_depend_on_partitioning(spark):
    rows = [
        (i, "f", f"Title {i % 7}", None, "movie", f"https://h.example/a/{i % 5}?utm_source={i}", None) for i in range(60)
    ]
    df = spark.createDataFrame(
        rows, "o int, feed string, title string, year int, type string, source_url string, article_url string"
    )
    results = [
        sorted(r["o"] for r in dedupe.dedupe_articles(df.repartition(n), order=["o"]).collect()) for n in (1, 3, 8)
    ]
    assert results[0] == [0, 1, 2, 3, 4] and results.count(results[0]) == 3


def test_cascade_with_budget_equals_a_loop(spark):
    def loop(sources, n):
        taken, need = [], n
        for s, hits in sources:
            budget = min(400, max(25 * need, need + 20))
            got = [p for p in hits if p <= budget][:need]
            taken += [(s, p) for p in got]
            need -= len(got)
        return taken

    rows, want = [], {}
    for feed in range(6):
        sources = [(s, [p for p in range(1, 500) if (p * (s + 3) + feed) % (11 + 9 * s) == 0]) for s in range(4)]
        # Many sources whose only hit lies far down.
        sources += [(s, [(37 * s + feed) % 420 + 1]) for s in range(4, 60) if feed % 2]
        want[feed] = set(loop(sources, 5 + 7 * feed))
        rows += [(feed, s, p, p in hits) for s, hits in sources for p in (range(1, 500) if s < 4 else hits)]
    df = spark.createDataFrame(rows, "feed int, s int, p int, hit boolean")
    for feed in range(6):
        part = df.where(F.col("feed") == feed)
        got = rank.cascade_with_budget(part, F.col("hit"), 5 + 7 * feed, ["feed"], "s", "p").collect()
        assert {(r["s"], r["p"]) for r in got} == want[feed]


def test_fingerprint_is_the_hash_of_sorted_compact_json(spark):
    items = [{"b": "é/\"x", "a": None, "n": i, "g": ["x", "y"]} for i in range(5)]
    df = spark.createDataFrame(
        [("f", i, d["b"], d["a"], d["n"], d["g"]) for i, d in enumerate(items)],
        "feed string, pos int, b string, a string, n int, g array<string>",
    ).repartition(4)
    want = hashlib.sha256(
        json.dumps(items, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()
    ).hexdigest()
    row = fingerprint.feed_fingerprint(df, ["pos"], columns=("n", "b", "a", "g"), exclude=()).first()
    assert (row["count"], row["hash"]) == (5, want)
    with pytest.raises(Exception, match="more than 3 rows"):
        fingerprint.feed_fingerprint(df, ["pos"], columns=("n",), exclude=(), max_rows=3).collect()


def test_large_fingerprint_ignores_order_and_partitions(spark):
    df = spark.range(1000).select("id", (F.col("id") % 2).alias("k"))
    a = fingerprint.large_feed_fingerprint(df.repartition(7), ["k"]).orderBy("k").collect()
    b = fingerprint.large_feed_fingerprint(df.orderBy(F.desc("id")).coalesce(1), ["k"]).orderBy("k").collect()
    assert a == b
    changed = df.withColumn("id", F.when(F.col("id") == 5, 6).otherwise(F.col("id")))
    assert fingerprint.large_feed_fingerprint(changed, ["k"]).orderBy("k").collect()[1] != a[1]


def test_meta_is_written_only_on_change(spark):
    path = work_dir(spark, "meta-test")

    def meta(*rows):
        return spark.createDataFrame(list(rows), FEED_META)

    assert published.write_meta(spark, meta(("a", 1, "x")), path, "r1", "t1")
    assert not published.write_meta(spark, meta(("a", 1, "x")), path, "r2", "t2")
    assert published.write_meta(spark, meta(("a", 1, "y")), path, "r3", "t3")
    assert published.write_meta(spark, meta(("a", 1, "y"), ("b", 0, "z")), path, "r4", "t4")
    assert published.write_meta(spark, meta(("b", 0, "z")), path, "r5", "t5")
    feeds, version = published.read_meta(spark, path)
    assert version.collect() == [(4, "t5")] and feeds.collect() == [("b", 0, "z")]
    # A run that broke off between its two tables is not seen, and the next one takes its number.
    meta(("c", 9, "w")).write.parquet(f"{path}/v000000005-broken/feed_meta")
    feeds, version = published.read_meta(spark, path)
    assert version.collect() == [(4, "t5")] and feeds.collect() == [("b", 0, "z")]
    assert published.write_meta(spark, meta(("b", 1, "y")), path, "a6", "t6")
    feeds, version = published.read_meta(spark, path)
    assert version.collect() == [(5, "t6")] and feeds.collect() == [("b", 1, "y")]


def test_union_skips_failed_sources(spark):
    a = spark.createDataFrame([(1, "x")], "k int, t string")
    b = spark.createDataFrame([(2,)], "k int")
    got = combine.union_sources({"a": a, "bad": None, "b": b}).orderBy("source_ord").collect()
    assert [(r["source"], r["source_ord"], r["k"], r["t"]) for r in got] == [("a", 0, 1, "x"), ("b", 2, 2, None)]


def test_schema_gate_needs_all_columns(spark):
    with pytest.raises(ValueError, match="missing columns"):
        gates.schema_gate(spark.createDataFrame([("x",)], "title string"))


def test_unchecked_images_pass_only_if_named_like_one(spark):
    items = spark.createDataFrame(
        [(1, "http://a.example/x.jpg"), (2, "https://a.example/x"), (3, "https://cdn.a.example/x"), (4, None)],
        "id int, image string",
    )
    checks = spark.createDataFrame([], "url string, status int, content_type string, failed boolean")
    got = enrich.validate_images(items, checks, ["id"], ("image",)).orderBy("id").collect()
    assert [r["image"] for r in got] == ["https://a.example/x.jpg", None, "https://cdn.a.example/x", None]


def test_nodes_at_any_depth(spark):
    deep = '{"_type":"C","n":1}'
    for _ in range(60):
        deep = '{"x":[' + deep + "]}"
    docs = spark.createDataFrame(
        [(1, deep), (2, '{"b":{"_type":"C","n":"first"},"a":{"_type":"C"}}'), (3, '{"_type":"C"'), (4, '{"s":"{\\"_type\\":\\"C\\"}"}')],
        "id int, doc string",
    )
    got = documents.find_nodes(docs, ["id"], "doc", "_type", "C").orderBy("id", "path").collect()
    assert [r["id"] for r in got] == [1, 2, 2]
    assert [json.loads(r["json"]).get("n") for r in got] == [1, "first", None]


def _nodes_of(text, key, value):
    """Brute force: path and object, in reading order."""
    try:
        pending, found = [((), json.loads(text))], []
    except ValueError:
        return []
    while pending:
        path, node = pending.pop()
        if isinstance(node, dict) and node.get(key) == value:
            found.append((path, node))
        inside = list(node.values()) if isinstance(node, dict) else node if isinstance(node, list) else []
        pending += [((*path, i), inside[i]) for i in reversed(range(len(inside)))]
    return found


def test_json_trees_equal_brute_force(spark):
    import random

    rng = random.Random(3)

    def tree(depth):
        kind = rng.random()
        if depth == 0 or kind < 0.25:
            return rng.choice(["C", "", " x ", 1, None, True, 2.5, '{"_type":"C","id":"no"}', "[1]", "é\\ \"q"])
        if kind < 0.6:
            names = rng.sample(["_type", "b", "a", "id", "pic", "z y", "é"], rng.randint(0, 5))
            return {n: "C" if n == "_type" and rng.random() < 0.6 else tree(depth - 1) for n in names}
        return [tree(depth - 1) for _ in range(rng.randint(0, 4))]

    texts = [json.dumps(tree(7), ensure_ascii=rng.random() < 0.5) for _ in range(150)] + ["", "[", "null", '{"a":{"_type":"C"},']
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(999, None, "x")], "id int, doc string, _path string")
    got = documents.find_nodes(docs, ["id"], "doc", "_type", "C").collect()
    want = [(i, list(path), node) for i, t in enumerate(texts) for path, node in _nodes_of(t, "_type", "C")]
    order = lambda r: (r[0], r[1])
    assert sorted(((r["id"], r["path"], json.loads(r["json"])) for r in got), key=order) == sorted(want, key=order)

    def first(node):
        if isinstance(node, dict):
            for k, v in node.items():
                if k in ("id", "pic") and isinstance(v, str) and v.strip():
                    return v.strip()
                if (found := first(v)) is not None:
                    return found
        for v in node if isinstance(node, list) else []:
            if (found := first(v)) is not None:
                return found

    firsts = {i: first(json.loads(t)) for i, t in enumerate(texts[:150])}
    got = documents.first_values(docs, ["id"], "doc", ["id", "pic"]).collect()
    assert {r["id"]: r["value"] for r in got} == {i: v for i, v in firsts.items() if v is not None}
    plan = documents.find_nodes(docs, ["id"], "doc", "_type", "C")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def _feed_rows(spark, rows):
    from feedloom.schema import FEED_ITEM

    df = spark.createDataFrame(
        [("trending", 0, 0, *r, None, "movie") for r in rows],
        "feed string, source_ord long, page_ord long, entry_ord long, title string, release string, link string, year int, type string",
    )
    df = df.select(
        "feed", "source_ord", "page_ord", "entry_ord", "title", "year", "type",
        F.to_date("release").alias("release_date"), F.col("link").alias("source_url"), F.col("link").alias("article_url"),
    )
    stamps = {n: F.lit(None).cast("timestamp") for n in ("scraped_at", "published_at", "updated_at")}
    rest = {f.name: F.lit(None).cast(f.dataType) for f in FEED_ITEM if f.name not in df.columns and f.name not in stamps}
    return df.withColumns(rest | stamps)


def _refreshed(spark, path, batches, to_items=lambda x: x, **options):
    """Feed titles after each batch of rows has arrived."""
    arriving, out = os.path.join(path, "arriving"), []
    for rows in batches:
        df = _feed_rows(spark, rows)
        df.coalesce(1).write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(df.schema).parquet(arriving)
        args = (stream, to_items, path, os.path.join(path, "checkpoint"), "t")
        jobs.stream_refresh_feeds(*args, **options).awaitTermination()
        out.append([r["title"] for r in jobs.latest_feeds(spark, path).orderBy("feed_pos").collect()])
    return out


def test_a_repeat_does_not_return_after_its_first_row_left_the_feed(spark):
    path = work_dir(spark, "refresh-test")
    first = [(i, f"Title {i}", f"2024-02-{i:02d}", f"https://h.example/a/{i}") for i in range(1, 23)]
    # Entries 1 and 2 were cut by the cap; a newer repeat of 1 must stay out, a new page comes in, and of two in one batch the first in order.
    later = [(30, "Title again", "2024-06-01", "https://h.example/a/1"), (32, "Newer", "2024-05-02", "https://h.example/a/99")]
    later += [(31, "New", "2024-05-01", "https://h.example/a/99")]
    titles = _refreshed(spark, path, [first, later, [(40, "Once more", "2024-06-02", "https://h.example/a/99")]])
    assert titles[1] == ["New"] + [f"Title {i}" for i in range(22, 3, -1)]
    assert titles[2] == titles[1]
    # A repeated batch changes nothing: the feeds of the batch before are merged with its rows again.
    assert not jobs.merge_batch(spark, _feed_rows(spark, later[-1:]), 1, path, "t2")


def test_a_batch_reads_as_much_after_many_batches(spark):
    """Signatures are state of the stream: no folder of earlier batches but the feeds of the last one is read."""
    path = work_dir(spark, "refresh-reads")
    _refreshed(spark, path, [[(i, f"T{i}", "2024-02-01", f"https://h.example/a/{i}")] for i in range(4)])
    assert sorted(os.listdir(path)) == ["arriving", "checkpoint", "feeds", "meta"]
    read = []
    real = jobs._last_before
    jobs._last_before = lambda *a: read.append(real(*a)) or read[-1]
    try:
        _refreshed(spark, path, [[(9, "T9", "2024-02-01", "https://h.example/a/9")]])
    finally:
        jobs._last_before = real
    assert [r.rsplit("=", 1)[1] for r in read] == ["3"]


def test_forgotten_signatures_may_come_again(spark):
    path = work_dir(spark, "refresh-forget")
    same = "https://h.example/a/1"
    rows = [[(1, "First", "2024-02-01", same)], [(2, "Other", "2024-02-05", "https://h.example/a/2")], [(3, "Again", "2024-02-06", same)]]
    by_day = lambda x: x.withColumn("scraped_at", F.col("release_date").cast("timestamp"))
    assert "Again" in _refreshed(spark, path, rows, by_day, forget_after=86_400)[-1]


def _table(rng, depth):
    """A random table: its markup, and the cells of every row in page order with those of tables inside them."""
    html, rows = "<table>", []
    for _ in range(rng.randint(0, 3)):
        cells, inside = [], []
        html += rng.choice(["<tr>", '<TR class="a">'])
        for _ in range(rng.randint(0, 3)):
            cell, own = rng.choice(["x", " <b>y</b> ", "<!-- <td> --> z", ""]), []
            if depth and rng.random() < 0.4:
                table, inner_rows, own = _table(rng, depth - 1)
                cell += table
                inside += inner_rows
            html += "<td>" + cell + rng.choice(["</td>", ""])
            cells += [cell, *own]
        html += rng.choice(["</tr>", ""])
        rows.append((cells, inside))
    flat = [r for cells, inside in rows for r in (cells, *inside)]
    return html + "</table>", flat, [c for cells, _ in rows for c in cells]


def test_rows_of_nested_tables():
    import random

    from feedloom.functions.html import rows_of

    rng = random.Random(7)
    for _ in range(300):
        html, rows, _ = _table(rng, 3)
        assert rows_of("<p>" + html, "table", "tr", "td") == rows
    assert rows_of("", "table", "tr", "td") == []
    assert rows_of("<table><tr><td>a<td>b", "table", "tr", "td") == [["a", "b"]]
    assert rows_of("<td>no</td></table><tr>", "table", "tr", "td") == []
    assert rows_of("<ul><li><a>1</a><ul><li><a>2</a></ul><li></ul>", "ul", "li", "a") == [["1", "2"], ["2"], []]
    assert len(rows_of("<table><tr><td>" * 300, "table", "tr", "td")[0]) == 300
    assert rows_of("<table><tr" * 200_000 + "<!--" * 200_000, "table", "tr", "td") == []
