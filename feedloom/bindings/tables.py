"""Queries over the star tables: lookups, unions, fallbacks, orderings, dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom import vocab
from feedloom.bindings import sql as q
from feedloom.bindings.registry import query
from feedloom.functions import dates, text
from feedloom.operators import combine, enrich, keyed, rank
from feedloom.sources import pages as sources

_STYLES = 10


@query(
    "date_parse",
    """SELECT o_orderkey,
      CASE o_orderkey % 10 WHEN 4 THEN strftime(date_trunc('month', o_orderdate), '%Y-%m-%d')
        WHEN 5 THEN strftime(date_trunc('year', o_orderdate), '%Y-%m-%d')
        WHEN 7 THEN NULL WHEN 8 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS release_date,
      CASE o_orderkey % 10 WHEN 4 THEN strftime(date_trunc('month', o_orderdate), '%Y-%m-%dT00:00:00Z')
        WHEN 5 THEN strftime(date_trunc('year', o_orderdate), '%Y-%m-%dT00:00:00Z')
        WHEN 6 THEN strftime(o_orderdate + INTERVAL 28 HOUR + INTERVAL 30 MINUTE, '%Y-%m-%dT%H:%M:%SZ')
        WHEN 7 THEN strftime(o_orderdate + INTERVAL 1 HOUR + INTERVAL 20 MINUTE + INTERVAL 51 SECOND, '%Y-%m-%dT%H:%M:%SZ')
        WHEN 8 THEN NULL
        WHEN 9 THEN strftime(o_orderdate + INTERVAL 13 HOUR + INTERVAL 5 MINUTE + INTERVAL 6 SECOND, '%Y-%m-%dT%H:%M:%SZ')
        ELSE strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') END AS published_at
    FROM orders""",
)
def date_parse(t):
    """Order dates written in ten styles and read back."""
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % _STYLES
    written = (
        F.when(k == 0, F.date_format(d, "yyyy-MM-dd"))
        .when(k == 1, F.date_format(d, "yyyy/M/d"))
        .when(k == 2, F.date_format(d, "d MMM yyyy"))
        .when(k == 3, F.date_format(d, "MMMM d, yyyy"))
        .when(k == 4, F.date_format(d, "yyyy-MM"))
        .when(k == 5, F.date_format(d, "yyyy"))
        .when(k == 6, F.concat(F.date_format(d, "EEE, dd MMM yyyy"), F.lit("  23:30:00 -0500")))
        .when(k == 7, F.concat(F.date_format(d, "yyyy-MM-dd'T'"), F.lit("01:20:51.250Z")))
        .when(k == 8, F.concat(F.lit("on "), F.date_format(d, "yyyy-MM-dd")))
        .otherwise(F.concat(F.date_format(d, "d-MMM-yyyy"), F.lit(" 06:05:06 PDT")))
    )
    df = t.orders.select("o_orderkey", written.alias("written"))
    return df.select(
        "o_orderkey",
        dates.parse_release_date("written").cast("string").alias("release_date"),
        dates.iso_z(dates.parse_published("written")).alias("published_at"),
    )


@query(
    "feed_order_cap",
    """WITH i AS (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'netflix' WHEN '2-HIGH' THEN 'trending' ELSE o_orderpriority END AS feed,
        CASE WHEN o_orderkey % 50 > 0 THEN strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') END AS release_date,
        o_orderstatus || (o_custkey % 100) AS title FROM orders),
    r AS (SELECT *, row_number() OVER (PARTITION BY feed ORDER BY
        CASE WHEN feed <> 'netflix' THEN release_date END DESC NULLS LAST,
        CASE WHEN feed <> 'netflix' THEN title END DESC NULLS LAST, o_orderkey) AS feed_pos FROM i)
    SELECT o_orderkey, feed, release_date, title, feed_pos FROM r WHERE feed_pos <= 20""",
)
def feed_order_cap(t):
    """Priorities as feeds, one of them a chart that keeps its order."""
    p = F.col("o_orderpriority")
    items = t.orders.select(
        "o_orderkey",
        F.when(p == "1-URGENT", "netflix").when(p == "2-HIGH", "trending").otherwise(p).alias("feed"),
        F.when(F.col("o_orderkey") % 50 > 0, F.to_date(F.date_trunc("month", "o_orderdate"))).alias("release_date"),
        F.concat("o_orderstatus", F.col("o_custkey") % 100).alias("title"),
    )
    return rank.final_order_cap(items, order=["o_orderkey"]).withColumn(
        "release_date", F.col("release_date").cast("string")
    )


PRIORITIES = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium"}


@query(
    "code_map",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high' WHEN '3-MEDIUM' THEN 'medium'
        ELSE o_orderpriority END AS priority,
      CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE 'open' END AS state FROM orders""",
)
def code_map(t):
    df = enrich.map_codes(t.orders, "o_orderpriority", "priority", PRIORITIES)
    df = enrich.map_codes(df, "o_orderstatus", "state", {"F": "done"}, F.lit("open"))
    return df.select("o_orderkey", "priority", "state")


@query(
    "code_join",
    """SELECT c_custkey, coalesce(n_name, 'nation ' || c_nationkey) AS nation FROM customer
      LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON n_nationkey = c_nationkey""",
)
def code_join(t):
    known = t.nation.where("n_regionkey < 3")
    df = enrich.join_codes(
        t.customer, known, "c_nationkey", "n_nationkey", "n_name", "nation",
        F.concat(F.lit("nation "), "c_nationkey"),
    )
    return df.select("c_custkey", "nation")


@query(
    "platform_names",
    f"""SELECT o_orderkey, coalesce(m.platform, 'multi_platform') AS platform FROM
      (SELECT o_orderkey, {q.array([*vocab.PLATFORM_ALIASES, "hulu", "imdb_trending"])}[o_orderkey % 18 + 1] AS alias FROM orders)
      LEFT JOIN (VALUES {", ".join(f"({q.quote(a)}, {q.quote(b)})" for a, b in vocab.PLATFORM_ALIASES.items())}) m(alias, platform) USING (alias)""",
)
def platform_names(t):
    names = F.array(*[F.lit(a) for a in (*vocab.PLATFORM_ALIASES, "hulu", "imdb_trending")])
    alias = F.get(names, (F.col("o_orderkey") % 18).cast("int"))
    spelled = F.concat(F.lit(" "), F.upper(alias), F.lit(" "))
    return t.orders.select("o_orderkey", text.normalize_platform(spelled).alias("platform"))


@query(
    "lookup_preferred",
    """WITH a AS (SELECT p_name, p_partkey, p_retailprice,
        CASE WHEN p_type IN ('PROMO', 'LARGE', 'MEDIUM') THEN 'MOVIE' ELSE 'SHOW' END AS hit_type,
        row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS hit_ord FROM part),
    h AS (SELECT * FROM a WHERE hit_ord <= 3 AND p_partkey % 3 <> 0),
    c AS (SELECT o_orderkey, p_name, CASE WHEN o_orderkey % 2 = 0 THEN 'MOVIE' ELSE 'SHOW' END AS want
      FROM orders JOIN part ON p_partkey = o_custkey),
    r AS (SELECT o_orderkey, want, h.p_partkey AS hit, hit_type,
        row_number() OVER (PARTITION BY o_orderkey ORDER BY hit_type IS DISTINCT FROM want, hit_ord) AS rn
      FROM c LEFT JOIN h ON h.p_name = c.p_name)
    SELECT o_orderkey, want, CAST(hit AS VARCHAR) AS hit, hit_type FROM r WHERE rn = 1""",
)
def lookup_preferred(t):
    """Orders ask for a part by name and preferred kind; the first three parts of that name are the hits."""
    kind = F.when(F.col("p_type").isin("PROMO", "LARGE", "MEDIUM"), "MOVIE").otherwise("SHOW")
    hits = keyed.ranked_by(
        t.part.select("p_name", "p_partkey", kind.alias("hit_type")), ["p_name"], ["p_partkey"], 3, "hit_ord"
    )
    catalog = hits.select(
        F.col("p_name").alias("title"),
        "hit_ord",
        "hit_type",
        F.when(F.col("p_partkey") % 3 != 0, F.col("p_partkey").cast("string")).alias("hit"),
    )
    chart = t.orders.join(t.part, F.col("o_custkey") == F.col("p_partkey")).select(
        "o_orderkey",
        F.col("p_name").alias("title"),
        F.when(F.col("o_orderkey") % 2 == 0, "MOVIE").otherwise("SHOW").alias("want"),
    )
    found = enrich.lookup_preferred(
        chart, catalog, "title", "want", "hit_type", "hit_ord", "hit", ["o_orderkey"]
    )
    return found.select("o_orderkey", "want", "hit", "hit_type")


_PLAIN_TITLE = rf"trim(regexp_replace(regexp_replace({q.TITLE}, '[^\p{{L}} ]', '', 'g'), ' +', ' ', 'g'))"
_IMAGE = vocab.CATALOG_IMAGE_BASE


@query(
    "lookup_progressive",
    rf"""WITH i AS (SELECT page_id, {_PLAIN_TITLE} AS title, CASE WHEN page_id % 3 = 0 THEN 'series' ELSE 'movie' END AS type FROM pages),
    w AS (SELECT *, string_split(title, ' ') AS words FROM i),
    k AS (SELECT *, lower(title) AS k0,
        CASE WHEN len(words) > 4 THEN lower(array_to_string(words[1:4], ' ')) END AS k1,
        CASE WHEN len(words) > 6 THEN lower(array_to_string(words[1:3], ' ')) END AS k2 FROM w),
    c AS (SELECT search_key, search_type, min(page_id) AS page_id FROM (
        SELECT k0 AS search_key, 'movie' AS search_type, page_id FROM k WHERE page_id % 5 = 0
        UNION ALL SELECT k1, 'tv', page_id FROM k WHERE page_id % 5 = 1
        UNION ALL SELECT k2, 'multi', page_id FROM k WHERE page_id % 5 IN (2, 1)) WHERE search_key IS NOT NULL GROUP BY 1, 2),
    t AS (SELECT page_id, type, 0 AS ord, k0 AS search_key FROM k WHERE k0 <> '' UNION ALL SELECT page_id, type, 1, k1 FROM k
        UNION ALL SELECT page_id, type, 2, k2 FROM k),
    r AS (SELECT t.page_id, c.page_id AS image, row_number() OVER (PARTITION BY t.page_id ORDER BY ord,
        CASE WHEN search_type = 'multi' THEN 2 WHEN (search_type = 'tv') = (type = 'series') THEN 0 ELSE 1 END) AS rn
      FROM t JOIN c USING (search_key)),
    f AS (SELECT page_id, image FROM r WHERE rn = 1)
    SELECT i.page_id, CASE WHEN i.page_id % 7 < 2 THEN 'own' WHEN image IS NOT NULL THEN '{_IMAGE}{vocab.POSTER_SIZE}/p' || image || '.jpg' END AS poster_image_url,
      CASE WHEN i.page_id % 7 = 0 THEN 'own' WHEN image IS NOT NULL THEN '{_IMAGE}{vocab.BACKDROP_SIZE}/p' || image || '.jpg' END AS backdrop_image_url
    FROM i LEFT JOIN f ON f.page_id = i.page_id""",
)
def lookup_progressive(t):
    """Page titles looked up in a catalog of full titles, four-word and three-word heads."""
    i = F.col("page_id")
    plain = F.trim(F.regexp_replace(F.regexp_replace("title", r"[^\p{L} ]", ""), " +", " "))
    titled = sources.page_titles(t.pages).select("page_id", plain.alias("title"))
    words = F.split("title", " ")
    four = F.when(F.size(words) > 4, F.array_join(F.slice(words, 1, 4), " "))
    three = F.when(F.size(words) > 6, F.array_join(F.slice(words, 1, 3), " "))
    entries = titled.select(
        "page_id",
        F.explode(
            F.array(
                F.struct(F.when(i % 5 == 0, F.col("title")).alias("k"), F.lit("movie").alias("search_type")),
                F.struct(F.when(i % 5 == 1, four).alias("k"), F.lit("tv").alias("search_type")),
                F.struct(F.when((i % 5).isin(1, 2), three).alias("k"), F.lit("multi").alias("search_type")),
            )
        ).alias("e"),
    ).select("page_id", F.lower("e.k").alias("search_key"), "e.search_type")
    catalog = (
        entries.where("search_key is not null")
        .groupBy("search_key", "search_type")
        .agg(F.min("page_id").alias("p"))
        .select("search_key", "search_type", F.concat(F.lit("/p"), "p", F.lit(".jpg")).alias("image_path"))
    )
    items = titled.withColumns(
        {
            "type": F.when(i % 3 == 0, "series").otherwise("movie"),
            "poster_image_url": F.when(i % 7 < 2, "own"),
            "backdrop_image_url": F.when(i % 7 == 0, "own"),
        }
    )
    return enrich.lookup_progressive(items, catalog, ["page_id"]).select(
        "page_id", "poster_image_url", "backdrop_image_url"
    )


@query(
    "enrich_details",
    f"""WITH d AS (SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 THEN 'tt' || c_custkey END AS ext,
        CASE WHEN c_custkey % 4 > 0 THEN DATE '2020-01-01' + CAST(c_custkey AS INTEGER) END AS exact FROM customer WHERE c_custkey % 5 > 0),
    j AS (SELECT o_orderkey, o_custkey, ext, CASE WHEN c_custkey % 4 = 1 THEN NULL ELSE exact END AS exact, o_orderdate, c_custkey
      FROM orders LEFT JOIN d ON c_custkey = o_custkey),
    r AS (SELECT *, strftime(coalesce(exact, CAST(o_orderdate AS DATE)), '%Y-%m-%d') AS release_date FROM j)
    SELECT o_orderkey, release_date, regexp_extract(release_date, '20[0-9][0-9]') AS year,
      CASE WHEN ext IS NOT NULL THEN '{vocab.TITLE_HOST}/title/' || ext || '/' ELSE 'https://c.example/' || o_custkey END AS source_url,
      CASE WHEN c_custkey IS NOT NULL THEN 'https://{vocab.DETAIL_POSTER_PART}' || c_custkey || '{vocab.DETAIL_POSTER_RENDITION}' END AS poster_image_url
    FROM r""",
)
def enrich_details(t):
    """Orders as chart rows, customers as detail pages (a fifth of them missing)."""
    k = F.col("c_custkey")
    exact = F.date_add(F.lit("2020-01-01").cast("date"), k.cast("int"))
    written = F.when(k % 4 == 1, "soon").when(k % 4 > 1, F.date_format(exact, "MMM d, yyyy"))

    def span(c):
        return F.concat(F.lit("<span>"), c, F.lit("</span>"))

    link = F.when(
        k % 3 > 0, F.concat(F.lit('<a href="https://pro.imdb.com/title/tt'), k, F.lit('/?x=1">IMDb</a>'))
    ).otherwise("")
    image = F.concat(
        F.lit(f'<img src="https://{vocab.DETAIL_POSTER_PART}'), k, F.lit('._V1_SX90_.jpg">')
    )
    html = F.concat(
        F.lit('<div><a href="/x">x</a>'), link, image, span(F.lit("Release Date")),
        span(F.coalesce(written, F.lit(""))), F.lit("</div>"),
    )
    page = F.concat(F.lit("https://c.example/"), k).alias("url")
    details = sources.detail_pages(t.customer.where(k % 5 > 0).select(page, html.alias("html")))
    chart = t.orders.select(
        "o_orderkey",
        F.concat(F.lit("https://c.example/"), "o_custkey").alias("page_url"),
        F.to_date("o_orderdate").alias("release_date"),
    )
    found = enrich.enrich_details(chart, details, "page_url", ["o_orderkey"])
    return found.select(
        "o_orderkey", F.col("release_date").cast("string").alias("release_date"), "year", "source_url",
        "poster_image_url",
    )


@query(
    "top_up",
    """WITH s AS (SELECT s_suppkey, n_name, n_regionkey, 'Part ' || (s_suppkey % 37) AS title FROM supplier JOIN nation ON n_nationkey = s_nationkey),
    p AS (SELECT n_name, title, s_suppkey, row_number() OVER (PARTITION BY n_name ORDER BY s_suppkey) AS rn FROM s),
    o AS (SELECT n_name, title, s_suppkey FROM p WHERE rn <= 6),
    b AS (SELECT n_regionkey, upper(title) AS title, min(s_suppkey) AS s_suppkey FROM s GROUP BY 1, 2),
    e AS (SELECT n.n_name, b.title, b.s_suppkey FROM nation n JOIN b USING (n_regionkey)
      WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.n_name = n.n_name AND lower(o.title) = lower(b.title))),
    u AS (SELECT *, false AS from_backup FROM o UNION ALL SELECT *, true FROM e),
    r AS (SELECT n_name, title, from_backup, row_number() OVER (PARTITION BY n_name ORDER BY from_backup, s_suppkey) AS position FROM u)
    SELECT * FROM r WHERE position <= 6""",
)
def top_up(t):
    """Supplier titles per nation, filled up to six from the suppliers of the region."""
    s = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey",
        "n_name",
        "n_regionkey",
        F.concat(F.lit("Part "), F.col("s_suppkey") % 37).alias("title"),
    )
    spare = keyed.first_by(
        s.select("n_regionkey", F.upper("title").alias("title"), "s_suppkey"),
        ["n_regionkey", "title"],
        ["s_suppkey"],
    )
    spare = keyed.first_by(spare, ["n_regionkey"], ["s_suppkey"], 12)
    backup = t.nation.select("n_name", "n_regionkey").join(spare, "n_regionkey")
    filled = combine.top_up(s, backup, 6, ["n_name"], "title", ["s_suppkey"])
    return filled.select("n_name", "title", "from_backup", "position")


@query(
    "union_sources",
    """SELECT source, source_ord, count(*) AS n_rows, sum(key) AS keys, count(day) AS dated FROM (
      SELECT 'orders' AS source, 0 AS source_ord, o_orderkey AS key, o_orderdate AS day FROM orders
      UNION ALL SELECT 'lineitem', 2, l_orderkey, NULL FROM lineitem) GROUP BY 1, 2""",
)
def union_sources(t):
    """Two sources with different columns; the one between them failed."""
    merged = combine.union_sources(
        {
            "orders": t.orders.select(F.col("o_orderkey").alias("key"), F.col("o_orderdate").alias("day")),
            "broken": None,
            "lineitem": t.lineitem.select(F.col("l_orderkey").alias("key")),
        }
    )
    return merged.groupBy("source", "source_ord").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("key").alias("keys"), F.count("day").alias("dated")
    )


def _nation_feeds(t):
    """Well-funded suppliers as the items of their nation's feed."""
    items = (
        t.supplier.where("s_acctbal > 6000")
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("n_name").alias("feed"), F.col("s_name").alias("title"), F.col("s_suppkey").alias("ord"))
    )
    registry = t.nation.select(F.col("n_name").alias("feed"))
    fallback = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).where(
        "n_regionkey <> 4"
    )
    fallback = fallback.select(
        F.col("n_name").alias("feed"),
        F.explode(F.array(F.col("r_name"), F.concat("r_name", F.lit(" again")))).alias("title"),
        (F.lit(1_000_000_000) + F.col("r_regionkey")).cast("long").alias("ord"),
    )
    return items, registry, fallback


DEFAULT_ROW = {"title": "Demo", "ord": 2_000_000_000}

_NATION_FEEDS = """WITH i AS (SELECT n_name AS feed, s_name AS title, s_suppkey AS ord FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE s_acctbal > 6000),
  b AS (SELECT n_name AS feed, unnest([r_name, r_name || ' again']) AS title, 1000000000 + r_regionkey AS ord FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_regionkey <> 4
    UNION ALL SELECT n_name, 'Demo', 2000000000 FROM nation WHERE n_regionkey = 4),
  c AS (SELECT n_name AS feed, (SELECT count(*) FROM i WHERE i.feed = n_name) AS n FROM nation) """


@query(
    "fill_empty_feeds",
    _NATION_FEEDS + "SELECT feed, title FROM i UNION ALL SELECT feed, title FROM b JOIN c USING (feed) WHERE n = 0",
)
def fill_empty_feeds(t):
    items, registry, fallback = _nation_feeds(t)
    return combine.fill_empty_feeds(items, registry, fallback, DEFAULT_ROW).select("feed", "title")


@query(
    "boost_low_feeds",
    _NATION_FEEDS
    + """, u AS (SELECT feed, title, ord FROM i JOIN c USING (feed) UNION ALL SELECT feed, title, ord FROM b JOIN c USING (feed) WHERE n < 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY feed ORDER BY title DESC, ord) AS rn FROM u JOIN c USING (feed))
    SELECT feed, title FROM r WHERE n >= 2 OR rn <= 2""",
)
def boost_low_feeds(t):
    """Feeds with fewer than two suppliers get fallback rows and are cut to two by title."""
    items, registry, fallback = _nation_feeds(t)

    def finish(rows):
        return keyed.first_by(rows, ["feed"], [F.desc("title"), "ord"], 2)

    boosted = combine.boost_low_feeds(items, registry, fallback, DEFAULT_ROW, finish, ["ord"])
    return boosted.select("feed", "title")


@query(
    "ratings_and_years",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(least(10, CAST(l_quantity AS INTEGER)) AS INTEGER) AS rating,
        CAST(year(l_shipdate) AS VARCHAR) AS year FROM lineitem""",
)
def ratings_and_years(t):
    number = F.col("l_quantity").cast("string")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        text.coerce_rating(F.concat(F.lit(" "), number)).cast("int").alias("rating"),
        text.parse_year(F.concat(F.lit("Film ("), F.date_format("l_shipdate", "yyyy"), F.lit(")")))
        .cast("string")
        .alias("year"),
    )
