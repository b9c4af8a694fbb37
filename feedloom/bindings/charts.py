"""Queries over events and parts: charts, ranks, change detection, embedded documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom import vocab
from feedloom.bindings.registry import query
from feedloom.bindings.sql import quote
from feedloom.functions import dates
from feedloom.operators import dedupe, fingerprint, keyed, rank
from feedloom.session import settle
from feedloom.sources import documents, pages



@query(
    "chart_dedupe",
    """WITH r AS (SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand, lower(trim(p_name)), p_type,
        CASE WHEN p_size > 25 THEN p_size END ORDER BY p_partkey) AS rn FROM part)
    SELECT p_partkey, p_brand FROM r WHERE rn = 1""",
)
def chart_dedupe(t):
    """Parts as chart rows: upper and lower case names are one title, small sizes have no year."""
    name = F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.concat(F.lit(" "), "p_name"))
    items = t.part.select(
        "p_partkey",
        F.col("p_brand").alias("feed"),
        name.alias("title"),
        F.col("p_type").alias("type"),
        F.when(F.col("p_size") > 25, F.col("p_size")).alias("year"),
    )
    kept = dedupe.dedupe_charts(items, order=["p_partkey"])
    return kept.select("p_partkey", F.col("feed").alias("p_brand"))


@query(
    "list_positions",
    """SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rank FROM part""",
)
def list_positions(t):
    return keyed.enumerate_positions(t.part.select("p_partkey", "p_brand"), ["p_brand"], ["p_partkey"])


@query(
    "name_positions",
    """SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_name DESC, c_custkey) AS rank
    FROM customer""",
)
def name_positions(t):
    """Few long lists in falling order of a text: the ranges come from a sample of the texts."""
    customers = t.customer.select("c_custkey", "c_mktsegment", "c_name")
    return keyed.enumerate_positions(customers, ["c_mktsegment"], [F.desc("c_name"), "c_custkey"]).drop("c_name")


@query(
    "event_positions",
    "SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rank FROM events",
)
def event_positions(t):
    """Few very long lists, each spread over many tasks."""
    return keyed.enumerate_positions(t.events.select("event_id", "event_type"), ["event_type"], ["event_id"])


@query(
    "chart_rank",
    """WITH e AS (SELECT CAST(ts AS DATE) AS day, CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 ELSE 2 END AS type_ord, event_id,
        CASE WHEN user_id % 10 = 0 THEN '' ELSE 'U' || user_id END AS title
      FROM events),
    d AS (SELECT *, row_number() OVER (PARTITION BY day, title ORDER BY type_ord, event_id) AS rn FROM e WHERE title <> ''),
    r AS (SELECT strftime(day, '%Y-%m-%d') AS day, type_ord, title,
        row_number() OVER (PARTITION BY day, type_ord ORDER BY event_id) AS rank FROM d WHERE rn = 1)
    SELECT * FROM r WHERE rank <= 10""",
)
def chart_rank(t):
    """Daily charts: first views, then clicks of users not seen among the views, then all other events."""
    kind = F.col("event_type")
    entries = t.events.select(
        F.to_date("ts").cast("string").alias("day"),
        F.when(kind == "view", 0).when(kind == "click", 1).otherwise(2).alias("type_ord"),
        "event_id",
        F.when(F.col("user_id") % 10 == 0, " ").otherwise(F.concat(F.lit("U"), "user_id")).alias("title"),
    )
    ranked = rank.rank_chart(entries, ["day"], "type_ord", ["event_id"])
    return ranked.drop("event_id")


@query(
    "first_non_empty_source",
    """WITH e AS (SELECT event_id, event_type, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS day
      FROM events WHERE value > 40),
    f AS (SELECT event_type, min(day) AS day FROM e GROUP BY 1)
    SELECT event_id, event_type, day FROM e JOIN f USING (event_type, day)""",
)
def first_non_empty_source(t):
    """Large events of the first day that has any, per type."""
    entries = t.events.where("value > 40").select(
        "event_id",
        "event_type",
        F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).cast("long").alias("day"),
    )
    return rank.first_non_empty_source(entries, ["event_type"], "day", ["event_id"])


_ROW_HASH = """CAST(('0x' || left(sha256('{"event_id":' || event_id || ',"kind":' || to_json(event_type)
  || ',"user_id":' || user_id || '}'), 15)) AS HUGEINT)"""


def _daily_hashes(t):
    """Order-insensitive hash per event type and day; two types appear only on even or odd days."""
    day = F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    rows = t.events.select(
        F.col("event_type").alias("feed"), day.cast("long").alias("day"), "event_id", F.col("event_type").alias("kind"), "user_id"
    )
    rows = rows.where(F.col("feed") != F.when(F.col("day") % 2 == 1, "error").otherwise("signup"))
    return fingerprint.large_feed_fingerprint(rows, ["feed", "day"])


def _daily_changes(t):
    """Every day against the day before: all types change, some come, some go."""
    hashes = settle(_daily_hashes(t), "hashes")
    before = hashes.withColumn("day", F.col("day") + 1)
    return fingerprint.detect_changes(before, hashes, ["feed", "day"]), hashes


_CHANGES = f"""WITH e AS (SELECT *, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS day FROM events),
  h AS (SELECT day, event_type AS feed, CAST(sum({_ROW_HASH}) AS VARCHAR) AS hash FROM e
    WHERE event_type <> CASE WHEN day % 2 = 1 THEN 'error' ELSE 'signup' END GROUP BY 1, 2),
  c AS (SELECT coalesce(o.feed, n.feed) AS feed, coalesce(o.day + 1, n.day) AS day, o.hash AS old_hash, n.hash AS new_hash,
    o.hash IS DISTINCT FROM n.hash AS changed FROM h o FULL JOIN h n ON o.feed = n.feed AND o.day + 1 = n.day)
"""


@query("change_detect", _CHANGES + "SELECT feed, day, old_hash, new_hash, changed FROM c")
def change_detect(t):
    return _daily_changes(t)[0].drop("count")


@query(
    "next_version",
    _CHANGES
    + """SELECT 8 AS version, '2024-01-06T00:00:00Z' AS updated_at, bool_or(changed) AS changed, 'changed' AS case_name FROM c
    UNION ALL SELECT 7, '2024-01-05T00:00:00Z', false, 'unchanged' FROM (SELECT count(*) FROM c)""",
)
def next_version(t):
    version = t.spark.createDataFrame([(7, "2024-01-05T00:00:00Z")], "version int, updated_at string")
    changes, hashes = _daily_changes(t)
    moved = fingerprint.next_version(changes, version, "2024-01-06T00:00:00Z").withColumn("case_name", F.lit("changed"))
    same = fingerprint.next_version(
        fingerprint.detect_changes(hashes, hashes, ["feed", "day"]), version, "2024-01-06T00:00:00Z"
    ).withColumn("case_name", F.lit("unchanged"))
    return moved.unionByName(same)


@query(
    "large_fingerprint",
    """WITH l AS (SELECT l_returnflag, l_linestatus, CAST(('0x' || left(sha256('{"day":"' || strftime(l_shipdate, '%Y-%m-%d')
        || '","l_linenumber":' || l_linenumber || ',"l_orderkey":' || l_orderkey || ',"l_partkey":' || l_partkey
        || ',"l_suppkey":' || l_suppkey || ',"none":null}'), 15)) AS HUGEINT) AS part FROM lineitem)
    SELECT l_returnflag, l_linestatus, count(*) AS count, CAST(sum(part) AS VARCHAR) AS hash FROM l GROUP BY 1, 2""",
)
def large_fingerprint(t):
    rows = t.lineitem.select(
        "l_returnflag",
        "l_linestatus",
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"),
        F.lit(None).cast("string").alias("none"),
    )
    return fingerprint.large_feed_fingerprint(rows, ["l_returnflag", "l_linestatus"])


# --- embedded documents -------------------------------------------------------------------


@query(
    "page_state_json",
    f"""WITH e AS (SELECT *, event_id % 10 AS k FROM events),
    i AS (SELECT event_id, 0 AS pos, CAST(event_id AS VARCHAR) AS video_id, event_type AS title, strftime(ts, '%Y-%m-%d') AS release_date,
        'https://img.example/' || user_id AS poster_image_url FROM e WHERE k < 7
      UNION ALL
      SELECT event_id, 1, 'v' || event_id, 'Second ' || user_id, NULL, NULL FROM e WHERE k < 7 AND k % 2 = 0)
    SELECT event_id, pos, video_id, title, release_date, poster_image_url, {quote(vocab.WATCH_URL)} || video_id AS source_url FROM i""",
)
def page_state_json(t):
    """Page state around every event; some pages hold broken JSON or none."""
    e = t.events
    millis = (F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("double")
    first = F.to_json(
        F.struct(
            F.col("event_id").alias("videoID"),
            F.col("event_type").alias("title1"),
            millis.alias("startTime"),
            F.concat(F.lit("//img.example/"), "user_id").alias("image"),
        )
    )
    second = F.when(
        F.col("event_id") % 2 == 0,
        F.to_json(
            F.struct(
                F.concat(F.lit("v"), "event_id").alias("videoID"),
                F.lit("").alias("title1"),
                F.concat(F.lit(" Second "), "user_id").alias("title2"),
            )
        ),
    ).otherwise(F.lit('{"videoID":"x","title1":"  "}'))
    state = F.concat(
        F.lit('{"props":{"pageProps":{"data":{"totalPages":3,"data":['), first, F.lit(","), second,
        F.lit("]}}}}"),
    )
    k = F.col("event_id") % 10
    body = (
        F.when(k < 7, state)
        .when(k == 7, F.left(state, F.length(state) - 5))
        .when(k == 8, F.lit("[1, 2]"))
    )
    html = F.when(
        body.isNotNull(),
        F.concat(
            F.lit('<html>\n<script id="__NEXT_DATA__" type="application/json">'), body,
            F.lit("</script></html>"),
        ),
    ).otherwise("<html></html>")
    items = documents.extract_page_state(e.select("event_id", html.alias("html")), ["event_id"])
    return items.withColumn("release_date", F.col("release_date").cast("string")).drop("total_pages")


_CARD_LIST = quote(vocab.CARD_LIST_URL)


@query(
    "find_nodes",
    f"""WITH e AS (SELECT *, event_id % 4 AS k FROM events),
    c AS (SELECT event_id, '0.1' AS path, event_type AS title, 'series' AS type, '#' || event_id AS anchor,
        'https://disney.images.edge.bamgrid.com/ripcut-delivery/v2/variant/disney/img-' || user_id || '/compose?format=webp&width=440' AS poster FROM e
      UNION ALL
      SELECT event_id, '0.1.5.1', 'Inner ' || user_id, 'movie', '', NULL FROM e WHERE k = 1
      UNION ALL
      SELECT event_id, '1.3.0.0', 'Deep', 'movie', '', NULL FROM e WHERE k = 2)
    SELECT event_id, path, title, type, {_CARD_LIST} || anchor AS source_url, poster AS poster_image_url FROM c""",
)
def find_nodes(t):
    """Card trees around every event: cards in arrays, inside cards, and far down; look-alikes in text."""
    k = F.col("event_id") % 4
    card = F.to_json(
        F.struct(
            F.lit("ImageCard").alias("_type"),
            F.concat(F.lit(" "), "event_type").alias("title"),
            F.lit("/whats-on/x").alias("url"),
            F.col("event_id").cast("string").alias("_id"),
            F.lit(True).alias("isEpisode"),
        )
    )
    variants = F.concat(
        F.lit('"imageVariants":{"a":[{"ripcutId":" "},{"note":"\\"imageId\\":\\"no\\"","imageId":"IMG-'),
        F.col("user_id").cast("string"),
        F.lit('"}],"ripcutId":"later"}'),
    )
    inner = F.when(
        k == 1,
        F.concat(
            F.lit('[{"_type":"Text"},{"_type":"ImageCard","url":"/whats-on/y","title":"Inner '),
            F.col("user_id").cast("string"),
            F.lit('"}]'),
        ),
    ).otherwise(F.lit('"{\\"_type\\":\\"ImageCard\\",\\"title\\":\\"text\\",\\"url\\":\\"/whats-on/z\\"}"'))
    deep = F.when(
        k == 2, F.lit('[1,true,null,[[{"_type":"ImageCard","title":"Deep","url":"/whats-on/d"}]]]')
    ).otherwise(F.lit('[{"_type":"ImageCard","title":"Elsewhere","url":"/other"}]'))
    outer = F.concat(
        F.left(card, F.length(card) - 1), F.lit(',"children":'), inner, F.lit(","), variants, F.lit("}")
    )
    doc = F.concat(F.lit('{"z":[0,'), outer, F.lit('],"a":'), deep, F.lit("}"))
    cards = documents.find_nodes(
        t.spread("events").select("event_id", doc.alias("doc")), ["event_id"], "doc", "_type", "ImageCard"
    )
    return documents.card_items(cards, ["event_id"]).select(
        "event_id",
        F.array_join(F.col("path").cast("array<string>"), ".").alias("path"),
        "title",
        "type",
        "source_url",
        "poster_image_url",
    )


def _edge(object_type, title, year, path, codes, description):
    return F.struct(
        F.struct(
            object_type.alias("objectType"),
            F.struct(
                title.alias("title"),
                description.alias("shortDescription"),
                path.alias("fullPath"),
                F.concat(F.lit("/poster/"), "p_partkey", F.lit("/{profile}/x.{format}")).alias("posterUrl"),
                year.alias("originalReleaseYear"),
                F.transform(codes, lambda c: F.struct(c.alias("shortName"))).alias("genres"),
            ).alias("content"),
        ).alias("node")
    )


def _replies(t):
    """A chart reply per part: a film, a repeat of it, a show, an untitled edge."""
    size = F.col("p_size")
    name = F.col("p_name")
    edges = F.array(
        _edge(F.lit("MOVIE"), F.concat(F.lit(" "), name), 1990 + size, F.concat(F.lit("/f/"), "p_partkey"),
              F.array(F.lit("act"), F.lit("zzz"), F.lit("")), F.col("p_brand")),
        _edge(F.lit("MOVIE"), F.upper(name), 1990 + size, F.lit(None).cast("string"), F.array(F.lit("scf")), F.lit("")),
        _edge(F.lit("SHOW"), F.col("p_type"), F.lit(None).cast("int"), F.concat(F.lit("/s/"), "p_partkey"),
              F.array(F.lit("drm")), F.lit(None).cast("string")),
        _edge(F.lit("SHOW"), F.lit(" "), 2000 + size, F.lit("/none"), F.array().cast("array<string>"), F.lit("x")),
        _edge(F.lit("SHOW"), name, 2000 + size, F.lit("/same"), F.array(F.lit("war")), F.lit("x")),
    )
    return t.part.select("p_partkey", F.to_json(F.struct(edges.alias("edges"))).alias("json"))


_PART_POSTER = f"'{vocab.LISTING_IMAGE_HOST}/poster/' || p_partkey || '/{vocab.LISTING_IMAGE_PROFILE}/x.{vocab.LISTING_IMAGE_FORMAT}'"


@query(
    "chart_edges",
    f"""SELECT p_partkey, pos, object_type, title, CAST(year AS VARCHAR) AS year,
        CASE WHEN path <> '' THEN '{vocab.LISTING_HOST}' || path ELSE '' END AS source_url, {_PART_POSTER} AS poster_image_url, genres, description
    FROM (
      SELECT p_partkey, 0 AS pos, 'MOVIE' AS object_type, p_name AS title, 1990 + p_size AS year, '/f/' || p_partkey AS path, 'Action|zzz' AS genres, p_brand AS description FROM part
      UNION ALL SELECT p_partkey, 1, 'MOVIE', upper(p_name), 1990 + p_size, '', 'Sci-Fi', '' FROM part
      UNION ALL SELECT p_partkey, 2, 'SHOW', p_type, NULL, '/s/' || p_partkey, 'Drama', NULL FROM part
      UNION ALL SELECT p_partkey, 3, 'SHOW', '', 2000 + p_size, '/none', '', 'x' FROM part
      UNION ALL SELECT p_partkey, 4, 'SHOW', p_name, 2000 + p_size, '/same', 'War', 'x' FROM part)""",
)
def chart_edges(t):
    return documents.flatten_chart_edges(_replies(t), ["p_partkey"]).withColumns(
        {"genres": F.array_join("genres", "|"), "year": F.col("year").cast("string")}
    )


@query(
    "chart_items",
    f"""SELECT p_partkey, title, type, rank, year, overview, release_date, source_url FROM (
      SELECT p_partkey, p_name AS title, 'movie' AS type, 1 AS rank, CAST(1990 + p_size AS VARCHAR) AS year,
        'Top 1 trending movie on Part Chart (TR). ' || p_brand AS overview, CAST(1990 + p_size AS VARCHAR) AS release_date,
        '{vocab.LISTING_HOST}/f/' || p_partkey AS source_url FROM part
      UNION ALL SELECT p_partkey, p_type, 'series', 1, NULL, 'Top 1 trending series on Part Chart (TR).', NULL,
        '{vocab.LISTING_HOST}/s/' || p_partkey FROM part)""",
)
def chart_items(t):
    from feedloom.plans.sources import chart_items as items

    return items(_replies(t), ["p_partkey"], F.lit("Part Chart")).select(
        "p_partkey", "title", "type", "rank", "year", "overview", "release_date", "source_url"
    )


def _chart_html(t):
    """Box-office tables built from parts: a header, a full row, a short row, a row without link."""
    name, key = F.col("p_name"), F.col("p_partkey")

    def row(values):
        return F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), v, F.lit("</td>")) for v in values], F.lit("</tr>"))

    def full(link, theaters, days, distributor):
        return [F.lit("1"), F.lit("2"), link, F.lit("$4"), F.lit("5"), F.lit("6"), theaters, F.lit("8"), F.lit("9"), days, distributor]

    link = F.concat(F.lit('<a class="l" href="/release/rl'), key, F.lit('/?ref=x">'), name, F.lit(" &amp; co</a>"))
    plain = F.concat(F.lit('<a href="/brand/x">'), name, F.lit("</a>"))
    outside = F.concat(F.lit('<a href="https://other.example/release/'), key, F.lit('/">Other</a>'))
    html = F.concat(
        F.lit("<p><table><tr><th>Rank</th></tr>"),
        row(full(link, F.concat(F.lit("1,"), F.lpad((F.col("p_size") * 3).cast("string"), 3, "0")), F.col("p_size").cast("string"), F.col("p_brand"))),
        row([F.lit("1"), link]),
        row(full(plain, F.lit("1"), F.lit("1"), F.lit("d"))),
        row(full(outside, F.lit("-"), F.lit("-"), F.lit(""))),
        row([F.lit("1"), F.lit("2"), link, *[F.lit("n")] * 6, F.lit("1,001")]),
        F.lit("</table><table><tr><td>second</td></tr></table>"),
    )
    return t.spread("part").select("p_partkey", html.alias("html"))


_CHART_ROWS = f"""FROM (
  SELECT p_partkey, 1 AS row_pos, p_name || ' & co' AS title, '{vocab.CHART_HOST}/release/rl' || p_partkey AS page_url,
    CAST(DATE '2024-03-01' - p_size + 1 AS VARCHAR) AS release_date, 1000 + p_size * 3 AS theaters, p_brand AS distributor FROM part
  UNION ALL SELECT p_partkey, 4, 'Other', 'https://other.example/release/' || p_partkey, NULL, 0, '' FROM part
  UNION ALL SELECT p_partkey, 5, p_name || ' & co', '{vocab.CHART_HOST}/release/rl' || p_partkey, '2021-06-05', 0, '' FROM part)"""


@query("chart_table", "SELECT * " + _CHART_ROWS)
def chart_table(t):
    run_date = F.lit("2024-03-01").cast("date")
    rows = pages.chart_rows(_chart_html(t), ["p_partkey"], run_date)
    return rows.withColumn("release_date", F.col("release_date").cast("string"))


@query(
    "theatrical_overview",
    """SELECT p_partkey, row_pos, 'Movie currently playing in cinema theaters.'
      || CASE WHEN distributor <> '' THEN ' Distributed by ' || distributor || '.' ELSE '' END
      || CASE WHEN theaters > 0 THEN ' Showing in ' || format('{:,}', theaters) || ' theaters.' ELSE '' END AS overview """
    + _CHART_ROWS,
)
def theatrical_overview(t):
    from feedloom.functions.text import theatrical_overview as overview

    rows = pages.chart_rows(_chart_html(t), ["p_partkey"], F.lit("2024-03-01").cast("date"))
    return rows.select(
        "p_partkey", "row_pos", overview(F.col("distributor"), F.col("theaters")).alias("overview")
    )


@query(
    "chart_titles",
    """SELECT p_partkey, p_name AS title, CASE WHEN p_size % 2 = 0 THEN p_type ELSE p_brand END AS numbered FROM part""",
)
def chart_titles(t):
    """Chart cells with rank, season and list-number decoration, cleaned again."""
    from feedloom.functions import text

    decorated = (
        F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("12 "), "p_name", F.lit(": Season 3")))
        .when(F.col("p_size") % 3 == 1, F.concat(F.lit(" "), "p_name", F.lit(" - Limited Series ")))
        .otherwise(F.concat(F.lit("1  "), "p_name", F.lit(": series")))
    )
    listed = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("7.  "), "p_type")).otherwise(
        F.concat(F.lit(" "), "p_brand")
    )
    return t.part.select(
        "p_partkey",
        text.clean_chart_title(decorated).alias("title"),
        text.strip_list_number(listed).alias("numbered"),
    )


TOP_N = 3
_TOP_LABEL = "Order Chart"
_TOP_SQL = rf"""WITH i AS (SELECT l_orderkey AS feed, CASE WHEN l_suppkey % 2 = 0 THEN 'movie' ELSE 'series' END AS type, l_linenumber AS n, l_partkey AS k,
      l_quantity <= 25 AS own, p_name || ' ' || p_partkey AS title FROM lineitem JOIN part ON p_partkey = l_partkey),
    d AS (SELECT feed, type, own, k, title, min((n, k)) AS place FROM i GROUP BY ALL),
    p AS (SELECT *, row_number() OVER (PARTITION BY feed, type, own ORDER BY place) AS pos FROM d),
    b AS (SELECT * FROM p WHERE pos <= {TOP_N}),
    m AS (SELECT *, row_number() OVER (PARTITION BY feed, type ORDER BY own DESC, pos) AS rank FROM b
      WHERE own OR NOT EXISTS (SELECT 1 FROM b o WHERE o.own AND o.feed = b.feed AND o.type = b.type AND o.title = b.title)),
    l AS (SELECT DISTINCT feed, type, 'https://lists.example/' || feed || '/' || type AS list_url FROM i WHERE own),
    h AS (SELECT m.*, list_url, k % 5 <> 0 AS hit, type = 'series' AND k % 2 = 0 AS shown, p_size, p_brand FROM m LEFT JOIN l USING (feed, type) JOIN part ON p_partkey = k
      WHERE rank <= {TOP_N}),
    u AS (SELECT *, CASE WHEN NOT hit THEN NULL WHEN shown THEN '{vocab.LISTING_HOST}/s/' || k WHEN k % 3 <> 0 THEN '{vocab.LISTING_HOST}/f/' || k END AS address FROM h)
    SELECT CAST(feed AS VARCHAR) AS feed, CASE type WHEN 'series' THEN 1 ELSE 0 END AS page_ord, rank AS entry_ord, title, type,
      CASE WHEN hit AND NOT shown THEN CAST(1990 + p_size AS VARCHAR) END AS year,
      '{_TOP_LABEL} Top ' || rank || ' ' || type || '.' || CASE WHEN hit AND NOT shown THEN ' ' || p_brand ELSE '' END AS overview,
      CASE WHEN NOT hit THEN '' WHEN shown THEN 'War' ELSE 'Action|zzz' END AS genres,
      coalesce(address, list_url) AS source_url, coalesce(address, list_url || '#' || rank || '-' || type) AS article_url FROM u"""


@query("top_list_items", _TOP_SQL)
def top_list_items(t):
    """Every order's items as list pages of films and shows, short lists filled from its larger items, with search replies per part."""
    from feedloom.plans.sources import top_list_items as items

    c = F.col
    named = F.concat_ws(" ", "p_name", "p_partkey")
    rows = t.lineitem.join(t.part.select(c("p_partkey").alias("l_partkey"), named.alias("title")), "l_partkey").select(
        c("l_orderkey").cast("string").alias("feed"),
        F.when(c("l_suppkey") % 2 == 0, "movie").otherwise("series").alias("type"),
        (c("l_quantity") <= 25).alias("own"),
        # An order has few items, so its page is small.
        F.struct("l_linenumber", "l_partkey", F.concat(
            F.lit("<tr><td><b>"), "l_linenumber", F.lit(" "), F.when(c("l_suppkey") % 4 < 2, F.upper("title")).otherwise(c("title")),
            F.lit("</b>: Season 2</td><td>x</td></tr>"),
        ).alias("row")).alias("at"),
    )
    page = F.concat(F.lit("<table><tr><th>Title</th></tr>"), F.array_join(F.sort_array(F.collect_list("at"))["row"], ""), F.lit("</table>"))
    lists = settle(rows.groupBy("feed", "type", "own").agg(page.alias("html")), "list-pages")
    address = F.concat(F.lit("https://lists.example/"), "feed", F.lit("/"), "type")
    none = F.lit(None).cast("string")
    edges = F.array(
        _edge(F.lit("SHOW"), none, F.lit(2001), F.lit("/x"), F.array(F.lit("drm")), F.lit("untitled")),
        _edge(F.lit("MOVIE"), c("title"), 1990 + c("p_size"), F.when(c("p_partkey") % 3 != 0, F.concat(F.lit("/f/"), "p_partkey")),
              F.array(F.lit("act"), F.lit("zzz")), c("p_brand")),
        _edge(F.when(c("p_partkey") % 2 == 0, "SHOW").otherwise("MOVIE"), F.upper("title"), F.lit(None).cast("int"),
              F.concat(F.lit("/s/"), "p_partkey"), F.array(F.lit("war")), F.lit("")),
    )
    known = t.spread("part").withColumn("title", named).where("p_partkey % 5 <> 0").select("title", F.to_json(F.struct(edges.alias("edges"))).alias("json"))
    replies = known.select(F.explode(F.array("title", F.upper("title"))).alias("asked"), "json")
    own = lists.where("own").select("feed", "type", address.alias("list_url"), "html")
    found = items(own, lists.where("NOT own"), replies.withColumnRenamed("asked", "title"), "netflix", _TOP_LABEL, TOP_N)
    return found.select(
        "feed", c("page_ord").cast("int").alias("page_ord"), "entry_ord", F.lower("title").alias("title"), "type", "year", "overview",
        F.array_join("genres", "|").alias("genres"), "source_url", "article_url",
    )


@query(
    "search_catalog",
    """WITH r AS (SELECT lower(title) AS search_key, CASE WHEN page_id % 3 = 0 THEN 'tv' ELSE 'movie' END AS search_type,
      '/p' || page_id || '.jpg' AS image_path FROM (SELECT *, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages)
      WHERE page_id % 7 <> 0 AND page_id % 5 <> 0)
    SELECT search_key, search_type, min(image_path) AS image_path FROM r GROUP BY 1, 2""",
)
def search_catalog(t):
    """Pages as search replies: failed ones, ones without a picture, two pictures in others."""
    from feedloom.operators.enrich import catalog_from_replies

    picture = F.concat(F.lit('<img src="https://x.example/t/p/w94_and_h141_bestv2/p'), "page_id", F.lit('.jpg"><img src="/t/p/w500/zz.jpg">'))
    return catalog_from_replies(
        t.pages.select(
            F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("phrase"),
            F.when(F.col("page_id") % 3 == 0, "tv").otherwise("movie").alias("search_type"),
            F.when(F.col("page_id") % 7 == 0, 503).otherwise(200).alias("status"),
            F.concat("html", F.when(F.col("page_id") % 5 != 0, picture).otherwise(F.lit('<img src="/t/p/x.jpg">'))).alias("html"),
        )
    )


@query(
    "epoch_dates",
    "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events",
)
def epoch_dates(t):
    millis = (F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("string")
    return t.events.select("event_id", dates.epoch_ms_date(millis).cast("string").alias("day"))
