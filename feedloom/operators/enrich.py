"""Lookups against landed tables: catalogs, crawled pages, image checks, code tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom import vocab
from feedloom.functions import dates, html, images, text, urls
from feedloom.functions.core import blank_to_null, map_get, pin
from feedloom.operators.keyed import first_by, key_counts, lookup

SEARCH_HITS = 3
SEEDS_PER_ROW = 4


def map_codes(df: DataFrame, code: str, out: str, table: Mapping, default: Column | None = None) -> DataFrame:
    """Translate a code through a fixed table; unknown codes pass through or get the default."""
    fallback = F.col(code) if default is None else default
    return df.withColumn(out, F.coalesce(map_get(table, F.col(code)), fallback))


def join_codes(
    df: DataFrame, dim: DataFrame, code: str, dim_key: str, dim_value: str, out: str, default: Column
) -> DataFrame:
    """The same through a table. Spark broadcasts it only while it is below the size threshold."""
    small = dim.select(F.col(dim_key).alias(code), F.col(dim_value).alias(out))
    return df.join(small, code, "left").withColumn(out, F.coalesce(F.col(out), default))


def lookup_preferred(
    chart: DataFrame,
    catalog: DataFrame,
    on: str,
    want: str,
    hit_type: str,
    hit_ord: str,
    hit_title: str,
    spread_by: list,
    max_hits: int = SEARCH_HITS,
) -> DataFrame:
    """Best of the first search hits per chart row: wanted type first, then search order.

    Hits without a title never win. Chart rows without a hit stay. The best hit is found
    once per (key, wanted type), not once per chart row.
    """
    counts = key_counts(chart, [on, want])
    hits = catalog.where((F.col(hit_ord) <= max_hits) & (F.coalesce(hit_title, F.lit("")) != ""))
    best = first_by(
        counts.drop("_rows").join(hits, on),
        [on, want],
        [(F.col(hit_type) != F.col(want)).cast("int"), hit_ord],
    )
    return lookup(chart, best, [on, want], spread_by, counts=counts)


def catalog_from_replies(replies: DataFrame) -> DataFrame:
    """Landed search replies to the catalog of `lookup_progressive`: (search_key, search_type, image_path).

    `replies(phrase, search_type, status, html)`. Of a reply the first poster path counts; replies that failed, or hold
    none, are left out. Phrases compare in lower case; of several replies for one phrase and type the smallest path stays.
    """
    ok = replies.where(F.col("status").between(200, 299) & F.col("phrase").isNotNull())
    path = html.matches("html", [vocab.CATALOG_IMAGE_PATTERN])[0]
    found = ok.select(F.lower("phrase").alias("search_key"), "search_type", path.alias("image_path")).where("image_path <> ''")
    return found.groupBy("search_key", "search_type").agg(F.min("image_path").alias("image_path"))


def lookup_progressive(
    items: DataFrame,
    catalog: DataFrame,
    spread_by: list,
    eligible: Column | None = None,
) -> DataFrame:
    """Poster and backdrop from a catalog by ever simpler search phrases.

    `catalog(search_key, search_type, image_path)` holds the first image per lower-case phrase
    and type (`movie`, `tv` or `multi`). For each distinct (title, type, year) that lacks an
    image the phrases are tried in order, each with the matching type, the other type and
    any type; the first hit fills whichever image is missing.
    """
    c = F.col
    lacks = blank_to_null(c("poster_image_url")).isNull() | blank_to_null(c("backdrop_image_url")).isNull()
    needed = lacks if eligible is None else lacks & eligible
    rows = items.withColumn("_ask", F.when(needed, c("title")))

    counts = key_counts(rows, ["_ask", "type"])
    asked = pin(counts.drop("_rows"), _clean=text.search_title("_ask"))
    asked = pin(asked, _core=text.title_core(c("_ask"), c("_clean")))
    tries = asked.select(
        "_ask", "type", F.posexplode(text.search_keys(c("_core"), c("_clean"))).alias("_try", "_key")
    ).withColumn("_key", F.lower("_key"))

    wanted = F.when(c("type").isin("series", "anime"), "tv").otherwise("movie")
    type_rank = (
        F.when(c("search_type") == wanted, 0).when(c("search_type") == "multi", 2).otherwise(1)
    )
    found = first_by(
        tries.join(catalog.withColumnRenamed("search_key", "_key"), "_key").withColumn(
            "_type_rank", type_rank
        ),
        ["_ask", "type"],
        ["_try", "_type_rank"],
    ).select(
        "_ask",
        "type",
        F.concat(F.lit(vocab.CATALOG_IMAGE_BASE + vocab.POSTER_SIZE), "image_path").alias("_poster"),
        F.concat(F.lit(vocab.CATALOG_IMAGE_BASE + vocab.BACKDROP_SIZE), "image_path").alias("_backdrop"),
    )
    joined = lookup(rows, found, ["_ask", "type"], spread_by, counts=counts)
    return joined.withColumns(
        {
            "poster_image_url": F.coalesce(blank_to_null(c("poster_image_url")), c("_poster")),
            "backdrop_image_url": F.coalesce(blank_to_null(c("backdrop_image_url")), c("_backdrop")),
        }
    ).select(*items.columns)


def _checked(url: Column) -> Column:
    """Verdict from the header check: a picture, or refused or untyped but named like one."""
    ok = F.col("_status").between(200, 299)
    kind = F.lower(F.coalesce("_content_type", F.lit("")))
    named = images.looks_like_image(url)
    failed = F.coalesce("_failed", F.lit(True))
    return (
        F.when(failed, F.when(named, url))
        .when(ok & kind.startswith("image/"), url)
        .when(F.col("_status").isin(401, 403, 405) & named, url)
        .when(ok & (kind == "") & named, url)
    )


def _header_table(header_checks: DataFrame) -> DataFrame:
    return first_by(
        header_checks.select(
            F.col("url").alias("_ask"),
            F.col("status").alias("_status"),
            F.col("content_type").alias("_content_type"),
            F.col("failed").alias("_failed"),
        ),
        ["_ask"],
        ["_failed", "_status", "_content_type"],
    )


def validate_images(
    items: DataFrame,
    header_checks: DataFrame,
    spread_by: list,
    columns=("poster_image_url", "backdrop_image_url"),
) -> DataFrame:
    """Keep image URLs that are https pictures.

    Placeholders and logos are dropped, known image hosts accepted; only the rest is looked
    up in `header_checks(url, status, content_type, failed)`. A URL without a check counts
    as a failed one: it stays only if it is named like a picture.
    """
    table = _header_table(header_checks)
    keep = items.columns
    for name in columns:
        df = items.withColumn("_url", images.secure_image(name))
        df = df.withColumn("_ask", F.when(~images.is_known_image_host("_url"), F.col("_url")))
        df = lookup(df, table, ["_ask"], spread_by)
        items = df.withColumn(
            name, F.when(F.col("_ask").isNull(), F.col("_url")).otherwise(_checked(F.col("_url")))
        ).select(*keep)
    return items


def page_images(pages: DataFrame, header_checks: DataFrame) -> DataFrame:
    """One validated picture per page URL: the first of the four meta patterns that holds up."""
    found = pages.select(
        "url",
        F.posexplode(F.array(*html.matches("html", vocab.META_IMAGE_PATTERNS))).alias("_try", "image"),
    ).where("image is not null")
    found = found.withColumn("image", F.regexp_replace("image", "^//", "https://"))
    found = found.withColumn(
        "image", F.coalesce(blank_to_null(images.upsize_thumbnail("image")), F.col("image"))
    )
    valid = validate_images(found, header_checks, ["url", "_try"], ("image",))
    return first_by(valid.where("image is not null"), ["url"], ["_try"]).drop("_try")


def enrich_from_pages(
    items: DataFrame, pages: DataFrame, header_checks: DataFrame, spread_by: list
) -> DataFrame:
    """Rows without a poster take the picture their page declares; each page is read once."""
    c = F.col
    page = F.coalesce(blank_to_null(c("article_url")), c("source_url"))
    lacks = blank_to_null(c("poster_image_url")).isNull()
    rows = items.withColumn("_ask", F.when(lacks, page))
    counts = key_counts(rows, ["_ask"])
    asked = counts.drop("_rows")

    direct = asked.where(urls.is_image_cdn("_ask")).select(
        c("_ask").alias("url"), images.upsize_thumbnail("_ask").alias("image")
    )
    direct = validate_images(direct, header_checks, ["url"], ("image",)).where("image is not null")
    wanted = pages.join(
        asked.where(~urls.is_image_cdn("_ask")).withColumnRenamed("_ask", "url"), "url", "left_semi"
    )
    read = page_images(first_by(wanted, ["url"], [F.length("html").desc(), "html"]), header_checks)

    table = direct.unionByName(read).select(c("url").alias("_ask"), c("image").alias("_image"))
    joined = lookup(rows, table, ["_ask"], spread_by, counts=counts)
    return joined.withColumns(
        {
            "backdrop_image_url": F.coalesce(
                blank_to_null(c("backdrop_image_url")), c("_image")
            ),
            "poster_image_url": F.coalesce(blank_to_null(c("poster_image_url")), c("_image")),
        }
    ).select(*items.columns)


def page_targets(pages: DataFrame) -> DataFrame:
    """One resolved content page per fetched URL.

    `pages(url, final_url, html)`. Candidates in order: the address the fetch ended at, the
    canonical link, og:url, and on aggregator pages every foreign link. The first concrete
    content page wins.
    """
    c = F.col
    base = pages.withColumn(
        "_base", urls.canonical_url(F.coalesce(blank_to_null(c("final_url")), c("url")))
    )
    aggregator = F.regexp_extract("_base", r"^https?://([^/?#]*)", 1).contains(vocab.AGGREGATOR_HOST)
    outbound = F.regexp_extract_all(
        "html", F.lit(r"""(?i)href=["'](https?://[^"']+)["']"""), F.lit(1)
    )
    candidates = F.concat(
        F.array(c("_base"), html.canonical_link("html"), html.og_url("html")),
        F.when(aggregator, outbound).otherwise(F.array().cast("array<string>")),
    )
    tries = base.select("url", "_base", F.posexplode(candidates).alias("_try", "_raw")).where(
        "_raw is not null"
    )
    tries = tries.withColumn(
        "_raw", F.when(c("_try") == 0, c("_raw")).otherwise(urls.absolute_href("_raw", "_base"))
    )
    tries = urls.with_page(tries, _raw=("target", "_ok"))
    foreign = ~F.regexp_extract("target", r"^https?://([^/?#]*)", 1).contains("google.")
    good = tries.where(c("_ok") & ((c("_try") < 3) | foreign))
    return first_by(good, ["url"], ["_try"]).select("url", "target")


def with_candidates(items: DataFrame) -> DataFrame:
    """Judge every candidate URL inside its own row: no explode and no shuffle.

    Adds `_tries`, an array of (url, canon, ok, agg) without image-host links.
    """
    df = items.withColumn("_u", F.transform("candidate_urls", urls.unwrap_redirect))
    df = df.withColumn("_c", F.transform("_u", urls.canonical_url))
    df = df.withColumn(
        "_f",
        F.transform(
            "_c",
            lambda u: F.struct(
                u.alias("canon"), urls.host_of(u).alias("host"), urls.page_path(u).alias("path")
            ),
        ),
    )
    df = df.withColumn(
        "_f",
        F.transform("_f", lambda f: F.struct(f["canon"], f["host"], f["path"], urls.path_parts(f["path"]))),
    )
    judged = F.zip_with(
        "candidate_urls",
        "_f",
        lambda raw, f: F.struct(
            raw.alias("url"),
            f["canon"].alias("canon"),
            urls.is_page(f["canon"], f["host"], f["path"], f["col4"]).alias("ok"),
            urls.is_aggregator(f["canon"]).alias("agg"),
            urls.is_image_cdn(f["canon"]).alias("cdn"),
        ),
    )
    return df.withColumn("_tries", F.filter(judged, lambda x: ~x["cdn"])).drop("_u", "_c", "_f")


def resolve_article_urls(
    items: DataFrame, pages: DataFrame, row_id: list[str], max_seeds: int = SEEDS_PER_ROW
) -> DataFrame:
    """Article and source URL of each row from its ordered `candidate_urls`.

    A candidate that already is a content page wins. Only rows without one try their first
    `max_seeds` candidates against the landed pages. The source URL is the article, else the
    first publisher link with a path, else the aggregator link, else any publisher link,
    else the entry's own link.
    """
    c = F.col

    def first(condition) -> Column:
        return F.try_element_at(F.filter("_tries", condition), F.lit(1))["canon"]

    judged = with_candidates(items)
    secure = F.filter("_tries", lambda x: x["canon"].startswith("https://"))
    judged = judged.withColumn("_tries_secure", secure)
    publisher_at = F.array_position(
        F.transform("_tries_secure", lambda x: F.coalesce(x["agg"], F.lit(False))), F.lit(False)
    )
    # Aggregator links count only where they come before the first publisher link.
    before = F.when(publisher_at > 0, publisher_at - 1).otherwise(F.size("_tries_secure"))
    judged = judged.withColumns(
        {
            "_page": first(lambda x: x["ok"]),
            "_pub": F.when(
                publisher_at > 0, F.get("_tries_secure", (publisher_at - 1).cast("int"))["canon"]
            ),
            "_news": F.when(before > 0, F.get("_tries_secure", F.lit(0))["canon"]),
        }
    )
    web = F.filter("_tries", lambda x: x["url"].rlike("^https?://"))
    seeds = judged.where("_page is null").select(
        *row_id, F.posexplode(F.slice(web, 1, max_seeds)).alias("_pos", "_seed")
    )
    seeds = seeds.select(*row_id, "_pos", c("_seed.url").alias("url"))
    counts = key_counts(seeds, ["url"])
    wanted = pages.join(counts.drop("_rows"), "url", "left_semi")
    targets = page_targets(first_by(wanted, ["url"], ["final_url", F.length("html").desc(), "html"]))
    resolved = first_by(
        lookup(seeds, targets, ["url"], [*row_id, "_pos"], how="inner", counts=counts),
        row_id,
        ["_pos"],
    ).select(*row_id, c("target").alias("_target"))

    # One row per item on both sides, so this join cannot run hot.
    df = judged.join(resolved, row_id, "left")
    df = pin(df, _own=urls.unwrap_redirect("link"))
    df = pin(df, _own=F.coalesce(
        blank_to_null(urls.canonical_url("_own")),
        F.when(
            F.trim("link").rlike("^(?:https?:)?//"), F.regexp_replace(F.trim("link"), "^//", "https://")
        ),
    ))
    df = df.withColumn("article_url", F.coalesce("_page", "_target"))
    df = df.withColumn(
        "source_url",
        F.coalesce(
            "article_url",
            F.when(urls.has_path("_pub"), c("_pub")),
            "_news",
            "_pub",
            "_own",
            F.lit(""),
        ),
    )
    return df.drop("_tries", "_tries_secure", "_page", "_pub", "_news", "_target", "_own")


def enrich_details(
    chart: DataFrame, details: DataFrame, on: str, spread_by: list
) -> DataFrame:
    """Chart rows with their detail page: external id, exact release date, poster.

    `details(<on>, external_id, release_text, poster)` has one row per page. A readable
    release text replaces the computed date; the external id decides the source URL.
    """
    c = F.col
    df = lookup(chart, details, [on], spread_by)
    release = F.coalesce(dates.parse_release_date("release_text"), c("release_date"))
    source = F.coalesce(
        F.concat(F.lit(vocab.TITLE_HOST + "/title/"), c("external_id"), F.lit("/")), c(on)
    )
    return df.withColumns(
        {
            "release_date": release,
            "year": F.regexp_extract(F.coalesce(release.cast("string"), F.lit("")), "20[0-9]{2}", 0),
            "source_url": source,
            "article_url": source,
            "poster_image_url": c("poster"),
            "backdrop_image_url": c("poster"),
        }
    ).drop("external_id", "release_text", "poster")
