"""Crawled HTML tables to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom import vocab
from feedloom.functions import dates, html, images, text, urls
from feedloom.functions.core import blank_to_null, pin
from feedloom.functions.core import keep as keep_rows


def page_titles(pages: DataFrame) -> DataFrame:
    """Title, first heading and language of each page; the markup is dropped."""
    return pages.withColumns(
        {
            "title": html.tag_text("html", "title"),
            "heading": html.tag_text("html", "h1"),
            "lang": html.attribute("html", "html", "lang"),
        }
    ).drop("html")


def extract_links(pages: DataFrame, keep: list[str]) -> DataFrame:
    """One row per anchor with its position and its address against the page URL."""
    return pages.select(*keep, "url", F.posexplode(html.all_hrefs("html")).alias("pos", "href")).select(
        *keep, "pos", "href", urls.absolute_href("href", "url").alias("target")
    )


def extract_chart_links(pages: DataFrame, keep: list[str], selectors: list[str]) -> DataFrame:
    """Titled anchors by the first link pattern that finds any on the page.

    `selectors` are patterns with two groups (address, inner markup), in order of preference.
    List numbers are stripped and titles below two characters skipped.
    """
    found = F.coalesce(
        *[
            F.nullif(_anchors(pattern), F.array().cast("array<struct<href:string,title:string>>"))
            for pattern in selectors
        ]
    )
    return pages.select(*keep, "url", F.posexplode(found).alias("pos", "_a")).select(
        *keep, "pos", F.col("_a.title").alias("title"), urls.absolute_href("_a.href", "url").alias("target")
    )


def _anchors(pattern: str) -> Column:
    hrefs = F.regexp_extract_all("html", F.lit(pattern), F.lit(1))
    inner = F.regexp_extract_all("html", F.lit(pattern), F.lit(2))
    pairs = F.zip_with(
        hrefs,
        inner,
        lambda h, t: F.struct(h.alias("href"), text.strip_list_number(html.text_of(t)).alias("title")),
    )
    return F.filter(pairs, lambda p: F.length(p["title"]) >= 2)


def extract_json_ld(pages: DataFrame, keep: list[str]) -> DataFrame:
    """Named nodes of every linked-data block: the members of `@graph`, else the object itself.

    Blocks that are no JSON give nothing.
    """
    blocks = F.regexp_extract_all(
        "html",
        F.lit(r"""(?is)<script[^>]*type=["']application/ld\+json["'][^>]*>(.*?)</script>"""),
        F.lit(1),
    )
    parsed = pages.select(*keep, F.posexplode(blocks).alias("block", "_json")).withColumn(
        "_doc", F.try_parse_json("_json")
    )
    graph = F.try_variant_get("_doc", "$['@graph']", "array<variant>")
    nodes = parsed.where("_doc is not null").select(
        *keep, "block", F.posexplode(F.coalesce(graph, F.array("_doc"))).alias("node", "_node")
    )

    def field(path: str) -> Column:
        return F.try_variant_get("_node", path, "string")

    def is_text(path: str) -> Column:
        return F.schema_of_variant(F.try_variant_get("_node", path, "variant")) == "STRING"

    genre = F.coalesce(
        F.try_variant_get("_node", "$.genre", "array<string>"),
        F.when(field("$.genre").isNotNull(), F.array(field("$.genre"))),
        F.array().cast("array<string>"),
    )
    url = field("$.url")
    named = nodes.where(is_text("$.name") & (F.length(field("$.name")) > 0))
    return named.select(
        *keep,
        "block",
        "node",
        text.strip(field("$.name")).alias("title"),
        field("$.datePublished").alias("release_date"),
        blank_to_null(field("$.description")).alias("overview"),
        genre.alias("genres"),
        field("$.image").alias("poster_image_url"),
        field("$.aggregateRating.ratingValue").alias("rating"),
        F.when(url.startswith("/"), F.concat(F.lit(vocab.TITLE_HOST), url))
        .otherwise(blank_to_null(url))
        .alias("source_url"),
    )


def extract_rows(
    pages: DataFrame, keep: list[str], container: str = "table", row: str = "tr", cell: str = "td", skip: int = 0
) -> DataFrame:
    """Rows of all such containers, in page order, with their cells by position; see `html.rows_of` for nested ones.

    `row_pos` counts from 0 over the page, including skipped rows; `skip` leaves out the page's first rows. Cells stay markup; `html.text_of` reads them.
    """
    rows = pages.where(F.col("html").rlike(rf"(?i)<{container}\b"))
    rows = rows.select(*keep, F.posexplode(html.container_rows("html", container, row, cell)).alias("row_pos", "cells"))
    return rows.where(F.col("row_pos") >= skip)


def chart_rows(pages: DataFrame, keep: list[str], run_date: Column, min_cells: int = 10) -> DataFrame:
    """Box-office table: title, page, theaters, days in release and distributor per row.

    Columns are taken by position: release 2, theaters 6, days 9, distributor 10. Rows with
    fewer cells, without a release link or with a title below two characters are skipped.
    """
    c = F.col

    def cell_text(i: int) -> Column:
        return F.coalesce(html.text_of(F.get("cells", F.lit(i))), F.lit(""))

    link = rf"""(?is)<a\b[^>]*href=["']([^"']*{vocab.CHART_LINK_PART}[^"']*)["'][^>]*>(.*?)</a>"""
    rows = keep_rows(extract_rows(pages, keep, skip=1), F.size("cells") >= min_cells)
    release = F.get("cells", F.lit(2))
    rows = pin(
        rows,
        title=html.text_of(F.regexp_extract(release, link, 2)),
        _href=F.regexp_extract(release, link, 1),
    )
    rows = rows.where((c("_href") != "") & (F.length("title") >= 2))
    page = F.when(c("_href").startswith("/"), F.concat(F.lit(vocab.CHART_HOST), c("_href"))).otherwise(
        c("_href")
    )
    rows = pin(rows, _theaters=cell_text(6), _days=cell_text(9), distributor=cell_text(10))
    return rows.select(
        *keep,
        "row_pos",
        "title",
        F.regexp_replace(page, r"/*(?:\?.*)?$", "").alias("page_url"),
        dates.release_from_days(run_date, "_days").alias("release_date"),
        F.coalesce(F.replace("_theaters", F.lit(","), F.lit("")).try_cast("int"), F.lit(0)).alias(
            "theaters"
        ),
        "distributor",
    )


def theatrical_items(chart: DataFrame) -> DataFrame:
    """Enriched chart rows as raw records."""
    return chart.withColumns(
        {
            "type": F.lit("movie"),
            "platform": F.lit("cinema"),
            "release_date": F.col("release_date").cast("string"),
            "published_raw": F.col("release_date").cast("string"),
            "overview": text.theatrical_overview(F.col("distributor"), F.col("theaters")),
            "genres": F.array().cast("array<string>"),
        }
    ).drop("theaters", "distributor", "page_url", "row_pos")


def label_values(
    spans: DataFrame, by: list[str], pos: str, value: str, labels=vocab.DETAIL_LABELS
) -> DataFrame:
    """Value of each label: the non-empty, non-label span right after it; the last one wins.

    Spans meet their predecessor by an equi-join on (page, position), so a page with very
    many spans is spread like any other rows.
    """
    c = F.col
    before = (
        spans.where(text.strip(value).isin(*labels))
        .select(*by, (c(pos) + 1).alias(pos), text.strip(value).alias("label"))
    )
    hit = spans.select(*by, pos, text.strip(value).alias("value")).where(
        (c("value") != "") & ~c("value").isin(*labels)
    )
    return (
        hit.join(before, [*by, pos])
        .groupBy(*by, "label")
        .agg(F.max_by("value", pos).alias("value"))
    )


def page_label_values(pages: DataFrame, keep: list[str], labels=vocab.DETAIL_LABELS) -> DataFrame:
    """`label_values` within each page's own span list: array work, no shuffle."""
    spans = F.transform(html.all_elements("html", "span"), html.text_of)
    df = pages.select(*keep, spans.alias("_spans"))

    def value_of(label: str) -> Column:
        after = F.zip_with(
            F.col("_spans"),
            F.slice(F.col("_spans"), F.lit(2), F.greatest(F.size("_spans"), F.lit(1))),
            lambda a, b: F.when((a == label) & (b != "") & ~b.isin(*labels), b),
        )
        return F.try_element_at(F.array_compact(after), F.lit(-1))

    return df.select(*keep, *[value_of(x).alias(x.lower().replace(" ", "_")) for x in labels])


def detail_pages(pages: DataFrame) -> DataFrame:
    """Detail pages to (page_url, external_id, release_text, poster)."""
    c = F.col
    texts = page_label_values(pages, ["url", "html"])
    poster = html.first_group(
        c("html"),
        rf"""(?is)<img\b[^>]*src=["']([^"']*{vocab.DETAIL_POSTER_PART}[^"']*)["']""",
    )
    return texts.select(
        c("url").alias("page_url"),
        html.first_group(c("html"), r"""(?is)<a\b[^>]*href=["'][^"']*imdb\.com/title/(tt\d+)""").alias(
            "external_id"
        ),
        c("release_date").alias("release_text"),
        images.detail_poster(poster).alias("poster"),
    )


