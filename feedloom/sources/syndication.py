"""Landed syndication (RSS) files to entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.functions import images, text
from feedloom.functions.core import first_group, pin
from feedloom.operators.keyed import enumerate_positions
from feedloom.session import settle

_LINKED = "struct<_VALUE:string,_url:string,_type:string,_rel:string,_href:string>"
ITEM = (
    "title string, link string, guid string, pubDate string, description string, "
    f"source struct<_VALUE:string,_url:string>, "
    f"enclosure array<{_LINKED}>, `media:content` array<{_LINKED}>, "
    f"`media:thumbnail` array<{_LINKED}>"
)


_ATOM_LINK = "array<struct<_VALUE:string,_href:string,_rel:string,_type:string>>"
ATOM_ENTRY = (
    f"title string, link {_ATOM_LINK}, id string, published string, summary string, content string, "
    f"source struct<title:string,link:{_ATOM_LINK}>, `media:content` array<{_LINKED}>, `media:thumbnail` array<{_LINKED}>"
)


def _holders(spark: SparkSession, path: str, tags: list[str]) -> dict[str, list[str]]:
    """For each tag the files that hold such an element, as `_metadata.file_path` names them.

    The text is read from one `<` to the next, so a task holds no more than the text between two tags. At most one row
    per file and tag comes to the driver, which lists the files anyway.
    """
    read = spark.read.option("lineSep", "<").text(path).select("value", F.col("_metadata.file_path").alias("file"))
    tag = F.coalesce(*(F.when(F.col("value").startswith(t) & F.col("value").rlike(rf"^{t}[\s>]"), F.lit(t)) for t in tags))
    found = read.select("file", tag.alias("tag")).where("tag is not null").distinct().collect()
    return {t: sorted(r["file"] for r in found if r["tag"] == t) for t in tags}


def _records(spark: SparkSession, path: str, tag: str, schema: str, files: list[str] | None = None) -> DataFrame:
    """One row per element `tag`, with its file, the split it was read from and its place in the split.

    The end tag is the record separator of the text source, so Spark cuts files of any size into splits at any byte and
    every record is still read once and whole; Spark's own XML source reads each file in one task. A file without that
    end tag would be one record, and each of its splits would read it to the end: `files` are those to read.
    """
    read = spark.read.option("lineSep", f"</{tag}>").text(path)
    if files is not None:
        read = read.where(F.col("_metadata.file_path").isin(files))
    record = F.regexp_extract("value", rf"(?s)<{tag}[\s>].*$", 0)
    found = pin(
        read.select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_row"),
        ).where(F.col("value").rlike(rf"<{tag}[\s>]")),
        _xml=F.concat(record, F.lit(f"</{tag}>")),
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    parsed = pin(found, _x=F.from_xml("_xml", f"{schema}, _broken string", options))
    return parsed.select("_x.*", "file", "_block", "_row")


def atom_items(entries: DataFrame) -> DataFrame:
    """Atom entries in the columns of RSS items.

    The first link without a relation or with `alternate` is the entry link, those marked `enclosure` are enclosures,
    and the summary is the content where there is none.
    """
    none = F.array().cast(_ATOM_LINK)

    def alternate(links: Column) -> Column:
        own = F.filter(links, lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
        return F.try_element_at(own, F.lit(1))["_href"]

    def linked(x: Column) -> Column:
        return F.struct(x["_VALUE"].alias("_VALUE"), x["_href"].alias("_url"), x["_type"].alias("_type"), x["_rel"].alias("_rel"), x["_href"].alias("_href"))

    links = F.coalesce(F.col("link"), none)
    source = F.struct(F.col("source.title").alias("_VALUE"), alternate(F.col("source.link")).alias("_url"))
    kept = [c for c in entries.columns if c not in ("link", "id", "published", "summary", "content", "source")]
    return entries.select(
        *(F.col(f"`{c}`") for c in kept),
        alternate(links).alias("link"),
        F.col("id").alias("guid"),
        F.col("published").alias("pubDate"),
        F.coalesce("summary", "content").alias("description"),
        F.when(F.col("source").isNotNull(), source).alias("source"),
        F.transform(F.filter(links, lambda x: x["_rel"] == "enclosure"), linked).alias("enclosure"),
        F.transform(links, lambda x: x["_href"]).alias("links"),
    )


def _items(spark: SparkSession, path: str, rss_files: list[str], atom_files: list[str]) -> DataFrame:
    """The RSS items of some files and the Atom entries of others in the same columns, written once."""
    rss = _records(spark, path, "item", ITEM, rss_files)
    rss = rss.withColumn("links", F.coalesce(F.col("enclosure")["_url"], F.array().cast("array<string>")))
    atom = atom_items(_records(spark, path, "entry", ATOM_ENTRY, atom_files))
    return settle(rss.unionByName(atom), "items")


def _placed(items: DataFrame) -> DataFrame:
    """Settled items of files that hold one kind, with their place in the file.

    A task reads its splits one after the other and writes them as they come, so the items of a split lie together in
    the written file: their places follow from its row numbers and one small row per split, and no text is shuffled.
    """
    lying = items.select("*", F.col("_metadata.file_path").alias("_part"), F.col("_metadata.row_index").alias("_at"))
    split = ["file", "_block", "_part"]
    runs = lying.groupBy(*split).agg(F.min("_at").alias("_first"), F.min("_row").alias("_lead"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy("file").orderBy("_block", "_lead").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1
    shifts = settle(runs.select(*split, shift.alias("_shift")), "splits")
    numbered = lying.join(shifts, split).withColumn("entry_ord", F.col("_at") + F.col("_shift"))
    return numbered.select(*items.columns, "entry_ord")


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """One row per RSS `<item>` and Atom `<entry>` with `file` and `entry_ord`, its place in the file from 1; `_broken` has malformed ones.

    Large files are split over tasks and read by the end tag of what they hold; a malformed item does not touch the
    rest of its file. Items are written once; they are numbered within their split and shifted by the counts of the
    file's earlier splits, so a file of any size is never gathered in one task. A file that holds both kinds is read
    once for each.
    """
    holders = _holders(spark, path, ["item", "entry"])
    rss, atom = (set(holders[t]) for t in ("item", "entry"))
    placed = _placed(_items(spark, path, sorted(rss - atom), sorted(atom - rss)))
    if both := sorted(rss & atom):
        mixed = enumerate_positions(_items(spark, path, both, both), ["file"], ["_block", "_row"], F.col("_block"), "entry_ord")
        placed = placed.unionByName(mixed)
    return placed.drop("_block", "_row")


def read_syndication(spark: SparkSession, path: str) -> DataFrame:
    """The well-formed items of all files as entries, in file order (`entry_ord` counts from 1 in each file)."""
    return syndication_entries(read_items(spark, path).where("_broken is null").drop("_broken"))


def broken_items(spark: SparkSession, path: str) -> DataFrame:
    """Number of malformed items per file, for the run's report."""
    items = read_items(spark, path)
    return items.groupBy("file").agg(F.count_if(F.col("_broken").isNotNull()).alias("n_broken"))


def syndication_entries(raw: DataFrame) -> DataFrame:
    """Item fields to entry columns: texts, candidate URLs in order, picture URL."""
    c = F.col
    keep = [n for n in raw.columns if n in ("file", "entry_ord", "source_ord", "feed")]
    summary = F.coalesce(c("description"), F.lit(""))
    return raw.select(
        *keep,
        F.coalesce("title", F.lit("")).alias("title"),
        summary.alias("summary"),
        c("pubDate").alias("published"),
        c("guid").alias("id"),
        F.coalesce("link", F.lit("")).alias("link"),
        c("source._url").alias("source_href"),
        candidate_urls(summary, c("guid"), c("links"), c("link"), c("source._url")).alias(
            "candidate_urls"
        ),
        media_url(
            c("media:content")["_url"], c("media:thumbnail")["_url"], c("enclosure"), summary
        ).alias("media_url"),
    )


def _href(c: Column) -> Column:
    """http(s) form of a link, NULL for anything else."""
    h = F.regexp_replace(text.strip(c), "^//", "https://")
    return F.when(h.rlike("^https?://"), h)


def candidate_urls(summary: Column, guid: Column, links: Column, link: Column, source: Column) -> Column:
    """Links of an entry in order of preference, without repeats.

    Anchors of the summary, the identifier, link elements, the entry link, the outlet.
    """
    hrefs = F.regexp_extract_all(summary, F.lit(r"""(?i)href=["']([^"']+)["']"""), F.lit(1))
    none = F.array().cast("array<string>")
    identifier = F.when(F.trim(guid).startswith("http"), _href(guid))
    listed = F.concat(
        F.transform(hrefs, _href),
        F.array(identifier),
        # A feed parser lists the entry link first among the links.
        F.array(_href(link)),
        F.transform(F.coalesce(links, none), _href),
        F.array(_href(source)),
    )
    return F.array_distinct(F.array_compact(listed))


def media_url(contents: Column, thumbnails: Column, enclosures: Column, summary: Column) -> Column:
    """Picture of an entry: media content, thumbnail, image enclosure, image tag, lazy image."""

    def web(c: Column) -> Column:
        return F.when(c.rlike("^https?://"), c)

    def first_web(urls: Column) -> Column:
        return F.try_element_at(F.filter(urls, lambda u: u.rlike("^https?://")), F.lit(1))

    pictured = F.filter(
        enclosures,
        lambda e: F.lower(e["_type"]).contains("image") & e["_url"].rlike("^https?://"),
    )
    tag = F.regexp_replace(
        text.strip(first_group(summary, r"""(?i)<img[^>]+src=["']([^"']+)["']""")), "^//", "https://"
    )
    lazy = first_group(summary, r"""(?i)<img[^>]+(?:data-src|srcset)=["']([^"']+)["']""")
    lazy = F.split_part(text.strip(F.split_part(lazy, F.lit(","), F.lit(1))), F.lit(" "), F.lit(1))
    lazy = F.regexp_replace(lazy, "^//", "https://")
    found = F.coalesce(
        first_web(contents),
        first_web(thumbnails),
        F.try_element_at(pictured, F.lit(1))["_url"],
        web(tag),
        web(lazy),
    )
    grown = F.coalesce(F.nullif(images.upsize_thumbnail(found), F.lit("")), found)
    return F.when(~images.is_logo(grown), grown)


def entry_texts(entries: DataFrame) -> DataFrame:
    """Overview of entries and `merged`, their lower-case title and overview.

    The one Python step, for character references.
    """
    read = entries.withColumn("overview", text.sanitize_overview("summary"))
    return pin(read, merged=text.merged_text("title", "overview"))


def to_raw_items(entries: DataFrame, platform: Column | str, default_type: Column | str) -> DataFrame:
    """Entries (with resolved URLs) as raw records."""
    c = F.col
    platform = F.lit(platform) if isinstance(platform, str) else platform
    return entries.select(
        *[n for n in ("feed", "source", "source_ord", "page_ord", "entry_ord") if n in entries.columns],
        text.sanitize_title("title").alias("title"),
        # The year of a news entry is the year it was published.
        text.parse_year("published").cast("string").alias("year"),
        text.extract_type("merged", default_type).alias("type"),
        platform.alias("platform"),
        c("published").alias("release_date"),
        c("published").alias("published_raw"),
        "overview",
        text.extract_terms("merged").alias("genres"),
        c("media_url").alias("poster_image_url"),
        c("media_url").alias("backdrop_image_url"),
        "article_url",
        "source_url",
    )
