"""JSON documents embedded in pages or landed from chart replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom import vocab
from feedloom.functions import dates, images, text
from feedloom.functions.core import blank_to_null, first_group, lookup_map, pin
from feedloom.functions.text import strip
from feedloom.session import settle

_STATE = (
    "struct<props:struct<pageProps:struct<data:struct<totalPages:int,"
    "data:array<struct<videoID:string,title1:string,title2:string,startTime:double,image:string>>>>>>"
)
_EDGES = (
    "struct<edges:array<struct<node:struct<objectType:string,content:struct<title:string,"
    "shortDescription:string,fullPath:string,posterUrl:string,originalReleaseYear:int,"
    "genres:array<struct<shortName:string>>>>>>>"
)


def page_state(html: Column | str) -> Column:
    """The embedded page-state JSON as text, NULL where there is none."""
    return first_group(F.col(html) if isinstance(html, str) else html, "(?s)" + vocab.PAGE_STATE_PATTERN)


def extract_page_state(pages: DataFrame, keep: list[str]) -> DataFrame:
    """Items of the page-state list; pages without (valid) state give no rows."""
    c = F.col
    parsed = pages.select(*keep, F.from_json(page_state("html"), _STATE).alias("_s"))
    data = c("_s.props.pageProps.data")
    items = parsed.select(
        *keep,
        F.coalesce(data["totalPages"], F.lit(1)).alias("total_pages"),
        F.posexplode(data["data"]).alias("pos", "_i"),
    )
    title = strip(F.coalesce(blank_to_null(c("_i.title1")), c("_i.title2"), F.lit("")))
    return (
        items.select(
            *keep,
            "total_pages",
            "pos",
            c("_i.videoID").alias("video_id"),
            title.alias("title"),
            dates.epoch_ms_date("_i.startTime").alias("release_date"),
            F.regexp_replace("_i.image", "^//", "https://").alias("poster_image_url"),
        )
        .where((c("title") != "") & c("video_id").isNotNull())
        .withColumn("source_url", F.concat(F.lit(vocab.WATCH_URL), "video_id"))
    )


#: Depths of a tree that one job goes down.
DEPTHS = 3


def _object(node: Column) -> Column:
    return F.try_variant_get(node, "$", "map<string,variant>")


def _array(node: Column) -> Column:
    return F.try_variant_get(node, "$", "array<variant>")


def _string(node: Column) -> Column:
    """The text of a JSON string, NULL for every other value."""
    return F.when(F.schema_of_variant(node) == "STRING", F.try_variant_get(node, "$", "string"))


def _deeper(nodes: DataFrame, keep: list[str], wanted, look, kind: str) -> DataFrame:
    """What was found (`_path`, `_json`, `_found`), and the objects and arrays right inside the open nodes, which are then the open ones.

    `look` gives what an open node has, of type `kind`, from its `_fields` and `_entries`; nodes without it are not passed on. The
    JSON text keeps the order of keys, and the variant tells an object from a text that looks like one. Of a repeated key the
    last value counts.
    """
    opens = r"^\s*[\[{]"
    text = F.when(F.col("_open"), F.col("_json"))
    # Parsed once per node; only nodes with something inside that is wanted get here open.
    rows = pin(nodes, _node=F.try_parse_json(text))
    rows = pin(
        rows,
        _fields=_object(F.col("_node")),
        _items=_array(F.col("_node")),
        _entries=F.map_entries(F.from_json(F.when(text.rlike(r"^\s*\{"), text), "map<string,string>")),
        _texts=F.from_json(F.when(text.rlike(r"^\s*\["), text), "array<string>"),
    )
    rows = pin(rows, _said=F.coalesce("_found", F.when(F.col("_fields").isNotNull(), look)))

    def later(e, i):
        return F.exists(F.slice("_entries", i + 2, F.size("_entries")), lambda x: x["key"] == e["key"])

    def inner(at: Column, json: Column, node: Column) -> Column:
        # A text that merely looks like an object or array is neither.
        holds = _object(node).isNotNull() | _array(node).isNotNull()
        path = F.concat("_path", F.array(at))
        new = F.struct(path.alias("_path"), json.alias("_json"), F.lit(True).alias("_open"), F.lit(None).cast(kind).alias("_found"))
        return F.when(holds, new)

    placed = F.transform(
        "_entries",
        lambda e, i: F.when(
            e["value"].rlike(opens) & wanted(e["value"]) & ~later(e, i), inner(i, e["value"], F.element_at("_fields", e["key"]))
        ),
    )
    listed = F.transform("_texts", lambda t, i: F.when(t.rlike(opens) & wanted(t), inner(i, t, F.get("_items", i))))
    inside = F.when(F.col("_fields").isNotNull(), placed).when(F.col("_items").isNotNull(), listed)
    itself = F.when(F.col("_said").isNotNull(), F.struct("_path", "_json", F.lit(False).alias("_open"), F.col("_said").alias("_found")))
    none = F.array().cast(f"array<struct<_path:array<int>,_json:string,_open:boolean,_found:{kind}>>")
    return rows.select(*keep, F.inline(F.array_compact(F.concat(F.array(itself), F.coalesce(inside, none)))))


def _walk(docs: DataFrame, keep: list[str], text: str, mentions, words: list[str], look: Column, kind: str) -> DataFrame:
    """What `look` finds in the objects of JSON texts, at any depth: rows (*keep, _path, _json, _found).

    `look`, a column of type `kind` over an object's `_fields` (values by key) and `_entries` (keys in order), is null where there
    is nothing. `mentions` says which texts may hold `words`; those that neither mention them nor hold an escape that may stand
    for a character of them are not opened. A job goes some depths down and writes what it met to the shared folder. Broken JSON
    gives nothing.
    """
    spark = docs.sparkSession
    # Only these characters have an escape beside the one by number, which any may have.
    escape = "\\" if any(c in '"\\/' or c < " " for w in words for c in w) else "\\u"

    def wanted(json: Column) -> Column:
        return mentions(json) | json.contains(escape)

    repeated = "spark.sql.variant.allowDuplicateKeys"
    before = spark.conf.get(repeated)
    spark.conf.set(repeated, "true")
    try:
        root = docs.select(
            *keep,
            F.array().cast("array<int>").alias("_path"),
            F.col(text).alias("_json"),
            F.lit(True).alias("_open"),
            F.lit(None).cast(kind).alias("_found"),
        )
        rows, met = root.where(wanted(F.col("_json"))), None
        while True:
            for _ in range(DEPTHS):
                rows = _deeper(rows, keep, wanted, look, kind)
            level = settle(rows, "json")
            closed = level.where("NOT _open")
            met = closed if met is None else met.unionByName(closed)
            rows = level.where("_open")
            if rows.isEmpty():
                break
        return met.drop("_open")
    finally:
        spark.conf.set(repeated, before)


def find_nodes(docs: DataFrame, keep: list[str], text: str, key: str, value: str) -> DataFrame:
    """Every object, at any depth, whose `key` has the text `value`; broken JSON gives none.

    One row per object with its JSON text and `path`, its place in reading order.
    """
    hit = F.when(_string(F.element_at("_fields", F.lit(key))) == value, True)
    nodes = _walk(docs, keep, text, lambda t: t.contains(value), [value], hit, "boolean")
    return nodes.select(*keep, F.col("_path").alias("path"), F.col("_json").alias("json"))


def first_values(docs: DataFrame, keep: list[str], text: str, keys: list[str]) -> DataFrame:
    """First non-blank text stored under one of `keys` anywhere in a JSON text, in reading order: rows (*keep, value).

    `keep` names the row; rows without such a text are left out.
    """

    def mentions(t: Column) -> Column:
        hit = F.lit(False)
        for k in keys:
            hit = hit | t.contains(f'"{k}"')
        return hit

    def said(k: str) -> Column:
        value = blank_to_null(strip(_string(F.element_at("_fields", F.lit(k)))))
        at = F.array_position(F.transform("_entries", lambda e: e["key"]), F.lit(k)) - 1
        return F.struct(at.cast("int").alias("at"), value.alias("value"))

    values = F.filter(F.array(*map(said, keys)), lambda x: x["value"].isNotNull())
    nodes = _walk(docs, keep, text, mentions, keys, F.when(F.size(values) > 0, values), "array<struct<at:int,value:string>>")
    rows = nodes.select(*keep, "_path", F.inline("_found"))
    return rows.groupBy(*keep).agg(F.min_by("value", F.concat("_path", F.array("at"))).alias("value"))


def first_value_of(document: Column | str, keys: list[str]) -> Column:
    """First non-blank text stored under one of the keys, anywhere in a JSON text."""
    names = "|".join(keys)
    pattern = rf'(?<!\\)"(?:{names})"\s*:\s*"([^"\\]*[^"\\\s][^"\\]*)"'
    return strip(first_group(F.col(document) if isinstance(document, str) else document, pattern))


def card_items(cards: DataFrame, keep: list[str]) -> DataFrame:
    """Card nodes (from `find_nodes`) that lead to a title page, as raw records."""
    c = F.col
    card = "struct<title:string,url:string,imageVariants:string,isEpisode:boolean,_id:string>"
    # Parsed once: a projection would parse it anew for every field.
    df = pin(cards.select(*keep, "path", "json"), _c=F.from_json("json", card))
    title = strip(F.coalesce("_c.title", F.lit("")))
    anchor = F.concat(F.lit("#"), blank_to_null(strip("_c._id")))
    return df.where(strip("_c.url").startswith(vocab.CARD_PATH_PREFIX)).select(
        *keep,
        "path",
        title.alias("title"),
        F.when(c("_c.isEpisode"), "series").otherwise("movie").alias("type"),
        F.lit("disney_plus").alias("platform"),
        images.card_poster(first_value_of("_c.imageVariants", ["ripcutId", "imageId"])).alias(
            "poster_image_url"
        ),
        F.concat(F.lit(vocab.CARD_LIST_URL), F.coalesce(anchor, F.lit(""))).alias("source_url"),
        F.lit(vocab.CARD_LIST_URL).alias("article_url"),
        F.lit("platform_release").alias("content_type"),
    ).where("title <> ''")


def genre_names(codes: Column) -> Column:
    """Genre codes to names; unknown codes stay."""
    table = lookup_map(vocab.GENRE_CODES)
    return F.transform(
        F.filter(codes, lambda g: F.coalesce(g, F.lit("")) != ""),
        lambda g: F.coalesce(F.try_element_at(table, g), g),
    )


def flatten_chart_edges(replies: DataFrame, keep: list[str], reply: str = "json") -> DataFrame:
    """Chart replies to one row per listed title, in chart order (`pos`)."""
    c = F.col
    edges = replies.select(
        *keep, F.posexplode(F.from_json(reply, _EDGES)["edges"]).alias("pos", "_e")
    )
    content = c("_e.node.content")
    path = blank_to_null(content["fullPath"])
    return edges.select(
        *keep,
        "pos",
        c("_e.node.objectType").alias("object_type"),
        strip(F.coalesce(content["title"], F.lit(""))).alias("title"),
        content["originalReleaseYear"].alias("year"),
        F.coalesce(F.concat(F.lit(vocab.LISTING_HOST), path), F.lit("")).alias("source_url"),
        images.listing_poster(content["posterUrl"]).alias("poster_image_url"),
        genre_names(content["genres"]["shortName"]).alias("genres"),
        content["shortDescription"].alias("description"),
    )


def chart_items(ranked: DataFrame, platform_label: Column, country: str = "TR") -> DataFrame:
    """Ranked chart rows (with `rank` and `type`) as raw records; the rank goes into the overview."""
    c = F.col
    lead = F.concat(
        F.lit("Top "), c("rank").cast("string"), F.lit(" trending "), c("type"), F.lit(" on "),
        platform_label, F.lit(f" ({country})."),
    )
    year = c("year").cast("string")
    return ranked.withColumns(
        {
            "overview": text.listing_overview(lead, c("description")),
            "year": year,
            "release_date": year,
            "published_raw": year,
            "backdrop_image_url": c("poster_image_url"),
            "article_url": c("source_url"),
            "content_type": F.lit("platform_release"),
        }
    ).drop("description")
