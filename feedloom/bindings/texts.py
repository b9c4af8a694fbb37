"""Queries over documents, labels and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.bindings import sql as q
from feedloom.bindings.registry import query
from feedloom.functions import text
from feedloom.functions.core import pin
from feedloom.operators import dedupe, fingerprint, gates, keyed, rank
from feedloom.sources import pages as sources

# Word lists that occur in the given documents, as substrings and as whole words.
ALLOW = ("the", "tion")
DENY = ("license", "idiot", "deal", "tv")
SIGNALS = ("er", "on")
EXTRA = ("the", "la ", "die ")
EXCLUDE = ("license", "copyright")
TERMS = ("The", "Tion", "License", "Keit", "Ción", "Eau", "Copyright")

SRC_ORD = "CAST(substr(source, 4) AS INTEGER)"


def _src_ord():
    return F.substring("source", 4, 10).cast("int")


@query(
    "summary_clamp",
    f"SELECT doc_id, {q.clamp('text', 'none')} AS summary FROM documents",
)
def summary_clamp(t):
    docs = pin(t.documents.select("doc_id", "text"), text=text.clean_text("text", "none"))
    return docs.select("doc_id", text.clamp_summary("text").alias("summary"))


def _titled(t):
    """Documents as items: the first line is the title, the whole text the overview."""
    first_line = F.split_part("text", F.lit("\n"), F.lit(1))
    return t.documents.select(
        "doc_id", "lang", "source", first_line.alias("title"), F.col("text").alias("overview")
    )


_ITEM_TEXT = f"lower({q.squeeze(q.squeeze('split_part(text, chr(10), 1)'))} || ' ' || {q.squeeze('text')})"


@query(
    "topic_gate",
    f"""WITH d AS (SELECT doc_id, {_ITEM_TEXT} AS body FROM documents)
    SELECT doc_id FROM d WHERE NOT {q.has_word('body', DENY)} AND {q.contains_any('body', ALLOW)}""",
)
def topic_gate(t):
    return gates.topic_gate(_titled(t), ALLOW, DENY).select("doc_id")


@query(
    "relevance_gate",
    f"""WITH d AS (SELECT doc_id, source, lower(split_part(text, chr(10), 1) || ' ' || text) AS body FROM documents)
    SELECT doc_id FROM d WHERE NOT {q.contains_any('body', EXCLUDE)} AND {q.contains_any('body', SIGNALS)}
      AND {q.contains_any('body', EXTRA)}
      AND (contains('https://' || source || '.example/', 'src1') OR {q.contains_any('body', ['wh', 'ß'])})""",
)
def relevance_gate(t):
    items = _titled(t).withColumn("source_url", F.concat(F.lit("https://"), "source", F.lit(".example/")))
    rules = {
        "exclude": EXCLUDE,
        "signals": SIGNALS,
        "extra_signals": EXTRA,
        "trusted": ["SRC1"],
        "include": ["wh", "ß"],
    }
    return gates.relevance_gate(items, rules).select("doc_id")


_SCORE = f"""(CASE WHEN contains(lower(source), 'src1') THEN 3 ELSE 0 END
  + CASE WHEN quality = 1 THEN 2 ELSE 0 END + CASE WHEN quality IS NOT NULL THEN 2 ELSE 0 END
  + CASE WHEN toxic = 0 THEN 2 ELSE 0 END
  + CASE WHEN NOT {q.has_word('body', DENY)} AND {q.contains_any('body', ALLOW)} THEN 2 ELSE 0 END
  - CASE WHEN {q.contains_any('raw', ['worthless', 'tz'])} THEN 3 ELSE 0 END
  - CASE WHEN lower(trim(title)) IN ('la.', 'der.') THEN 3 ELSE 0 END
  - CASE WHEN length(trim(title)) < 8 THEN 4 ELSE 0 END)"""

_SCORED = f"""WITH d AS (SELECT doc_id, source, split_part(text, chr(10), 1) AS title,
    lower(split_part(text, chr(10), 1) || ' ' || text) AS raw, {_ITEM_TEXT} AS body FROM documents),
  j AS (SELECT d.*, quality, toxic FROM d LEFT JOIN labels USING (doc_id)),
  s AS (SELECT doc_id, {_SCORE} AS quality_score FROM j) """

_LISTS = {
    "allow": ALLOW,
    "deny": DENY,
    "clickbait": ("worthless", "tz"),
    "generic": ("la.", "der."),
    "trusted": ("src1",),
}


def _labelled(t):
    labelled = _titled(t).join(t.labels, "doc_id", "left")
    return labelled.select(
        "doc_id",
        F.col("lang").alias("feed"),
        "title",
        "overview",
        F.col("source").alias("source_domain"),
        F.when(F.col("quality") == 1, "picture").alias("poster_image_url"),
        F.when(F.col("quality").isNotNull(), "time").alias("published_at"),
        F.when(F.col("toxic") == 0, "link").alias("article_url"),
    )


@query("quality_score", _SCORED + "SELECT doc_id, quality_score FROM s")
def quality_score(t):
    return gates.with_quality(_labelled(t), **_LISTS).select(
        "doc_id", F.col("quality").alias("quality_score")
    )


@query("quality_gate", _SCORED + "SELECT doc_id FROM s WHERE quality_score >= 3")
def quality_gate(t):
    return gates.quality_gate(_labelled(t), **_LISTS).select("doc_id")


@query(
    "classify_type",
    """SELECT doc_id,
      CASE WHEN contains(lower(text), 'documentary') THEN 'documentary' WHEN contains(lower(text), 'anime') THEN 'anime'
        WHEN regexp_matches(lower(text), 'season|episode|series|tv') THEN 'series'
        WHEN regexp_matches(lower(text), 'movie|film') THEN 'movie' ELSE lang END AS extracted,
      CASE WHEN contains(lower(text), 'doc') THEN 'documentary' WHEN contains(lower(text), 'anime') THEN 'anime'
        WHEN regexp_matches(lower(text), 'tv|series|show|season|episode') THEN 'series' ELSE 'movie' END AS normalized
    FROM documents""",
)
def classify_type(t):
    docs = pin(
        t.documents.select("doc_id", "lang", "text"), text=F.lower("text"), label=text.type_label("text")
    )
    return docs.select(
        "doc_id",
        text.extract_type("text", F.col("lang")).alias("extracted"),
        text.normalize_type("label").alias("normalized"),
    )


@query(
    "tag_terms",
    f"""SELECT doc_id, array_to_string(list_filter({q.array(TERMS)},
      lambda w: contains(lower(text), lower(w))), ',') AS terms FROM documents""",
)
def tag_terms(t):
    docs = pin(t.documents.select("doc_id", "text"), text=F.lower("text"))
    return docs.select("doc_id", F.array_join(text.extract_terms("text", TERMS), ",").alias("terms"))


@query(
    "search_titles",
    r"""WITH d AS (SELECT doc_id, split_part(split_part(text, chr(10), 1), '.', 1) AS core,
        doc_id % 4 AS k FROM documents),
    c AS (SELECT doc_id, k, trim(regexp_replace(core, '[\s\p{Z}]+', ' ', 'g')) AS core FROM d),
    y AS (SELECT doc_id, k, trim(regexp_replace(core, '[:|–—-]+\s*$', '')) AS core FROM c
      WHERE NOT regexp_matches(core, '(?i)[‘’“”''"]|[-–—|:]|\b(?:every|reveal|examine|debut|announce|season|trailer|hold|first|watch|dive|show|here|where|get|is)')
        AND core <> ''),
    x AS (SELECT doc_id, CASE WHEN k = 1 THEN regexp_replace(core, '(?i)^[\p{L}\p{N}_\s]+?\s+in\s+', '') ELSE core END AS core FROM y)
    SELECT doc_id, core AS search_title,
      CASE WHEN len(string_split(core, ' ')) > 4 THEN array_to_string(string_split(core, ' ')[1:4], ' ') END AS four_words,
      CASE WHEN len(string_split(core, ' ')) > 6 THEN array_to_string(string_split(core, ' ')[1:3], ' ') END AS three_words
    FROM x""",
)
def search_titles(t):
    """Headlines built around plain first sentences, stripped again; `search_candidates` takes every document."""
    noisy = r"""(?i)[‘’“”'"]|[-–—|:]|\b(?:every|reveal|examine|debut|announce|season|trailer|hold|first|watch|dive|show|here|where|get|is)"""
    df = cores_of(keep_plain(t.documents, _first_sentence(), noisy))
    df = df.withColumn("keys", text.search_keys(F.col("core"), F.col("core")))
    return df.select(
        "doc_id",
        F.get("keys", F.lit(0)).alias("search_title"),
        F.get("keys", F.lit(1)).alias("four_words"),
        F.get("keys", F.lit(2)).alias("three_words"),
    )


@query("search_candidates")
def search_candidates(t):
    """All search phrases of the headline around the first sentence of every document."""
    return cores_of(t.documents).select("doc_id", text.search_keys(F.col("core"), F.col("clean")).alias("candidates"))


def _first_sentence():
    text_ = F.coalesce("text", F.lit(""))
    return text.squeeze(F.split_part(F.split_part(text_, F.lit("\n"), F.lit(1)), F.lit("."), F.lit(1)))


def cores_of(docs):
    """(doc_id, headline, clean, core) of headlines built around the first sentence."""
    plain = _first_sentence()
    k = F.col("doc_id") % 4
    headline = (
        F.when(k == 0, F.concat(plain, F.lit(" - Netflix announces more")))
        .when(k == 1, F.concat(F.lit("Watch "), plain, F.lit(" season 12")))
        .when(k == 2, F.concat(plain, F.lit(" Official Trailer drops")))
        .otherwise(F.concat(F.lit("Everyone is in ‘"), plain, F.lit(" ’ today")))
    )
    df = docs.select("doc_id", headline.alias("headline"))
    df = pin(df, clean=text.search_title("headline"))
    return pin(df, core=text.title_core(F.col("headline"), F.col("clean")))


def keep_plain(df, plain, noisy):
    return df.where((plain != "") & ~plain.rlike(noisy))


@query(
    "text_first_seen",
    """WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source, lower(text) ORDER BY doc_id) AS rn
      FROM documents) SELECT doc_id, source FROM r WHERE rn = 1""",
)
def text_first_seen(t):
    kept = dedupe.dedupe_by_title(t.documents, ["source"], ["doc_id"], "text")
    return kept.select("doc_id", "source")


@query(
    "text_first_seen_overall",
    "SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY lower(text)",
)
def text_first_seen_overall(t):
    """First document of every group of equal texts with the size of the group."""
    return (
        t.documents.groupBy(F.lower("text").alias("_text"))
        .agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))
        .drop("_text")
    )


@query(
    "raw_cap",
    """WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents)
    SELECT doc_id, source FROM r WHERE rn <= 20""",
)
def raw_cap(t):
    docs = t.documents.select("doc_id", "source")
    return rank.cap_raw(docs, by=["source"], order=["doc_id"])


@query(
    "source_cascade",
    f"""WITH r AS (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY lang ORDER BY {SRC_ORD}, doc_id) AS rn
      FROM documents) SELECT doc_id, lang, source FROM r WHERE rn <= 20""",
)
def source_cascade(t):
    docs = t.documents.select("doc_id", "lang", "source", _src_ord().alias("source_ord"))
    return rank.cascade_sources(docs, 20, ["lang"], "source_ord", ["doc_id"]).drop("source_ord")


_POS = f"""WITH p AS (SELECT doc_id, lang, source, {SRC_ORD} AS source_ord, contains(lower(text), 'th') AS hit,
  row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS pos FROM documents) """


def _positions(t):
    """Documents with their place in the list of their language and source."""
    docs = t.documents.select(
        "doc_id",
        "lang",
        "source",
        _src_ord().alias("source_ord"),
        F.lower("text").contains("th").alias("hit"),
    )
    return keyed.enumerate_positions(
        docs, ["lang", "source"], ["doc_id"], F.floor(F.col("doc_id") / 1_000_000), "pos"
    )


@query(
    "scan_budget",
    _POS
    + """, r AS (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY pos) AS rn
      FROM p WHERE hit AND pos <= least(400, greatest(1 * 25, 1 + 20)))
    SELECT doc_id, lang, source, pos FROM r WHERE rn <= 1""",
)
def scan_budget(t):
    found = rank.scan_budget(_positions(t), F.col("hit"), 1, ["lang", "source"], "pos")
    return found.select("doc_id", "lang", "source", "pos")


# The need is folded over the sources with a recursive query, source by source.
@query(
    "cascade_with_budget",
    """WITH RECURSIVE p AS (SELECT doc_id, lang, CAST(substr(source, 4) AS INTEGER) AS s, contains(lower(text), 'th') AS hit,
      row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS pos FROM documents),
    h AS (SELECT * FROM p WHERE hit AND pos <= 400),
    f(lang, s, need, budget) AS (
      SELECT DISTINCT lang, 0, 30, least(400, greatest(30 * 25, 30 + 20)) FROM h
      UNION ALL
      SELECT lang, s + 1, need - got, least(400, greatest((need - got) * 25, need - got + 20)) FROM (
        SELECT f.lang, f.s, f.need, least(f.need, (SELECT count(*) FROM h WHERE h.lang = f.lang AND h.s = f.s AND h.pos <= f.budget)) AS got
        FROM f WHERE f.s < 19)),
    r AS (SELECT h.doc_id, h.lang, h.s, h.pos, f.need, row_number() OVER (PARTITION BY h.lang, h.s ORDER BY h.pos) AS rn
      FROM h JOIN f ON h.lang = f.lang AND h.s = f.s AND h.pos <= f.budget)
    SELECT doc_id, lang, s AS source_ord, pos FROM r WHERE rn <= need""",
)
def cascade_with_budget(t):
    taken = rank.cascade_with_budget(_positions(t), F.col("hit"), 30, ["lang"], "source_ord", "pos")
    return taken.select("doc_id", "lang", "source_ord", "pos")


@query(
    "source_stats",
    """SELECT lang AS feed, source, count(*) AS n_rows, count(*) FILTER (kind = 'short') AS n_short,
      count(*) FILTER (kind = 'long') AS n_long
    FROM (SELECT *, CASE WHEN n_chars < 1000 THEN 'short' ELSE 'long' END AS kind FROM documents) GROUP BY 1, 2""",
)
def source_stats(t):
    kind = F.when(F.col("n_chars") < 1000, "short").otherwise("long")
    docs = t.documents.select(F.col("lang").alias("feed"), "source", kind.alias("type"))
    return fingerprint.source_stats(docs, ("short", "long"))


@query(
    "failed_sources",
    """SELECT DISTINCT lang AS feed, source FROM documents l
      WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.lang = l.lang AND d.source = l.source AND n_chars >= 3000)""",
)
def failed_sources(t):
    """Sources of a language without any long document."""
    docs = t.documents.select(F.col("lang").alias("feed"), "source", "n_chars", F.lit("x").alias("type"))
    expected = docs.select("feed", "source").distinct()
    stats = fingerprint.source_stats(docs.where("n_chars >= 3000"), ())
    return fingerprint.failed_sources(stats, expected)


@query(
    "schema_gate",
    """SELECT CASE WHEN doc_id % 7 = 0 OR doc_id % 5 = 0 THEN 'rejected' ELSE 'kept' END AS outcome,
      count(*) AS n_rows, sum(doc_id) AS ids FROM documents GROUP BY 1""",
)
def schema_gate(t):
    """Records without a title or genre array are set aside, the others kept."""
    i = F.col("doc_id")
    docs = t.documents.select(
        "doc_id",
        F.when(i % 7 != 0, F.col("source")).alias("title"),
        F.when(i % 5 != 0, F.array("lang")).alias("genres"),
    )
    from feedloom.schema import FEED_ITEM

    full = docs.withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in FEED_ITEM if f.name not in docs.columns}
    )
    kept, rejected = gates.schema_gate(full)
    both = kept.select("doc_id", F.lit("kept").alias("outcome")).unionByName(
        rejected.select("doc_id", F.lit("rejected").alias("outcome"))
    )
    return both.groupBy("outcome").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("doc_id").alias("ids"))


@query(
    "feed_fingerprint",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS pos FROM documents),
    c AS (SELECT * FROM r WHERE pos <= 20)
    SELECT lang AS feed, count(*) AS count, sha256('[' || string_agg(
      '{"doc_id":' || doc_id || ',"n_chars":' || n_chars || ',"note":null,"source":' || to_json(source)
      || ',"text":' || to_json(text) || '}', ',' ORDER BY doc_id) || ']') AS hash FROM c GROUP BY 1""",
)
def feed_fingerprint(t):
    """Hash of the first 20 documents per language as a feed."""
    top = keyed.ranked_by(t.documents, ["lang"], ["doc_id"], 20, "pos")
    feeds = top.withColumn("feed", F.col("lang")).withColumn("note", F.lit(None).cast("string"))
    return fingerprint.feed_fingerprint(
        feeds, ["pos"], columns=("source", "text", "n_chars", "doc_id", "note"), exclude=()
    )


# --- conversations ---------------------------------------------------------------------


@query(
    "label_values",
    """WITH c AS (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN role ELSE text END AS value FROM conversations),
    n AS (SELECT conv_id, turn, trim(value) AS value,
      lag(trim(value)) OVER (PARTITION BY conv_id ORDER BY turn) AS label,
      lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS label_turn FROM c)
    SELECT conv_id, label, max_by(value, turn) AS value FROM n
    WHERE label IN ('user', 'system') AND label_turn = turn - 1 AND value <> '' AND value NOT IN ('user', 'system')
    GROUP BY 1, 2""",
)
def label_values(t):
    """Even turns read as labels (the role), odd ones as values."""
    spans = t.conversations.select(
        "conv_id", "turn", F.when(F.col("turn") % 2 == 0, F.col("role")).otherwise(F.col("text")).alias("span")
    )
    return sources.label_values(spans, ["conv_id"], "turn", "span", ("user", "system"))


@query(
    "page_label_values",
    """SELECT conv_id, turn, text_value AS release_date, CASE WHEN turn % 2 = 0 THEN role END AS mpaa FROM
      (SELECT conv_id, turn, role, role || ' ' || turn AS text_value FROM conversations)""",
)
def page_label_values(t):
    """Detail-page spans built from every turn: labels, values, repeats and blanks."""
    span = lambda c: F.concat(F.lit("<span class='v'>"), c, F.lit("</span>"))
    lit = F.lit
    page = F.concat(
        span(lit("Opening")),
        span(lit("MPAA")),
        span(F.when(F.col("turn") % 2 == 0, F.col("role")).otherwise(lit(" "))),
        span(lit("Release Date")),
        span(lit("earlier")),
        span(lit("Release Date")),
        span(F.concat(lit("<b>"), "role", lit("</b> "), F.col("turn").cast("string"))),
        span(lit("MPAA")),
        span(lit("Release Date")),
    )
    return sources.page_label_values(
        t.conversations.select("conv_id", "turn", page.alias("html")), ["conv_id", "turn"]
    )


@query(
    "paged_take",
    """WITH r AS (SELECT conv_id, turn, role, row_number() OVER (PARTITION BY role ORDER BY turn, conv_id) AS rn
      FROM conversations WHERE turn + 1 <= least(CASE WHEN role = 'user' THEN 3 ELSE 9 END, 5))
    SELECT conv_id, turn, role FROM r WHERE rn <= 200""",
)
def paged_take(t):
    """Turns as pages, up to three for users and nine for others, at most 200 rows per role."""
    rows = t.conversations.select("conv_id", "turn", "role", (F.col("turn") + 1).alias("page"))
    total = F.when(F.col("role") == "user", 3).otherwise(9)
    return rank.paged_take(rows, ["role"], "page", total, ["conv_id"], 200).drop("page")
