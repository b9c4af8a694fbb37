"""Column functions on hand-written cases."""

import datetime as dt

from pyspark.sql import functions as F

from feedloom.functions import dates, html, images, outlets, text, urls
from feedloom.functions.core import pin


def test_titles(values):
    cases = {
        "A - B - C": "A",
        "Spider-Man: X | foo.com": "Spider-Man: X",
        "Foo (2026)": "Foo",
        "Foo (TV Series)": "Foo",
        "X-Men": "X-Men",
        " - | ": "Unknown Title",
        "a  b ": "a b",
        None: "Unknown Title",
    }
    assert values(list(cases), text.normalize_title) == list(cases.values())
    again = values(list(cases.values()), text.normalize_title)
    assert again == list(cases.values())


def test_title_signature(values):
    cases = {"The  Cat & an Ox!": "cat ox", "Théâtre the A-team": "théâtre team", "a the an": ""}
    assert values(list(cases), text.title_signature) == list(cases.values())


def test_summary(values):
    def fn(c):
        return text.clamp_summary(text.clean_text(c, "none"))

    exact = "x" * 500
    words = ("word " * 101).strip()
    sentence = ("Done it. " * 60).strip()
    got = values([None, exact, exact + "x", words, sentence, "w " * 249 + "ab; cd ef"], fn)
    assert got[0] == "none"
    assert got[1] == exact
    assert got[2] == exact + "..."
    assert got[3] == ("word " * 99).strip() + "..."
    assert got[4] == ("Done it. " * 55).strip()
    assert got[5] == ("w " * 249).strip() + "..."


def test_genres(spark):
    df = spark.createDataFrame(
        [(["sci-fi", "DRAMA", "drama", " ", "o'neil 3d"],), (None,)], "g array<string>"
    )
    got = [r[0] for r in df.select(text.normalize_genres(F.col("g"))).collect()]
    assert got == [["Drama", "O'Neil 3D", "Sci-Fi"], []]


def test_split_genres(values):
    got = values(["Drama, sci-fi/ACTION|x"], lambda c: text.normalize_genres(text.split_genres(c)))
    assert got == [["Action", "Drama", "Sci-Fi", "X"]]


def test_topic(values):
    def fn(c):
        return text.topic_match(text.topic_text(c, F.lit("")))

    cases = {
        "New movie": True,
        "Movie deal": False,
        "Movie ideals": True,
        "NFL film": False,
        "Conflict film": True,
        "Gardening": False,
        "Disney+ now": True,
    }
    assert values(list(cases), fn) == list(cases.values())


def test_ratings_years_types(values):
    assert values(["8.5", "nan", "11", "-1", "abc", "", None, "8d", "1e1", "inf"], text.coerce_rating) == [
        8.5, 10.0, 10.0, 0.0, None, None, None, None, 10.0, 10.0,
    ]
    assert values(["c. 1999-2001", "12019x", "abc"], text.parse_year) == [1999, 2019, None]
    types = values(["Docu show", "TV", "Anime", None, "x"], lambda c: text.normalize_type(text.type_label(c)))
    assert types == ["documentary", "series", "anime", "movie", "movie"]


def test_release_dates(values):
    cases = {
        "Fri, 07 Aug 2026 23:30:00 -0500": dt.date(2026, 8, 7),
        "2026-08-08T01:20:51Z": None,
        "2026": dt.date(2026, 1, 1),
        "2026-08": dt.date(2026, 8, 1),
        "2026/08/08": dt.date(2026, 8, 8),
        "Aug 8, 2026": dt.date(2026, 8, 8),
        "August 8, 2026": dt.date(2026, 8, 8),
        "8 Aug 2026": dt.date(2026, 8, 8),
        "Fri, 07 Aug 2026": None,
        "2026-02-30": None,
        "junk": None,
        "": None,
        None: None,
    }
    assert values(list(cases), dates.parse_release_date) == list(cases.values())


def test_published(values):
    cases = {
        "Fri, 07 Aug 2026 23:30:00 -0500": "2026-08-08T04:30:00Z",
        "Fri, 07 Aug 2026 23:30:00 EST": "2026-08-08T04:30:00Z",
        "07 Aug 26 10:20": "2026-08-07T10:20:00Z",
        "2026-08-08T01:20:51Z": "2026-08-08T01:20:51Z",
        "2026-08-08 01:20:51.999+02:00": "2026-08-07T23:20:51Z",
        "20260808": "2026-08-08T00:00:00Z",
        "2026": "2026-01-01T00:00:00Z",
        "25:00": None,
        "x": None,
    }
    assert values(list(cases), lambda c: dates.iso_z(dates.parse_published(c))) == list(cases.values())


CANONICAL = {
    "//host/p": "https://host/p",
    "HTTP://X": "",
    "https://h/a?a=&b=2&b=1": "https://h/a?b=2&b=1",
    "http://H/A//b\\c?utm_source=x": "https://H/A/b/c",
    "https://u:p@h:80/x y#f": "https://u:p@h:80/x y",
    "https://h": "https://h/",
    "https://h/?q=a+b%20c&r=%zz&t=~*": "https://h/?q=a+b+c&r=%25zz&t=~%2A",
    "https://h/p?x=1=2&UTM_Source=1&y&ref=": "https://h/p?x=1%3D2",
    "": "",
    None: "",
}


def test_canonical(values):
    assert values(list(CANONICAL), urls.canonical_url) == list(CANONICAL.values())
    done = [c for c in CANONICAL.values() if c]
    assert values(done, urls.canonical_url) == done


def test_staged_form_equals_column_form(spark):
    df = spark.createDataFrame([(v,) for v in CANONICAL], "v string")
    staged = urls.with_page(df, v=("c", "ok"))
    rows = staged.withColumn("again", urls.canonical_url(urls.unwrap_redirect("v"))).collect()
    assert all(r["c"] == r["again"] for r in rows)
    one = pin(df, c=urls.canonical_url("v"))
    both = urls.with_signature(one, s=F.col("c")).withColumn("t", urls.url_signature("c"))
    assert all((r["s"] or "") == r["t"] for r in both.collect())


def test_redirects(values):
    cases = {
        "https://www.google.com/url?q=https%3A%2F%2Fa.com%2Fb%2520c%2Bd": "https://a.com/b c+d",
        "https://l.facebook.com/l.php?u=https%3A%2F%2Fa.com%2F&h=1": "https://a.com/",
        "https://www.google.com/search?q=x": "https://www.google.com/search?q=x",
        " https://a.com ": "https://a.com",
    }
    assert values(list(cases), urls.unwrap_redirect) == list(cases.values())


def test_signature(values):
    cases = {
        "https://www.Variety.com/A/?b=2&a=1": "https://variety.com/a?a=1&b=2",
        "https://m.imdb.com/title/": "https://imdb.com/title",
        "": "",
    }
    assert values(list(cases), urls.url_signature) == list(cases.values())


def test_absolute_href(spark):
    base = "https://h/a/b?x#y"
    cases = {
        "//o/p": "https://o/p",
        "/r": "https://h/r",
        "c": "https://h/a/c",
        "https://z/": "https://z/",
        "?q": "https://h/a/b?q",
    }
    df = spark.createDataFrame([(i, k) for i, k in enumerate(cases)], "i int, h string").orderBy("i")
    got = [r[0] for r in df.select(urls.absolute_href("h", F.lit(base))).collect()]
    assert got == list(cases.values())


def test_outlets(spark):
    cases = {
        "https://www.foo-bar.co.uk/x": ("Foo bar", "foo-bar.co.uk"),
        "https://blog.a.example.net/a": ("Example", "blog.a.example.net"),
        "https://m.tv/1": ("M", "m.tv"),
        "https://com/": ("com", "com"),
        "https://news.bbc.com/": ("BBC", "news.bbc.com"),
        "junk": ("Unknown", "unknown"),
        "": ("Unknown", "unknown"),
    }
    df = spark.createDataFrame([(i, k) for i, k in enumerate(cases)], "i int, u string")
    df = df.withColumn("d", outlets.source_domain("u")).withColumn("n", outlets.source_name("d"))
    assert [(r["n"], r["d"]) for r in df.orderBy("i").collect()] == list(cases.values())


def test_images(values):
    cdn = "https://lh3.googleusercontent.com/x"
    assert values([f"{cdn}=w16-h9=w20", f"{cdn}=w400=w20", "https://a/x=w16"], images.upsize_thumbnail) == [
        f"{cdn}=w1280-h9=w20",
        f"{cdn}=w400=w20",
        "https://a/x=w16",
    ]
    secure = values(["http://a/b.jpg", "ftp://a/b.jpg", "https://a/spacer.gif", None], images.secure_image)
    assert secure == ["https://a/b.jpg", None, None, None]
    uuid = "AAAABBBB-CCCC-DDDD-EEEE-FFFF00001111"
    got = values([uuid, uuid.replace("-", ""), "ab" * 32, " "], images.card_poster)
    assert f"/{uuid.lower()}/" in got[0] and got[1] == got[0] and f"/{'AB' * 32}/" in got[2] and got[3] is None
    assert values(["https://m/x._V1_SX9_.jpg"], images.detail_poster) == ["https://m/x._V1_QL75_UX380_.jpg"]


def test_html(values):
    page = '<html lang="de"><title> A &amp;lt; <b>B</b></title><link href="/c" rel="canonical">'
    assert values([page], lambda c: html.tag_text(c, "title")) == ["A &lt; B"]
    assert values([page], lambda c: html.attribute(c, "html", "lang")) == ["de"]
    assert values([page, "x"], html.canonical_link) == ["/c", None]
    assert values(["a &amp; <b>b</b> &eacute;&#8217;"], text.sanitize_overview) == ["a & b é’"]


def test_search_phrases(spark):
    df = spark.createDataFrame([("Top 'Scary Movie' Trailer",), ("One two three four five six seven",)], "t string")
    df = pin(df, c=text.search_title("t"))
    df = pin(df, core=text.title_core(F.col("t"), F.col("c")))
    got = [r[0] for r in df.select(text.search_keys(F.col("core"), F.col("c"))).collect()]
    assert got == [
        ["Scary Movie", "Top 'Scary Movie'"],
        ["One two three four five six seven", "One two three four", "One two three"],
    ]


def test_service_tail(values):
    assert values(["Dune - Netflix today", "Dune|HBO Max", "Mad Max"], text.sanitize_title) == [
        "Dune", "Dune", "Mad Max",
    ]
