"""Operators 1 and 2."""

import base64
import hashlib

import pytest

from feedloom.llm import html_blocks, warc

FAKE = (
    "x\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 7\r\n\r\nabc"
)
LAST = "q\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc"
ROWS = [
    *((k, f"http://a/{k}", f"é<p>{k}" * (k % 9) + "\r\n" * (k % 2)) for k in range(20)),
    (30, "u", None), (31, "u\r\nX: y", ""), (32, None, FAKE), (33, "u", LAST), (34, "u", FAKE + LAST + "\r\n\r\n"),
    (35, "u", "\r\n\r\n"), (36, "u", FAKE), (37, "u", "long" * 40_000),
]


def expected(rows, least):
    best = {}
    for i, _, h in rows:
        best[h or ""] = max(best.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        again = len(data) >= least and best[h or ""] != i
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "revisit" if again else "response", best[h or ""] if again else None))
    return sorted(out)


def make(spark, rows):
    full = [(*r, "x") for r in rows]
    return spark.createDataFrame(full, "page_id long, url string, html string, kind string").repartition(2)


def test_round_trip_rejects_magic_in_payloads(spark):
    assert sorted(map(tuple, warc.round_trip(make(spark, ROWS)).collect())) == expected(ROWS, 0)


def test_small_payloads_are_never_revisits(spark):
    rows = ROWS[:6] + [(50, "u", "é<p>2é<p>2"), (51, "u", "é<p>2é<p>2")]
    assert sorted(map(tuple, warc.round_trip(make(spark, rows), 7).collect())) == expected(rows, 7)


def test_splits_inside_records(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2500")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = [r for r in ROWS if r[0] != 37]
        assert sorted(map(tuple, warc.round_trip(make(spark, rows)).collect())) == expected(rows, 0)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_version_1_1(spark, tmp_path):
    bodies = [b"", b"<p>one</p>", b"two\r\n\r\nWARC/1.1\r\n"]
    with open(tmp_path / "a.warc", "wb") as out:
        for k, body in enumerate(bodies):
            block = b"HTTP/1.1 200 OK\r\n\r\n" + body
            head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{k}>\r\nContent-Length: {len(block)}\r\n\r\n"
            out.write(head.encode() + block + b"\r\n\r\n")
    got = {r.page_id: r.payload_bytes for r in warc.read_archives(spark, str(tmp_path)).collect()}
    assert got == {k: len(body) for k, body in enumerate(bodies)}


def test_rows_without_id_and_ties(spark):
    rows = [(None, "u", "a"), (None, "u", "b"), (1, "u", "a"), (2, "u", "c"), (2, "u", "c")]
    got = sorted(((r.page_id or 0, r.record_type, r.refers_to) for r in warc.round_trip(make(spark, rows)).collect()), key=str)
    assert got == sorted([(0, "revisit", 1), (0, "response", None), (1, "response", None), *[(2, "response", None)] * 2], key=str)
    assert warc.round_trip(make(spark, [])).count() == 0


PAGE = """<html><head><title>x</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
<nav><a href=/>Home</a></nav><main><article><header><h1>Title &amp; more</h1><p>by me</p></header>
<p>Hello <a href=x>link</a>  world.&nbsp;ok <b>bold</b>er a &lt; b<br>next<script>var a="</p>";</script></p><!-- no <p>x -->
<aside>side</aside><ul><li>one</li><li>two</li></ul><div class="cookie-notice">cookies!</div><form>f<input></form>
<p>Last<section id=comments><h2>Comments</h2><p>great post my friend</p></section></article></main>
<aside class=sidebar><p>long sidebar text here</p></aside><div class='ad'>buy</div><footer>foot &copy;</footer></body></html>"""


def test_main_text():
    want = ["Title & more", "Hello link world. ok bolder a < b next", "one", "two", "Last"]
    assert html_blocks.main_text(PAGE) == "\n\n".join(want)
    assert html_blocks.main_text("") == "" and html_blocks.main_text("<p") == "" and html_blocks.main_text("<nav>x</nav>") == ""


def test_pages_without_article():
    long = "word " * 40
    page = f"<body><div><a href=a>Home</a><a href=b>About</a></div><h2>Some heading here now</h2><p>{long}</p><p>{long}</p></body>"
    assert html_blocks.main_text(page).split("\n\n")[-2:] == [long.strip()] * 2 and "About" not in html_blocks.main_text(page)


def test_extract(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", "<article><p>" + "a b " * 50_000)]
    got = html_blocks.extract(make(spark, rows)).collect()
    assert sorted(r.n_chars for r in got) == sorted([0, *[len(html_blocks.main_text(PAGE))] * 2, 199_999])
    assert html_blocks.extract(make(spark, [])).count() == 0


def test_tree_learns_its_table():
    tree, rows = html_blocks.trained(), html_blocks.LABELLED
    right = [(html_blocks.verdict(tree, tuple(r[:-1])) > 0.5) == bool(r[-1]) for r in rows]
    assert sum(right) >= 0.95 * len(right)


@pytest.mark.parametrize(
    "element",
    [
        '<article class="post no-sidebar">', '<div class="content share-enabled">', '<article class="story legal-news">',
        '<div class="page has-banner">', '<div id="social-policy-article">', "<div class='entry-content'>", "<main>",
    ],
)
def test_names_of_states_and_topics_keep_the_article(element):
    texts = ["The council met on Monday to talk about the bridge, " + "which has been closed for a long time now. " * 4] * 2
    page = f"<html><body><nav><a href=/>Home</a> <a href=/n>News</a></nav>{element}<p>{texts[0]}</p><p>{texts[1]}</p></body></html>"
    assert html_blocks.main_text(page) == "\n\n".join(" ".join(t.split()) for t in texts)


@pytest.mark.parametrize("name", ["sidebar", "post-comments", "sidebar-content", "related-posts", "ad1", "cookie-banner", "share-buttons", "modal-content"])
def test_names_of_site_elements(name):
    assert html_blocks.named(f' class="box {name}"')[0]
