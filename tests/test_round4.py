"""What the fourth review found."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from feedloom.session import work_dir
from feedloom.sources import syndication

ITEM = "<item><title>{}</title><guid>{}</guid></item>"
ENTRY = "<entry><title>{}</title><id>{}</id></entry>"


def _landed(spark, files):
    """A folder with a file of each text."""
    path = work_dir(spark, "landed")
    for name, text in files.items():
        spark.createDataFrame([(text,)], "v string").coalesce(1).write.text(os.path.join(path, name))
    return f"{path}/*"


def _scans(df):
    """What the scans of a frame that ran have counted: (files, rows)."""
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    counted = [leaves.apply(k).metrics() for k in range(leaves.size())]
    return [tuple(m.apply(n).value() for n in ("numFiles", "numOutputRows")) for m in counted if m.contains("numFiles")]


def test_a_feed_is_not_read_by_the_end_tag_it_lacks(spark):
    """Else the whole file is one record, held by one task, and every split reads it to its end."""
    rss, atom = (f"<x>{''.join(t.format(k, f'{n}{k}') for k in range(200))}</x>" for n, t in (("i", ITEM), ("e", ENTRY)))
    path = _landed(spark, {"a": rss, "b": atom, "c": "<p>no feed</p>" * 100})
    settled = []

    def kept(df, label, settle=syndication.settle):
        if label == "items":
            settled.append((df, df.collect()))
        return settle(df, label)

    before, syndication.settle = syndication.settle, kept
    try:
        got = syndication.read_items(spark, path).collect()
    finally:
        syndication.settle = before
    assert sorted((r.guid, r.entry_ord) for r in got) == sorted((f"{n}{k}", k + 1) for n in "ie" for k in range(200))
    (read, rows), = settled
    # Two files with 200 records and what follows the last of them.
    assert len(rows) == 400 and sorted(_scans(read)) == [(1, 201), (1, 201)]


def test_files_of_both_kinds_keep_all_records(spark):
    """Start tags with attributes or line ends, a name that only begins alike, a last item without its end tag."""
    mixed = "".join(ITEM.format(k, f"i{k}") + ENTRY.format(k, f"e{k}") for k in range(50))
    odd = '<items/><item\n a="1"><title>x</title><guid>o1</guid></item>\n<item><guid>o2</guid>'
    path = _landed(spark, {"a": mixed, "b": odd, "c d%20": ITEM.format("s", "s1"), "e": "", "f": ENTRY.format("é", "f1")})
    for size in ("128m", "1k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            got = syndication.read_items(spark, path).select(F.coalesce("guid", F.lit("")).alias("guid"), "file", "entry_ord", "_broken").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        want = {f"{n}{k}" for n in "ie" for k in range(50)} | {"o1", "o2", "s1", "f1"}
        assert sorted(r.guid for r in got) == sorted(want)
        assert all(r._broken is None for r in got)
        places = {}
        for r in got:
            places.setdefault(r.file, []).append(r.entry_ord)
        assert sorted(map(len, places.values())) == [1, 1, 2, 100]
        assert all(sorted(x) == list(range(1, len(x) + 1)) for x in places.values())
        assert [r.entry_ord for r in got if r.guid == "o2"] == [2]


def test_the_lexicon_counts_every_text(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from feedloom.llm import lexicon

    path = public_tokenizers.path("word_bpe_49k.json")
    letters = F.translate(F.format_string("%05d", F.col("id") % 8_000), "0123456789", "abcdefghij")
    docs = spark.range(24_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("The cat, "), letters).alias("text"))
    counted = {r["word"]: r["n"] for r in lexicon.word_counts(docs, path).collect()}
    assert len(counted) == 8_003 and counted["the"] == counted["cat"] == counted[","] == 24_000
    assert {n for w, n in counted.items() if w not in ("the", "cat", ",")} == {3}
    data = lexicon.frequent_lexicon(docs, path, 100_000)
    assert lexicon.Lexicon(data).words == 8_003


def test_most_frequent_words_with_ties(spark):
    pytest.importorskip("public_tokenizers")
    from feedloom.llm import lexicon

    rows = [(f"w{k * 7919 % 1000:03d}", 1 + k % 7) for k in range(1000)]
    counts = spark.createDataFrame(rows, "word string, n long").repartition(5)
    want = [w for w, _ in sorted(rows, key=lambda r: (-r[1], r[0]))]
    usual = spark.conf.get("spark.sql.execution.topKSortFallbackThreshold")
    for words in (0, 1, 142, 500, 1000, 5000):
        assert lexicon.most_frequent(counts, words) == want[:words]
    assert lexicon.most_frequent(counts.where("n > 9"), 3) == []
    assert spark.conf.get("spark.sql.execution.topKSortFallbackThreshold") == usual


def test_rare_and_plain_texts_keep_their_places():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    import pyarrow as pa
    from tokenizers import Tokenizer

    from feedloom.llm import lexicon

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = ["a b", "it’s x", None, "Word. WORD, word!!", " \t ", "a<|endoftext|>b", "don't x'''s 12½ \x1c q", "İ a", "日本 b", "word"]
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    codec = lexicon.Codec(path, lexicon.build([]))
    for some in (slice(None), slice(3, 8), slice(0, 1), slice(1, 2), slice(0, 0)):
        ids, said = codec.encode_decode(pa.array(texts, pa.string())[some])
        assert ids.to_pylist() == want[some]
        assert said.to_pylist() == [library.decode(x, skip_special_tokens=False) for x in want[some]]


def test_the_token_stage_counts_every_text(spark):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline
    from feedloom.llm import lexicon

    letters = F.translate(F.format_string("%05d", F.col("id")), "0123456789", "abcdefghij")
    docs = spark.range(12_000).select(F.col("id").alias("doc_id"), letters.alias("text"))
    made, before = [], lexicon.publish
    lexicon.publish = lambda session, data: made.append(data) or before(session, data)
    try:
        tokens = corpus_pipeline.tokens(spark, docs, "")
    finally:
        lexicon.publish = before
    assert lexicon.Lexicon(made[0]).words == 12_000
    assert tokens.count() == 12_000
