"""One query per corpus operator, over the whole given tables, with the SQL that checks it where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from feedloom.llm import (
    centroids,
    fm_quality,
    html_blocks,
    lexicon,
    line_rules,
    lm_score,
    mixing,
    near_join,
    prefix_trie,
    sentence_spans,
    tiling,
    token_orc,
    warc,
)
from feedloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


@query("op1_warc_chain")
def warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"), revisit_bytes=0)


@query("op2_html_blocks")
def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(table(spark, sf_dir, "pages"))


@query("op3_cross_entropy")
def language_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return lm_score.cross_entropy(table(spark, sf_dir, "documents"), good)


@query("op4_sentence_spans")
def repeated_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentence_spans.drop_repeats(docs).select("doc_id", "text", "n_removed", "removed")


@query("op5_factorisation_machine")
def document_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_line_rules")
def quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *counts, "base_failed", "kept", "n_lost_words")


@query("op7_bpe_lexicon")
def bpe_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op8_token_orc")
def orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_orc.token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


@query("op9_jaccard_join")
def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_join.near_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return classes.select("doc_id", "class_id", "n_links", "n_text_links", "n_copies")


@query("op10_string_tiling")
def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


@query("op11_bisector_clusters", centroids.oracle())
def bisector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


@query("op12_prefix_trie", prefix_trie.ORACLE)
def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, convs = prefix_trie.shared_starts(prefix_trie.turn_rows(table(spark, sf_dir, "conversations")))
    return prefix_trie.trie(turns, convs)


@query("op13_source_mix", mixing.ORACLE)
def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")
