"""Jaccard join of documents on word n-grams: MinHash bands find candidates, full n-gram sets decide.

Documents with equal n-gram sets are one node. Nodes that share a band hash are joined to the smallest node of
the bucket, which gives candidate groups without listing pairs. A group is cut into blocks of bounded size, and
each pair of blocks is compared on full n-gram sets in one task, which returns only counts of links and at most
one edge per node. Cost of a group is quadratic in its number of different texts, as it must be to count every
link, but no task holds more than two blocks and no pair becomes a row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import WORD_HASH, components, gram_hashes, long_of, mapped, mix, settle, strings, word_hashes

#: Words per n-gram, least similarity of a link, share of such links that the bands have to find.
WORDS = 5
SIMILARITY = 0.8
RECALL = 0.99999
#: Hash functions at most; more rows per band mean fewer false candidates.
HASHES = 256
#: A block holds about this many n-grams and texts at most.
BLOCK_GRAMS = 500_000
BLOCK_TEXTS = 1_024


def bands_for(similarity: float, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows per band): as many rows as the hash functions allow while a link is found with `recall`."""
    best = None
    for rows in range(1, 33):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log(1 - min(similarity, 0.999999) ** rows)))
        if bands * rows <= hashes:
            best = bands, rows
    if best is None:
        raise ValueError("no banding reaches this recall with so few hash functions")
    return best


def grams_of(text: str, n: int) -> np.ndarray:
    """Sorted distinct n-gram hashes of the lower-case words; a shorter text is one gram, an empty one has none."""
    return np.unique(gram_hashes(word_hashes(text.lower().encode().split()), n))


def node_of(grams: np.ndarray) -> int | None:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes())).view(np.int64))) if len(grams) else None


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """Per document: (_key, doc_id, node, n_grams, bands); node is null for a text without words."""
    multipliers = np.random.default_rng(20_240_601).integers(1, 1 << 63, bands * rows, dtype=np.uint64)
    multipliers = multipliers * np.uint64(2) + np.uint64(1)
    band_seed = mix(np.arange(1, bands + 1, dtype=np.uint64))

    def sign(batch):
        WORD_HASH.trim()
        sets = [grams_of(t, n) for t in strings(batch, "text")]
        low = np.full((len(sets), bands * rows), np.iinfo(np.uint64).max)
        for k, grams in enumerate(sets):
            for at in range(0, len(grams), 1_024):
                np.minimum(low[k], (multipliers[:, None] * grams[None, at : at + 1_024]).min(axis=1), out=low[k])
        low = low.reshape(len(sets), bands, rows)
        hashed = np.broadcast_to(band_seed, low.shape[:2])
        for r in range(rows):
            hashed = mix(hashed * np.uint64(0x9E3779B97F4A7C15) + low[:, :, r])
        full = np.array([len(g) > 0 for g in sets], bool)
        ends = np.concatenate([[0], np.cumsum(full * bands)])
        yield {
            "_key": batch.column("_key"),
            "doc_id": batch.column("doc_id"),
            "node": pa.array([node_of(g) for g in sets], pa.int64()),
            "n_grams": [len(g) for g in sets],
            "bands": pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(long_of(np.ascontiguousarray(hashed[full])).ravel())
            ),
        }

    return mapped(keyed(docs), sign, "_key long, doc_id long, node long, n_grams long, bands array<long>")


def keyed(docs: DataFrame) -> DataFrame:
    """(_key, doc_id, text); a row without doc_id gets a key from its text."""
    doc_id = F.col("doc_id").cast("long")
    return docs.select(F.coalesce(doc_id, F.xxhash64("text")).alias("_key"), doc_id.alias("doc_id"), "text")


def compare(nodes: np.ndarray, copies: np.ndarray, block: np.ndarray, sets: list[np.ndarray], similarity: float, two: bool):
    """Links among the nodes of one block, or only between those of `two`: (text links, document links, parent) per node."""
    n = len(nodes)
    size = np.array([len(s) for s in sets], np.int64)
    gram, inverse, holders = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), size)[np.argsort(inverse, kind="stable")]
    start = np.cumsum(holders) - holders
    mine = np.split(inverse, np.cumsum(size)[:-1])
    texts, documents = np.zeros(n, np.int64), np.zeros(n, np.int64)
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for k in range(n):
        many = holders[mine[k]]
        first = np.repeat(start[mine[k]] - (np.cumsum(many) - many), many)
        both = np.bincount(owner[first + np.arange(many.sum())], minlength=n)
        near = both >= similarity * (size[k] + size - both) - 1e-9
        near[k] = False
        if two:
            near &= block != block[k]
        found = np.flatnonzero(near)
        texts[k], documents[k] = len(found), copies[found].sum()
        for other in found:
            a, b = sorted((root(k), root(int(other))), key=lambda x: nodes[x])
            parent[b] = a
    return texts, documents, nodes[[root(k) for k in range(n)]]


def verified(candidates: DataFrame, docs: DataFrame, n: int, similarity: float) -> DataFrame:
    """Per linked node and pair of blocks: (node, parent, texts, documents).

    `candidates` has (node, root, copies, n_grams, _key), one row per node.
    """
    sizes = (
        candidates.groupBy("root")
        .agg(F.sum("n_grams").alias("_grams"), F.count(F.lit(1)).alias("_texts"))
        .select("root", F.ceil(F.greatest(F.col("_grams") / BLOCK_GRAMS, F.col("_texts") / BLOCK_TEXTS)).alias("blocks"))
    )
    placed = candidates.join(sizes, "root").withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))

    def collect(batch):
        sets = [grams_of(t, n) for t in strings(batch, "text")]
        nodes = batch.column("node").to_pylist()
        right = np.array([node_of(g) == want for g, want in zip(sets, nodes)], bool)
        kept = [g for g, ok in zip(sets, right) if ok]
        ends = np.cumsum([0, *map(len, kept)])
        values = pa.array(long_of(np.concatenate([np.zeros(0, np.uint64), *kept])))
        some = batch.filter(pa.array(right))
        yield {c: some.column(c) for c in ("node", "root", "copies", "block", "blocks")} | {
            "grams": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
        }

    # The same join at every size: the candidates grow with the corpus and are never broadcast.
    texts = keyed(docs).select("_key", "text").join(placed.hint("merge"), "_key").drop("_key", "n_grams")
    with_sets = mapped(
        texts, collect, "node long, root long, copies long, block long, blocks long, grams array<long>", rows=128
    ).dropDuplicates(["node"])
    pairs = with_sets.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "node",
        "copies",
        "block",
        "grams",
        "root",
        F.least("block", "_other").alias("a"),
        F.greatest("block", "_other").alias("b"),
    )

    def links(key: tuple, group: pa.Table) -> pa.Table:
        two = key[1].as_py() != key[2].as_py()
        nodes = group.column("node").to_numpy()
        block = group.column("block").to_numpy()
        if two and block.min() == block.max():  # the other block has no nodes
            return pa.table({c: pa.array([], pa.int64()) for c in ("node", "parent", "texts", "documents")})
        lists = group.column("grams").combine_chunks()
        values, ends = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
        sets = [values[x:y] for x, y in zip(ends[:-1], ends[1:])]
        t, d, parent = compare(nodes, group.column("copies").to_numpy(), block, sets, similarity, two)
        out = pa.table({"node": nodes, "parent": parent, "texts": t, "documents": d})
        return out.filter(pa.array(t > 0))

    return pairs.groupBy("root", "a", "b").applyInArrow(links, "node long, parent long, texts long, documents long")


def near_classes(
    docs: DataFrame, n: int = WORDS, similarity: float = SIMILARITY, recall: float = RECALL
) -> DataFrame:
    """One row per row of `docs` (doc_id, text): (_key, doc_id, class_id, n_links, n_text_links, n_copies).

    A link is a Jaccard similarity of at least `similarity` between sets of `n` lower-case words; classes are
    the connected components of the links, named by their smallest doc_id. `n_links` counts linked other
    documents, `n_text_links` different n-gram sets among them, `n_copies` the documents with the same set, the
    document itself included. A null or empty text, or one of white space only, is a class of its own without
    links. Rows that repeat are copies of each other. Rows without doc_id take part; `_key` names them.
    Other columns are not read. An empty table gives no rows.
    """
    bands, rows = bands_for(similarity, recall)
    signed = settle(signatures(docs, n, bands, rows), "near-signatures")
    flat = signed.select("node", F.posexplode("bands").alias("_at", "band"))
    buckets = flat.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    stars = flat.join(buckets, "band").select(F.col("node").alias("a"), F.col("low").alias("b")).distinct()
    groups = components(settle(stars, "near-stars"), "near-groups")

    nodes = settle(
        signed.where("node is not null")
        .groupBy("node")
        .agg(F.min("_key").alias("_key"), F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("copies"), F.max("n_grams").alias("n_grams")),
        "near-nodes",
    )
    candidates = settle(groups.join(nodes, "node").select("node", "root", "copies", "n_grams", "_key"), "near-candidates")
    linked = settle(verified(candidates, docs, n, similarity), "near-links")
    counts = linked.groupBy("node").agg(F.sum("texts").alias("texts"), F.sum("documents").alias("documents"))
    classes = components(linked.select(F.col("node").alias("a"), F.col("parent").alias("b")), "near-classes")
    members = nodes.join(classes, "node").join(counts, "node")
    names = members.groupBy("root").agg(F.min("low").alias("class_id"))
    named = members.join(names, "root").select("node", "class_id", "texts", "documents")
    all_nodes = nodes.join(named, "node", "left").select(
        "node", "copies", F.coalesce("class_id", "low").alias("class_id"), or_zero("texts"), or_zero("documents")
    )
    return signed.join(all_nodes, "node", "left").select(
        "_key",
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        (or_zero("documents") + F.coalesce(F.col("copies") - 1, F.lit(0))).cast("long").alias("n_links"),
        or_zero("texts").alias("n_text_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
    )


def or_zero(name: str) -> Column:
    return F.coalesce(name, F.lit(0)).cast("long").alias(name)


def keep_one(docs: DataFrame, n: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of `docs` with the smallest doc_id of each class, with all their columns.

    Texts without words are no copies of each other and all stay. A row without doc_id stays, if nothing in its
    class has one. Rows that share a doc_id stand or fall together.
    """
    kept = near_classes(docs, n, similarity).where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    kept = kept.select(F.col("_key").alias("__key")).distinct()
    key = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))
    return docs.withColumn("__key", key).join(kept.hint("merge"), "__key", "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))
