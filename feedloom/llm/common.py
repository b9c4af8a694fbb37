"""Helpers of the corpus operators: settled tables, word hashes, components of a graph."""

from __future__ import annotations

import weakref
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.session import tune, work_dir

#: Entries that a worker's memo tables may hold before they are emptied.
MEMO_ENTRIES = 200_000
#: Rows of a batch between Spark and Python; long texts make rows large.
BATCH_ROWS = 1_024


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it from there: cuts the lineage, survives lost executors."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def mapped(
    df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[dict]], schema: str, rows: int = 512
) -> DataFrame:
    """`mapInArrow` for functions that take some rows and yield dictionaries of columns.

    `rows` bounds what a task holds as Python objects at a time; every row is passed on.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    kind = StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def run(batches):
        for batch in batches:
            for columns in (c for at in range(0, batch.num_rows, rows) for c in fn(batch.slice(at, rows))):
                arrays = [
                    x if isinstance(x, pa.Array) else pa.array(x, type=f.type)
                    for f, x in ((f, columns[f.name]) for f in arrow)
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, kind)


def strings(batch: pa.RecordBatch, name: str) -> list[str]:
    """A text column as Python strings; null is the empty text."""
    return [t or "" for t in batch.column(name).to_pylist()]


class Memo(dict):
    """A function's results by argument, kept for the life of a worker.

    `trim` bounds it and empties the memos of other operators that ran in the same worker before.
    """

    live: weakref.WeakValueDictionary = weakref.WeakValueDictionary()
    #: What else an operator keeps in a worker, by group: functions that let it go.
    kept: dict[str, list[Callable]] = {}

    def __init__(self, fn: Callable, group: str):
        super().__init__()
        self.fn, self.group = fn, group
        Memo.live[id(self)] = self

    __hash__ = object.__hash__

    def __missing__(self, key):
        value = self[key] = self.fn(key)
        return value

    def trim(self, entries: int = MEMO_ENTRIES) -> None:
        for memo in list(Memo.live.values()):
            if memo.group != self.group or (memo is self and len(self) > entries):
                memo.clear()
        for group, forget in Memo.kept.items():
            if group != self.group:
                for f in forget:
                    f()
        pa.default_memory_pool().release_unused()


WORD_HASH = Memo(xxhash.xxh3_64_intdigest, "words")


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(WORD_HASH.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """One 64-bit hash per window of `n` words; a shorter, non-empty text is one window."""
    if not len(words):
        return words
    n = min(n, len(words))
    last = len(words) - n + 1
    out = np.full(last, n, np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + last])
    return out


def long_of(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as the signed ones that Spark's long column holds."""
    return x.view(np.int64)


def changed(df: DataFrame, **columns: Column) -> DataFrame:
    """Replace columns in place, keeping names and order."""
    return df.select(*(columns[c].alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns))


def components(edges: DataFrame, label: str, rounds: int = 60) -> DataFrame:
    """Smallest node id of each node's connected component: rows (node, root) for all nodes of `edges` (a, b).

    Alternates large-star and small-star steps. Each step keeps at most one edge per node and neighbour, so the
    edges never multiply, and the number of rounds grows with the logarithm of the longest chain. Edges are
    written to the shared folder in each round; only a row count and a checksum of them come to the driver.
    Self edges are allowed and keep isolated nodes.
    """
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    live = settle(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        f"{label}-edges",
    )
    nodes = settle(nodes, f"{label}-nodes")
    before = None
    for _ in range(rounds):
        both = live.select(F.col("u").alias("n"), F.col("v").alias("m")).unionAll(live.select(F.col("v"), F.col("u")))
        low = both.groupBy("n").agg(F.least("n", F.min("m")).alias("low"))
        # Large star: the larger neighbours of a node now hang below its smallest neighbour.
        large = (
            both.where("m > n")
            .join(low, "n")
            .select(F.col("m").alias("u"), F.col("low").alias("v"))
            .distinct()
        )
        # Small star: a node and its smaller neighbours hang below the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct("u", F.col("low").alias("v")), F.struct(F.col("v").alias("u"), F.col("low").alias("v")))).alias("e")
        )
        live = settle(small.select("e.u", "e.v").where("u <> v").distinct(), f"{label}-edges")
        now = tuple(live.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = live.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("low"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("low", "node").alias("root"))
