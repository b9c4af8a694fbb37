"""Benchmark decontamination by greedy string tiling.

Seeds of a few words that documents share with benchmark items are joined, and every document is compared with the
items it can hold: the longest common runs of words that no earlier tile covers are marked again and again, found by
running Karp-Rabin hashes. The share of an item's words under tiles decides, so an item whose parts stand in another
order is found as well.
"""

from __future__ import annotations

from collections import defaultdict, deque

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import Memo, gram_hashes, long_of, mapped, settle, strings

#: Words of a seed and of the shortest tile; share of an item's words that tiles have to cover.
SEED = 5
COVERAGE = 0.5
#: Bits of the filter on the benchmark's seeds. Above some ten million seeds it lets more of the documents' seeds
#: into the join, which decides alone.
FILTER_BITS = 1 << 26
#: Multiplier of the running hash.
BASE = 0x9E3779B97F4A7C15

_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "“”‘’«»…–—"


def _plain_hash(word: str) -> int:
    core = word.strip(_EDGES).lower()
    return xxhash.xxh3_64_intdigest(core.encode("utf-8", "surrogatepass")) | 1 if core else 0


PLAIN_HASH = Memo(_plain_hash, "tiling")


def tokens(text: str) -> np.ndarray:
    """Hashes of the lower-case words without punctuation at their edges; never 0."""
    words = text.split()
    found = np.fromiter(map(PLAIN_HASH.__getitem__, words), np.uint64, len(words))
    return found[found != 0]


class Running:
    """Running Karp-Rabin hashes of a list of words, and the words that no tile covers yet."""

    def __init__(self, words: np.ndarray, powers: np.ndarray):
        self.words, self.powers = words, powers
        # Sums of word * BASE^k; a window's hash is its difference of sums, lifted to one common power.
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * powers[: len(words)], out=self.sums[1:])
        self.free = words != 0
        self.measure()

    def measure(self) -> None:
        """Free words from each position to the next covered one."""
        ends = np.where(self.free, len(self.free), np.arange(len(self.free)))
        self.ahead = np.minimum.accumulate(ends[::-1])[::-1] - np.arange(len(ends))

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the windows of `n` free words."""
        starts = np.flatnonzero(self.ahead >= n)
        return starts, (self.sums[starts + n] - self.sums[starts]) * self.powers[len(self.powers) - 1 - starts]


def tiles(doc: np.ndarray, item: np.ndarray, shortest: int = SEED) -> list[tuple[int, int, int]]:
    """Non-overlapping common runs (length, start in item, start in document), the longest first.

    Of equally long runs the first in the item, then in the document, is taken. An item shorter than `shortest`
    has to occur whole. Words of 0 match nothing. The longest length with a common hash is found by halving, as
    every shorter length has one too; runs of equal hashes are compared word by word before they count.
    """
    shortest = min(shortest, len(item))
    if not shortest or not len(doc):
        return []
    powers = np.full(max(len(doc), len(item)) + 1, BASE, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    a, b = Running(item, powers), Running(doc, powers)

    def common(n: int) -> bool:
        return bool(np.isin(a.windows(n)[1], b.windows(n)[1]).any())

    out = []
    most = int(min(a.ahead.max(), b.ahead.max()))
    while most >= shortest and common(shortest):
        low, high = shortest, most
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if common(middle) else (low, middle - 1)
        n = low
        starts, hashes = b.windows(n)
        mine, wanted = a.windows(n)
        there = np.isin(hashes, wanted)
        places: dict[int, deque] = defaultdict(deque)
        for h, d in zip(hashes[there].tolist(), starts[there].tolist()):
            places[h].append(d)
        for i, h in zip(mine.tolist(), wanted.tolist()):
            # Of tiles of one length only an end can lie in a window that was free before them.
            if not (a.free[i] and a.free[i + n - 1]) or h not in places:
                continue
            held = places[h]
            while held and not (b.free[held[0]] and b.free[held[0] + n - 1]):
                held.popleft()
            for d in held:
                if b.free[d] and b.free[d + n - 1] and np.array_equal(a.words[i : i + n], b.words[d : d + n]):
                    a.free[i : i + n] = b.free[d : d + n] = False
                    out.append((n, i, d))
                    break
        a.measure()
        b.measure()
        most = min(n - 1, int(a.ahead.max()), int(b.ahead.max()))
    return out


def grouped(hashes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The different hashes and the positions of each."""
    order = np.argsort(hashes, kind="stable")
    different, at = np.unique(hashes[order], return_index=True)
    return different, np.split(order, at[1:])


def nested(lists_of: list[np.ndarray], kind) -> pa.ListArray:
    ends = np.append(0, np.cumsum([len(x) for x in lists_of]))
    flat = np.concatenate(lists_of) if lists_of else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat).cast(kind))


def item_words(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, words) per benchmark row with words; `item` numbers the rows."""
    kind = benchmark.schema["item_id"].dataType.simpleString()

    def run(batch):
        PLAIN_HASH.trim()
        found = [long_of(tokens(t)) for t in strings(batch, "text")]
        yield {"item": batch.column("item"), "item_id": batch.column("item_id"), "words": nested(found, pa.int64())}

    rows = benchmark.select(F.monotonically_increasing_id().alias("item"), "item_id", "text")
    return mapped(rows, run, f"item long, item_id {kind}, words array<long>").where(F.size("words") > 0)


def item_seeds(items: DataFrame) -> DataFrame:
    """(item, n_words, seed, n) per different seed of an item with the places it has there. An item shorter than a
    seed is one itself."""

    def run(batch):
        out = defaultdict(list)
        for item, words in zip(batch.column("item").to_pylist(), batch.column("words")):
            held = words.values.to_numpy().view(np.uint64)
            seeds, n = np.unique(gram_hashes(held, SEED), return_counts=True)
            out["item"] += [item] * len(seeds)
            out["n_words"] += [len(held)] * len(seeds)
            out["seed"] += long_of(seeds).tolist()
            out["n"] += n.tolist()
        yield {c: out[c] for c in ("item", "n_words", "seed", "n")}

    return mapped(items.select("item", "words"), run, "item long, n_words int, seed long, n int")


def seed_filter(seeds: DataFrame) -> np.ndarray:
    """A bit for each seed hash, as bytes: Spark sets the bits of 64-bit words, of which there are FILTER_BITS / 64."""
    bit = F.pmod("seed", F.lit(FILTER_BITS))
    words = seeds.select((bit / 64).cast("long").alias("at"), F.expr("shiftleft(1L, cast(pmod(seed, 64) as int))").alias("bit"))
    table = words.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[table.column("at").to_numpy()] = table.column("bits").to_numpy()
    return out.view(np.uint64)


def document_seeds(docs: DataFrame, seen, lengths: list[int]) -> DataFrame:
    """(row, doc_id, seed, places) per different seed of a document that may be one of the benchmark's. `row` numbers
    the rows of `docs`, `seen` is a broadcast filter, `lengths` are the words of seeds."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batch):
        PLAIN_HASH.trim()
        bits = seen.value
        rows, seeds, places = [], [], []
        for k, text in enumerate(strings(batch, "text")):
            words = tokens(text)
            for n in lengths:
                if len(words) < n:
                    continue
                hashes = gram_hashes(words, n)
                at = hashes & np.uint64(FILTER_BITS - 1)
                near = np.flatnonzero(bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1))
                if len(near):
                    found, where = grouped(hashes[near])
                    rows += [k] * len(found)
                    seeds.append(long_of(found))
                    places += [near[w] for w in where]
        if rows:
            of = pa.array(rows, pa.int64())
            yield {
                "row": batch.column("row").take(of), "doc_id": batch.column("doc_id").take(of),
                "seed": pa.array(np.concatenate(seeds)), "places": nested(places, pa.int32()),
            }

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return mapped(numbered, run, f"row long, doc_id {kind}, seed long, places array<int>", 64)


def shared_words(item: np.ndarray, seeds: np.ndarray, places: list[np.ndarray]) -> np.ndarray:
    """The stretches of a document that shared seeds cover, with a 0 between them; the item's words give its own."""
    n = min(SEED, len(item))
    hashes = gram_hashes(item, n)
    order = np.argsort(hashes, kind="stable")
    first = order[np.searchsorted(hashes[order], seeds)]
    steps = np.arange(n)
    at = (np.concatenate(places)[:, None] + steps).ravel()
    words = item[(np.repeat(first, [len(p) for p in places])[:, None] + steps).ravel()]
    at, which = np.unique(at, return_index=True)
    return np.insert(words[which], np.flatnonzero(np.diff(at) > 1) + 1, 0)


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Rows (doc_id, item_id, n_words, n_covered, n_tiles, coverage) where a document holds enough of an item.

    `docs` has (doc_id, text), `benchmark` (item_id, text), ids of any type. Null and empty texts match nothing. Rows
    that repeat give rows each; a null doc_id or item_id stays null. Empty tables give no rows.

    Tiles that cover enough of an item hold at least a fifth of the words needed as seeds, so an item may lose its
    most frequent seeds up to one less than that without losing a document; pairs are found by the other seeds.
    """
    spark = docs.sparkSession
    items = settle(item_words(benchmark), "tiling-items")
    seeds = settle(item_seeds(items), "tiling-item-seeds")
    lengths = [r[0] for r in seeds.select(F.least("n_words", F.lit(SEED))).distinct().collect()]
    seen = spark.sparkContext.broadcast(seed_filter(seeds))
    found = settle(document_seeds(docs, seen, sorted(lengths)), "tiling-document-seeds")

    need = F.greatest(F.lit(1), F.ceil(F.col("n_words") * F.lit(coverage) / SEED - 1e-9))
    frequent = Window.partitionBy("item").orderBy(F.desc("n_docs"), "seed")
    n_docs = found.groupBy("seed").agg(F.count(F.lit(1)).alias("n_docs"))
    probes = seeds.join(n_docs, "seed").withColumn("upto", F.sum("n").over(frequent)).where(F.col("upto") >= need)
    pairs = found.select("row", "seed").join(probes.select("seed", "item"), "seed").select("row", "item").distinct()
    shared = pairs.join(seeds, "item").join(found, ["row", "seed"]).groupBy("row", "doc_id", "item", "n_words")
    shared = shared.agg(F.sum("n").alias("n_shared"), F.collect_list(F.struct("seed", "places")).alias("found"))
    enough = shared.where(F.col("n_shared") >= need).join(items, "item")

    def match(batch):
        rows, kept = [], []
        for k in range(batch.num_rows):
            item = batch.column("words")[k].values.to_numpy().view(np.uint64)
            pair = batch.column("found")[k].values
            places = [p.values.to_numpy() for p in pair.field("places")]
            at = tiles(shared_words(item, pair.field("seed").to_numpy().view(np.uint64), places), item)
            covered = sum(n for n, _, _ in at)
            if covered >= coverage * len(item):
                kept.append(k)
                rows.append((len(item), covered, len(at), covered / len(item)))
        if rows:
            some = pa.array(kept, pa.int64())
            yield dict(zip(("n_words", "n_covered", "n_tiles", "coverage"), zip(*rows))) | {
                c: batch.column(c).take(some) for c in ("doc_id", "item_id")
            }

    kinds = {c: t.schema[c].dataType.simpleString() for c, t in (("doc_id", docs), ("item_id", benchmark))}
    schema = f"doc_id {kinds['doc_id']}, item_id {kinds['item_id']}, n_words long, n_covered long, n_tiles long, coverage double"
    return mapped(enough.select("doc_id", "item_id", "words", "found"), match, schema, 64)


def keep_clean(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of `docs` whose doc_id holds no benchmark item, with all their columns, whatever their names.

    Rows without a doc_id are known by their text.
    """
    taken, key = {c.lower() for c in docs.columns}, "key"
    while key in taken:
        key += "_"
    known = F.coalesce(F.concat(F.lit("i"), F.col("doc_id").cast("string")), F.concat(F.lit("t"), F.sha2("text", 256)))
    found = leaks(docs.select(known.alias("doc_id"), "text"), benchmark, coverage)
    keyed = docs.withColumn(key, known)
    return keyed.join(found.select(F.col("doc_id").alias(key)).distinct(), key, "left_anti").select(
        *(F.col(f"`{c}`") for c in docs.columns)
    )
