"""Quality scores by a factorisation machine over hashed words, structure statistics and the length in the metadata.

The model is w0 + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j. The pairs cost linear time: for every factor, half
of the squared sum less the sum of squares. It is fitted on a bounded sample of labelled documents; every
document is scored.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import WORD_HASH, gram_hashes, mapped, strings, word_hashes

#: Labelled documents used for fitting at most, in order of a hash of doc_id; the others are not needed.
SAMPLE = 6_000
#: Buckets of hashed words, factors, steps, documents per step, step size, penalty.
BUCKETS = 1 << 15
FACTORS = 8
STEPS = 1_200
BATCH = 64
STEP = 0.05
PENALTY = 1e-5

#: Upper ends of the bins of sizes and of shares.
SIZES = np.array([0, 1, 2, 5, 10, 20, 35, 50, 80, 150, 400, 1_000, 3_000, 10_000], float)
SHARES = np.array([0, 0.002, 0.005, 0.01, 0.02, 0.04, 0.07, 0.1, 0.15, 0.2, 0.3, 0.45, 0.6, 0.8, 0.95])

_ASCII_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_SYMBOLS = b"#*$%&|<>"
_END = re.compile(rb"[.!?](?=\s|$)")

STATISTICS = 17
WIDTH = BUCKETS + STATISTICS * 16


def statistics(text: bytes, words: list[bytes], hashes: np.ndarray, n_chars: int | None) -> list[int]:
    """The bin of each structure statistic, as an index below `STATISTICS` * 16."""
    n, size = max(len(words), 1), max(len(text), 1)
    without = lambda chars: size - len(text.translate(None, chars)) if text else 0
    lines = [x for x in (y.strip() for y in text.split(b"\n")) if x]
    _, times = np.unique(hashes, return_counts=True)
    grams = np.unique(gram_hashes(hashes, 3), return_counts=True)[1] if len(hashes) > 3 else np.ones(1, int)
    length = len(text.decode("utf-8", "replace"))
    sizes = (len(words), len(lines), n_chars if n_chars is not None else length, size / n, len(words) / max(len(lines), 1), max(map(len, words), default=0))
    shares = (
        without(_ASCII_UPPER) / size,
        without(_DIGITS) / size,
        without(_SYMBOLS) / size,
        text.count(b"!") / n,
        text.count(b",") / n,
        len(_END.findall(text)) / n,
        1 - len(set(lines)) / max(len(lines), 1),
        1 - len(times) / n if len(words) else 0.0,
        times.max() / n if len(times) else 0.0,
        float(grams[grams > 1].sum() / grams.sum()),
        (size - len(text.decode("utf-8", "replace"))) / size if text else 0.0,
    )
    bins = [int(np.searchsorted(SIZES, x)) for x in sizes] + [int(np.searchsorted(SHARES, x)) for x in shares]
    return [16 * k + min(b, 15) for k, b in enumerate(bins)]


def features(text: str, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values: words with the root of their share, statistics as ones. Empty texts have statistics only."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    hashes = word_hashes([w.lower() for w in words])
    bucket, times = np.unique((hashes & np.uint64(BUCKETS - 1)).astype(np.int64), return_counts=True)
    own = BUCKETS + np.array(statistics(data, words, hashes, n_chars), np.int64)
    values = np.concatenate([np.sqrt(times / max(len(words), 1)), np.full(len(own), 0.5)])
    return np.concatenate([bucket, own]), values


class Model:
    """Bias, weights and factors."""

    def __init__(self, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.bias, self.weights, self.factors = bias, weights, factors

    def raw(self, index: np.ndarray, value: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the logistic function, and the sums per factor, of `n` documents laid end to end."""
        terms = self.factors[index] * value[:, None]
        at = np.searchsorted(rows, np.arange(n))
        sums = np.add.reduceat(terms, at, axis=0)
        squares = np.add.reduceat(terms * terms, at, axis=0)
        linear = np.add.reduceat(self.weights[index] * value, at)
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1), sums

    def score(self, index: np.ndarray, value: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(index, value, rows, n)[0], -30, 30)))


def joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = np.repeat(np.arange(len(parts)), [len(i) for i, _ in parts])
    return np.concatenate([i for i, _ in parts]), np.concatenate([v for _, v in parts]), rows


def fit(parts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7) -> Model:
    """Minimise the logistic loss with adaptive steps; each class weighs according to its number of documents."""
    rng = np.random.default_rng(seed)
    model = Model(0.0, np.zeros(WIDTH), rng.normal(0, 0.05, (WIDTH, FACTORS)))
    share = min(max(float(labels.mean()), 0.01), 0.99) if len(labels) else 0.5
    model.bias = float(np.log(share / (1 - share)))
    seen_w, seen_v = np.full(WIDTH, 1e-6), np.full((WIDTH, FACTORS), 1e-6)
    left = STEPS if len(labels) else 0
    while left:
        order = rng.permutation(len(labels))
        for some in np.array_split(order, max(1, len(order) // BATCH))[:left]:
            left -= 1
            index, value, rows = joined([parts[k] for k in some])
            raw, sums = model.raw(index, value, rows, len(some))
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[some]) / len(some)
            there, place = np.unique(index, return_inverse=True)
            slope = error[rows] * value
            dw = np.bincount(place, slope, len(there)) + PENALTY * model.weights[there]
            inner = slope[:, None] * (sums[rows] - model.factors[index] * value[:, None])
            dv = np.stack([np.bincount(place, inner[:, f], len(there)) for f in range(FACTORS)], axis=1)
            dv += PENALTY * model.factors[there]
            seen_w[there] += dw * dw
            seen_v[there] += dv * dv
            model.weights[there] -= STEP * dw / np.sqrt(seen_w[there])
            model.factors[there] -= STEP * dv / np.sqrt(seen_v[there])
            model.bias -= STEP * float(error.sum())
    return model


def held_out(doc_id: Column) -> Column:
    """Whether a document is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most `sample` labelled documents (doc_id, quality) that are not held out, whole texts."""
    chosen = (
        labels.where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    rows = docs.select("doc_id", "text", *chars(docs)).join(F.broadcast(chosen), "doc_id")

    def describe(batch):
        WORD_HASH.trim()
        found = [features(t, n) for t, n in zip(strings(batch, "text"), batch.column("n_chars").to_pylist())]
        index, value = [i for i, _ in found], [v for _, v in found]
        yield {"quality": batch.column("quality"), "doc_id": batch.column("doc_id"), "index": index, "value": value}

    kind = docs.schema["doc_id"].dataType.simpleString()
    table = mapped(
        rows.select("doc_id", F.col("quality").cast("double").alias("quality"), "text", "n_chars"),
        describe,
        f"quality double, doc_id {kind}, index array<int>, value array<float>",
    ).toArrow()
    table = table.sort_by("doc_id")
    parts = []
    for chunk_i, chunk_v in zip(table.column("index").chunks, table.column("value").chunks):
        i, v = chunk_i.flatten().to_numpy().astype(np.int64), chunk_v.flatten().to_numpy().astype(float)
        cuts = np.cumsum(np.diff(chunk_i.offsets.to_numpy()))[:-1]
        parts += list(zip(np.split(i, cuts), np.split(v, cuts))) if len(chunk_i) else []
    return fit(parts, table.column("quality").to_numpy())


def chars(docs: DataFrame) -> list[Column]:
    there = "n_chars" in docs.columns
    return [(F.col("n_chars") if there else F.lit(None)).cast("long").alias("n_chars")]


def score_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, least: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of `docs` (doc_id, text, n_chars where there is one).

    `labels` (doc_id, quality 0/1) are learned from only where a document is not held out; of several labels of a
    document the largest counts. doc_id, language and source are never inputs. A null text is scored as the empty
    one, a null n_chars as the text's own length. Rows that repeat get equal scores. Without labels every score is
    what the starting weights give; an empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(batch):
        WORD_HASH.trim()
        found = [features(t, n) for t, n in zip(strings(batch, "text"), batch.column("n_chars").to_pylist())]
        scores = model.value.score(*joined(found), len(found))
        ids = batch.column("doc_id").to_pylist()
        yield {
            "doc_id": batch.column("doc_id"),
            "held_out": [x is None or zlib.crc32(str(x).encode()) % 5 == 0 for x in ids],
            "score": pa.array(scores, pa.float64()),
            "predicted": (scores >= least).astype(np.int32),
        }

    return mapped(docs.select("doc_id", "text", *chars(docs)), score, f"doc_id {kind}, held_out boolean, score double, predicted int")
