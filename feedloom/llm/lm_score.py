"""Cross-entropy difference of documents under two matched bigram models, target against background.

Both models have the same vocabulary, order and smoothing; they differ only in the texts they count. The vocabulary
is every word of all texts, unless the caller closes it. Words and bigrams are counted per chunk of documents, the
chunks' counts are added up in buckets of the hash space, and every chunk gets the sums of its own words and bigrams
back. A bigram is one entry of a chunk however often it occurs there, so a hot one has as many entries as there are
chunks; nothing that grows with the corpus is collected or broadcast. Words and bigrams are 64-bit hashes; a chunk's
texts are kept as a list of words and numbers in it, hashes move once and as differences, and sums go back without them.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import BATCH_ROWS, MEMO_ENTRIES, Memo, mix, settle, strings

#: Weight of the bigram against the word's own share; pseudo-count of a word.
BIGRAM_WEIGHT = 0.7
PSEUDO = 1.0
#: Of a vocabulary that the caller closes: classes of other words, and the entry before the first word of a text.
CLASSES = 32
START = CLASSES
#: Words of a chunk of documents, which is one document at least; bytes of text for each bucket of the hash space.
CHUNK_WORDS = 1_000_000
BUCKET_BYTES = 8_000_000

#: Kinds of counts of a chunk: words and bigrams. Counts of an entry by kind.
WORD, PAIR = 0, 1
WIDTH = {WORD: 4, PAIR: 2}

_DIGITS = set("0123456789")


def shape(word: str) -> int:
    """Class of a word outside the vocabulary: digits, symbols, letters beyond ASCII, and length."""
    core = word.strip(".,;:!?\"'()")
    symbols = not core.isalnum()
    size = min(3, max(0, len(core) - 1).bit_length() - 1) if len(core) > 1 else 0
    return 16 * bool(_DIGITS & set(word)) + 8 * symbols + 4 * (not word.isascii()) + size


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts, words in lower case."""

    def count(batches):
        words: Counter = Counter()

        def emit():
            out = pa.RecordBatch.from_arrays(
                [pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], names=["word", "n"]
            )
            words.clear()
            return out

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for text in strings(batch.slice(at, 256), "text"):
                    words.update(text.lower().split())
                if len(words) > MEMO_ENTRIES:
                    yield emit()
        yield emit()

    return docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, words: int) -> dict[str, int]:
    """Entries of the most frequent words, ties in order of the word; classes and the start come before them."""
    top = word_counts(docs).orderBy(F.desc("n"), "word").limit(words).collect()
    return {r["word"]: START + 1 + k for k, r in enumerate(top)}


def hash_of(entry: int) -> int:
    return int(mix(np.array([entry], np.uint64))[0])


class Words(Memo):
    """Hash of any word; of its entry in a closed vocabulary, where one is given."""

    def __init__(self, known: dict[str, int] | None):
        if known is None:
            super().__init__(xxhash.xxh3_64_intdigest, "language models")
        else:
            super().__init__(lambda w: hash_of(known[w] if w in known else shape(w)), "language models")
        # No word is empty, so the empty one stands before a text.
        self.start = np.uint64(xxhash.xxh3_64_intdigest("") if known is None else hash_of(START))


def pair_of(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hash of the bigrams of two columns of word hashes."""
    return mix(mix(first) * np.uint64(0x9E3779B97F4A7C15) + second)


def before(words: np.ndarray, sizes: np.ndarray, start) -> np.ndarray:
    """What stands before each word of texts that follow each other: the start, or the word before."""
    out = np.empty_like(words)
    out[1:] = words[:-1]
    out[(np.cumsum(sizes) - sizes)[sizes > 0]] = start
    return out


def packed(values: np.ndarray) -> bytes:
    """Integers as bytes: the lowest bytes of all, then the next ones, compressed behind their size."""
    raw = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def plain(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], size, codec="zstd", asbytes=True) if size else b""


def unpacked(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(plain(data), np.uint8).reshape(width, -1).T).view(kind).ravel()


class Numbers(dict):
    """Numbers of words in the order in which they come."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def chunk_row(chunk: int, ids: list[pa.Array], texts: list[np.ndarray], numbers: Numbers) -> dict:
    """A chunk's documents: their ids, sizes and words as numbers in the chunk's list of words.

    Frequent words have the small numbers, and words as frequent as each other are in order, so both compress well.
    """
    flat = np.concatenate(texts)
    names = sorted(numbers)
    order = np.fromiter(map(numbers.__getitem__, names), np.int64, len(names))
    turn = np.argsort(-np.bincount(flat, minlength=len(names))[order], kind="stable")
    rank = np.empty(len(names), np.uint32)
    rank[order[turn]] = np.arange(len(names), dtype=np.uint32)
    held = pa.concat_arrays(ids)
    return {
        "chunk": [chunk],
        "doc_ids": pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held),
        "sizes": [packed(np.array([len(t) for t in texts], np.int64))],
        "names": [packed(np.frombuffer(" ".join(names[k] for k in turn.tolist()).encode(), np.uint8))],
        "words": [packed(rank[flat])],
    }


def chunked(docs: DataFrame) -> DataFrame:
    """A row for each chunk of `docs` (doc_id, text); see `chunk_row`."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = StructType.fromDDL(f"chunk long, doc_ids array<{kind}>, sizes binary, names binary, words binary")
    arrow = to_arrow_schema(schema)

    def run(batches):
        chunk, held = TaskContext.get().partitionId() << 32, 0
        ids, texts, numbers = [], [], Numbers()

        def emit():
            columns = chunk_row(chunk, ids, texts, numbers)
            made = [c if isinstance(c, pa.Array) else pa.array(c) for c in (columns[f.name] for f in arrow)]
            return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(made, arrow)], schema=arrow)

        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                words = strings(row, "text")[0].lower().split()
                ids.append(row.column("doc_id"))
                texts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                held += len(words)
                if held >= CHUNK_WORDS or len(ids) >= CHUNK_WORDS // 10:
                    yield emit()
                    chunk, held, ids, texts, numbers = chunk + 1, 0, [], [], Numbers()
        if ids:
            yield emit()

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def entries(sizes: np.ndarray, names: bytes, words: bytes, entry: Words):
    """What the models count in a chunk: hashes of its words and of its bigrams, sorted; for each word of its texts the
    numbers of the word before it, of itself and of the bigram; and for each bigram a place where it stands."""
    listed = plain(names).decode().split(" ") if len(plain(names)) else []
    hashes = np.fromiter(map(entry.fn, listed), np.uint64, len(listed))
    different, back = np.unique(np.append(hashes, entry.start), return_inverse=True)
    local = back[:-1][unpacked(words, np.uint32)]
    first = before(local, sizes, back[-1])
    pairs, some, which = np.unique(pair_of(different[first], different[local]), return_index=True, return_inverse=True)
    return different, pairs, first, local, which, some


def counts_of(chunks: DataFrame, known, buckets: int) -> DataFrame:
    """The counts of every chunk (chunk, sizes, names, words, marked), cut by bucket of the hash space.

    `marked` has the places of the target's documents in the chunk, null for none. Hashes are kept as differences.
    """

    def run(batches):
        entry = Words(None if known is None else known.value)
        entry.trim()
        for batch in batches:
            for row in batch.to_pylist():
                sizes = unpacked(row["sizes"], np.int64)
                target = np.zeros(len(sizes), bool)
                target[np.array(row["marked"] or [], np.int64)] = True
                wanted = np.repeat(target, sizes)
                different, pairs, first, local, which, _ = entries(sizes, row["names"], row["words"], entry)
                n = len(different)
                by_word = [np.bincount(x, minlength=n) for x in (first[wanted], first, local[wanted], local)]
                by_pair = [np.bincount(x, minlength=len(pairs)) for x in (which[wanted], which)]
                kind, bucket, keys, counts = [], [], [], []
                for k, hashes, columns in ((WORD, different, by_word), (PAIR, pairs, by_pair)):
                    # Sorted hashes lie bucket by bucket.
                    places = (hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
                    cuts = np.searchsorted(places, np.arange(buckets + 1))
                    used = np.flatnonzero(np.diff(cuts))
                    steps = np.diff(hashes, prepend=np.uint64(0))
                    steps[cuts[used]] = hashes[cuts[used]]
                    table = np.stack(columns).astype(np.int64)
                    kind += [k] * len(used)
                    bucket += used.tolist()
                    for a, b in zip(cuts[used].tolist(), cuts[used + 1].tolist()):
                        keys.append(packed(steps[a:b]))
                        counts.append(packed(table[:, a:b].ravel()))
                for at in range(0, len(kind), BATCH_ROWS):
                    some = slice(at, at + BATCH_ROWS)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row["chunk"]] * len(kind[some]), pa.int64()), pa.array(kind[some], pa.int32()),
                            pa.array(bucket[some], pa.int64()), pa.array(keys[some], pa.binary()), pa.array(counts[some], pa.binary()),
                        ],
                        names=["chunk", "kind", "bucket", "keys", "counts"],
                    )

    schema = "chunk long, kind int, bucket long, keys binary, counts binary"
    return chunks.select("chunk", "sizes", "names", "words", "marked").mapInArrow(run, schema)


def totals(counts: DataFrame) -> DataFrame:
    """The chunks' counts with the sums over all chunks in place of their own, in the order in which they came.

    Of words, `n_new` sums to the number of different entries, `n_target` and `n_all` to the words of the two texts.
    """

    def add(group: pa.Table) -> pa.Table:
        kind = group.column("kind")[0].as_py()
        keys = [np.cumsum(unpacked(k, np.uint64), dtype=np.uint64) for k in group.column("keys").to_pylist()]
        ends = np.cumsum([len(k) for k in keys])
        own = np.concatenate([unpacked(c, np.int64).reshape(WIDTH[kind], -1) for c in group.column("counts").to_pylist()], axis=1)
        different, which = np.unique(np.concatenate(keys), return_inverse=True)
        # Sums of floats are exact below 2^53.
        sums = np.stack([np.bincount(which, weights=c)[which].astype(np.int64) for c in own])
        once = np.zeros((3, len(keys)), np.int64)
        if kind == WORD:
            once[:, 0] = len(different), own[2].sum(), own[3].sum()
        return pa.table(
            {
                "chunk": group.column("chunk"), "kind": group.column("kind"), "bucket": group.column("bucket"),
                "counts": pa.array([packed(sums[:, a:b].ravel()) for a, b in zip([0, *ends[:-1]], ends)], pa.binary()),
                "n_new": once[0], "n_target": once[1], "n_all": once[2],
            }
        )

    return counts.groupBy("kind", "bucket").applyInArrow(
        add, "chunk long, kind int, bucket long, counts binary, n_new long, n_target long, n_all long"
    )


def losses(pair: np.ndarray, first: np.ndarray, second: np.ndarray, n_words: int, size: int) -> np.ndarray:
    """Loss in bits of the second word of bigrams: counts of the bigram, of its first word as a first one, of its
    second word; `n_words` words were counted and the vocabulary has `size` entries. The same for each model."""
    bigram = np.divide(pair, first, out=np.zeros(len(pair)), where=first > 0)
    weight = np.where(first > 0, BIGRAM_WEIGHT, 0.0)
    return -np.log2(weight * bigram + (1 - weight) * (second + PSEUDO) / (n_words + PSEUDO * size))


def cross_entropy(docs: DataFrame, target_ids: DataFrame, words: int | None = None) -> DataFrame:
    """(doc_id, n_words, target_loss, background_loss, difference) per document (doc_id, text).

    `target_ids` (doc_id) names the documents of the target; the background are all documents. Losses are bits per
    word, `difference` is the mean of the word losses under the target less those under the background: the lower,
    the more a text is like the target. The vocabulary is every word of all texts; a caller that passes `words` closes
    it to so many frequent words, and others count as classes by shape. A null or empty text has no words and losses
    of 0. Rows that repeat are counted and scored each; a null doc_id is never in the target. Empty tables give no rows.
    """
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    base = docs.select("doc_id", "text")
    known = None if words is None else spark.sparkContext.broadcast(vocabulary(base, words))
    n_bytes = base.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(1, math.ceil(n_bytes / BUCKET_BYTES))
    chunks = settle(chunked(base), "language-chunks")
    # Only ids meet the target's ids, and only packed chunks move. The same joins at every size: what grows with the
    # corpus is never broadcast.
    marked = (
        chunks.select("chunk", F.posexplode("doc_ids").alias("at", "doc_id"))
        .join(target_ids.select("doc_id").dropDuplicates(["doc_id"]).hint("merge"), "doc_id", "left_semi")
        .groupBy("chunk")
        .agg(F.collect_list("at").alias("marked"))
    )
    sums = settle(totals(counts_of(chunks.join(marked.hint("merge"), "chunk", "left"), known, buckets)), "language-sums")
    seen = sums.agg(*(F.sum(c).alias(c) for c in ("n_new", "n_target", "n_all"))).first()
    counted = (seen["n_target"] or 0, seen["n_all"] or 0)
    size = START + 1 + words if words is not None else seen["n_new"] or 0
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(chunk: pa.Table, group: pa.Table) -> pa.Table:
        entry = Words(None if known is None else known.value)
        entry.trim()
        row = {c: chunk.column(c)[0].as_py() for c in ("sizes", "names", "words")}
        sizes = unpacked(row["sizes"], np.int64)
        total_loss = [np.zeros(len(sizes)), np.zeros(len(sizes))]
        _, _, first, local, which, some = entries(sizes, row["names"], row["words"], entry)
        if len(local):
            # The sums in the order of their hashes, as they were counted.
            group = group.sort_by([("kind", "ascending"), ("bucket", "ascending")])
            rows = list(zip(group.column("kind").to_pylist(), group.column("counts").to_pylist()))
            word_counts, pair_counts = (
                np.concatenate([unpacked(c, np.int64).reshape(WIDTH[k], -1) for of, c in rows if of == k], axis=1)
                for k in (WORD, PAIR)
            )
            a, b = first[some], local[some]
            owner = np.repeat(np.arange(len(sizes)), sizes)
            for k, n_words in enumerate(counted):
                bits = losses(pair_counts[k], word_counts[k, a], word_counts[2 + k, b], n_words, size)
                total_loss[k] = np.bincount(owner, weights=bits[which], minlength=len(sizes)) / np.maximum(sizes, 1)
        target, background = total_loss
        return pa.table(
            {
                "doc_id": chunk.column("doc_ids").combine_chunks().flatten(), "n_words": sizes, "target_loss": target,
                "background_loss": background, "difference": target - background,
            }
        )

    # Every chunk meets the sums of its own entries; only those are moved.
    schema = f"doc_id {kind}, n_words long, target_loss double, background_loss double, difference double"
    own = sums.select("chunk", "kind", "bucket", "counts").groupBy("chunk")
    return chunks.groupBy("chunk").cogroup(own).applyInArrow(score, schema)
