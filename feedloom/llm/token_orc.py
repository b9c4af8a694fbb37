"""Token ids as ORC files in document order, and reading them back stripe by stripe.

ORC stores the ids as run-length encoded integers, keeps a row index and a Bloom filter on `doc_id`
in every stripe, and Spark reads stripes in parallel and skips those whose statistics or filter rule
out a searched document.
"""

from __future__ import annotations

import gc
import re
import zlib
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import Memo, mapped
from feedloom.session import work_dir

#: Bytes of a stripe before compression, rows of a row-index group, share of false hits of the Bloom filters.
STRIPE_BYTES = 16 << 20
INDEX_ROWS = 1_000
BLOOM_FPP = 0.01

#: Rows that are encoded together. Chunks whose ids a worker keeps.
ENCODE_ROWS = 1_024
KNOWN_CHUNKS = 1_000_000

_ODD_SPACE = re.compile(r"[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_CHUNK = re.compile(r"\s*\S+|\s+")
# The vocabulary's pattern for chunks of these characters, each of which is a letter, a digit, a sign or
# a space in every Unicode version.
_PLAIN = re.compile(r"[\n !-~À-ÖØ-öø-ɏ]*\Z")
_WORD = re.compile(r" [A-Za-zÀ-ÖØ-öø-ɏ]+\Z")
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ɏ]+| ?[0-9]+| ?[^\sA-Za-z0-9À-ÖØ-öø-ɏ]+|\s+(?!\S)|\s+")


class Encoder:
    """Byte-level BPE by the tokenizers library, one call per distinct chunk of text.

    The pre-tokenizer of this vocabulary never joins a character to white space that follows it, so a text
    may be cut before each run of white space and the chunks' ids put together. Chunks that a worker has not
    met are encoded many at a time as one text; the known byte length of every token tells them apart.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        tokens = self.library.get_vocab(with_added_tokens=True)
        self.length = np.zeros(max(tokens.values()) + 1, np.int64)
        for token, at in tokens.items():
            self.length[at] = len(token)
        self.model = self.library.model
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = (b for b in range(256) if b not in plain)
        self.char = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(other)}
        self.pieces = Memo(lambda piece: (self.spaced.get(piece[1:]) if piece[0] == " " else None) or self.merge(piece), "chunks")
        self.known = Memo(self.single, "chunks")
        self.spaced = Memo(lambda word: self.single(f" {word}"), "chunks")

    def single(self, chunk: str) -> bytes:
        ids = self.library.encode_batch_fast([chunk], add_special_tokens=False)[0].ids
        return np.array(ids, np.int32).tobytes()

    def merge(self, piece: str) -> bytes:
        """Ids of a piece that the pattern cut out: its bytes, merged by the vocabulary's own merge table."""
        text = piece.replace(" ", self.char[32]).replace("\n", self.char[10]) if piece.isascii() else "".join(map(self.char.__getitem__, piece.encode()))
        return array("i", [t.id for t in self.model.tokenize(text)]).tobytes()

    def learn(self, known: Memo, keys: list[str], chunks: list[str], at_once: int = 2_000) -> None:
        """Encode new chunks, known by `keys`; all begin with white space and end without it.

        A chunk of plain letters, digits and signs is cut by the vocabulary's pattern, and words that stand in several chunks are
        merged once. The library encodes the others, many at a time as one text, cut by the byte length of every token.
        """
        ids_of, others = self.pieces.__getitem__, []
        for key, chunk in zip(keys, chunks):
            if _WORD.match(chunk):
                # Held once, as a chunk or as a piece.
                known[key] = self.pieces.get(chunk) or self.merge(chunk)
            elif _PLAIN.match(chunk):
                known[key] = b"".join(map(ids_of, _PIECE.findall(chunk)))
            else:
                others.append((key, chunk))
        for start in range(0, len(others), at_once):
            some = others[start : start + at_once]
            ids = np.array(self.library.encode_batch_fast(["".join(c for _, c in some)], add_special_tokens=False)[0].ids, np.int32)
            ends = np.cumsum([len(c.encode()) for _, c in some])
            cuts = (4 * (np.searchsorted(np.cumsum(self.length[ids]), ends, side="left") + 1)).tolist()
            data = ids.tobytes()
            known.update((key, data[a:b]) for (key, _), a, b in zip(some, [0, *cuts], cuts))

    def known_ids(self, known: Memo, keys: list[str], usable: Callable[[str], bool], before: str) -> list[bytes]:
        """The ids of different chunks, each `before` and its key; those that are new are learned together, if they are usable."""
        ids = list(map(known.get, keys))
        missing = [k for k, x in enumerate(ids) if x is None]
        new = [c for c in map(keys.__getitem__, missing) if usable(c)]
        self.learn(known, new, [before + c for c in new] if before else new)
        for k in missing:
            ids[k] = known[keys[k]]
        return ids

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each text has. A null text has none.

        Text without a space beside other white space is cut at its spaces, any other text in front of each run of white
        space. The words behind a space are known without it; each different word of the column is looked up once.
        """
        self.known.trim(KNOWN_CHUNKS)
        self.spaced.trim(KNOWN_CHUNKS)
        self.pieces.trim(KNOWN_CHUNKS)
        column = column.fill_null("")
        odd = {
            k: text
            for k, text in enumerate(column.to_pylist())
            if "  " in text or " \n" in text or "\n " in text or _ODD_SPACE.search(text)
        }
        cut = {k: _CHUNK.findall(text) for k, text in odd.items()}
        chunks = list(dict.fromkeys(c for some in cut.values() for c in some))
        self.known_ids(self.known, chunks, lambda c: c[0].isspace() and not c[-1].isspace() and "<|" not in c, "")
        usual = np.ones(len(column), bool)
        usual[list(odd)] = False
        split = pc.split_pattern(column.filter(pa.array(usual)), " ")
        offsets, words = split.offsets.to_numpy(), split.flatten()
        start = offsets[:-1]
        coded = words.dictionary_encode()
        data = self.known_ids(self.spaced, coded.dictionary.to_numpy(zero_copy_only=False).tolist(), lambda c: c and not c[-1].isspace() and "<|" not in c, " ")
        # No space stands before the first word of a text.
        codes = coded.indices.to_numpy().copy()
        codes[start] = np.arange(len(data), len(data) + len(start))
        data += [self.known[w] if w else b"" for w in words.take(pa.array(start)).to_pylist()]
        ends_of = np.cumsum([0, *map(len, data)], dtype=np.int32) // 4
        table = pa.ListArray.from_arrays(pa.array(ends_of), pa.array(np.frombuffer(b"".join(data), np.int32)))
        ids = table.take(pa.array(codes)).flatten().to_numpy()
        ends = np.append(0, np.cumsum(np.diff(ends_of)[codes], dtype=np.int64))
        counts, usual_ends = np.zeros(len(column), np.int64), ends[offsets]
        counts[usual] = np.diff(usual_ends)
        if odd:
            parts, at = [], 0
            for k in range(len(column)):
                if k in cut:
                    parts.append(np.frombuffer(b"".join(map(self.known.__getitem__, cut[k])), np.int32))
                    counts[k] = len(parts[-1])
                else:
                    parts.append(ids[at : at + counts[k]])
                    at += counts[k]
            ids = np.concatenate(parts)
        return ids, counts

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as 32-bit integers."""
        ids, counts = self.encode_column(pa.array(texts, pa.string()))
        return [x.tobytes() for x in np.split(ids, np.cumsum(counts)[:-1])] if texts else []


@lru_cache(2)
def encoder(path: str) -> Encoder:
    # Lists of a million short strings make no cycles; looking for them costs a tenth of the time.
    gc.set_threshold(500_000, 50, 50)
    return Encoder(path)


Memo.kept["chunks"] = [encoder.cache_clear]


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int | None) -> DataFrame:
    """Rows (part, doc_id, row, token_offset, n_tokens, ids) in ascending order of `doc_id` over the partitions `part`.

    `row` and `token_offset` count rows and ids from the start of the partition, which becomes one file.
    A null text is the empty text, which has the end id only. Rows that repeat a `doc_id` stay apart, in order
    of a hash of their text; a null `doc_id` comes first.
    """
    ordered = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("_tie"))
        .repartitionByRange("doc_id", "_tie")
        .sortWithinPartitions("doc_id", "_tie")
        .select("doc_id", "text")
    )

    def encode(batches):
        row = offset = 0
        place = TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, ENCODE_ROWS):
                part = batch.slice(at, ENCODE_ROWS)
                flat, counts = encoder(tokenizer).encode_column(part.column("text"))
                if end_id is not None:
                    flat, counts = np.insert(flat, np.cumsum(counts), end_id), counts + 1
                ends = np.append(0, np.cumsum(counts))
                if ends[-1] >= 1 << 31:
                    raise ValueError(f"{ENCODE_ROWS} documents hold more than 2^31 ids")
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
                rows = pa.array(np.arange(row, row + len(counts)), pa.int64())
                offsets = pa.array(offset + ends[:-1], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(counts), place, np.int32)), part.column("doc_id").cast(pa.int64()), rows, offsets, pa.array(counts), ids],
                    names=["part", "doc_id", "row", "token_offset", "n_tokens", "ids"],
                )
                row, offset = row + len(counts), offset + int(ends[-1])

    return ordered.mapInArrow(encode, "part int, doc_id long, row long, token_offset long, n_tokens long, ids array<int>")


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = None) -> None:
    """Encode documents (doc_id, text) and write their ids as ORC files; other columns are not read."""
    (
        encode_documents(docs, tokenizer, end_id)
        .write.option("compression", "zstd")
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", INDEX_ROWS)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", BLOOM_FPP)
        .orc(path)
    )


def read_tokens(spark, path: str) -> DataFrame:
    """Rows (part, doc_id, row, token_offset, n_tokens, ids) as they stand in the files, `part` the number of the file."""
    return spark.read.schema("part int, doc_id long, row long, token_offset long, n_tokens long, ids array<int>").orc(path)


def find_documents(spark, path: str, doc_ids: list[int]) -> DataFrame:
    """Rows (doc_id, ids) of some documents; stripes are skipped by their ranges and Bloom filters."""
    rows = spark.read.schema("doc_id long, ids array<int>").orc(path)
    return rows.where(F.col("doc_id").isin(doc_ids))


def token_digests(rows: DataFrame) -> DataFrame:
    """Per document of `read_tokens`: (doc_id, start, n_tokens, ids_crc32).

    `start` is the number of ids of all documents before it, in the order of the files.
    """

    def digest(batch):
        ids = batch.column("ids")
        ends = ids.offsets.to_numpy()
        data = memoryview(np.ascontiguousarray(ids.values.to_numpy(), np.int32)).cast("B")
        yield {c: batch.column(c) for c in ("part", "doc_id", "token_offset")} | {
            "n_tokens": np.diff(ends),
            "ids_crc32": [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(ends[:-1], ends[1:])],
        }

    schema = "part int, doc_id long, token_offset long, n_tokens long, ids_crc32 long"
    digests = mapped(rows.drop("row", "n_tokens"), digest, schema)
    # One row per file: a running sum over the files, not over the documents. The ids are not read for it.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        rows.groupBy("part")
        .agg(F.sum("n_tokens").alias("_ids"))
        .select("part", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_base"))
    )
    start = (F.col("_base") + F.col("token_offset")).alias("start")
    # A dozen bytes for every task that wrote a file.
    return digests.join(F.broadcast(bases), "part").select("doc_id", start, "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer: str, end_id: int | None = None) -> DataFrame:
    """Write the token files of all documents to the shared folder and return the digests read back from them.

    An empty table gives no rows. Very long texts are cut into chunks like any other; nothing is truncated.
    """
    spark, path = docs.sparkSession, work_dir(docs.sparkSession, "token-orc")
    write_tokens(docs, path, tokenizer, end_id)
    return token_digests(read_tokens(spark, path))
