"""Minimal acyclic transducer of words, and word-level BPE that uses it.

`build` puts sorted words into an automaton with shared suffixes. Every arc carries a number; the numbers
along a word add up to the word's rank, and the rank selects the word's ids. The automaton is one flat array
of 32-bit integers that workers map into memory.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
import uuid
from array import array
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import MEMO_ENTRIES, Memo, mapped, settle, strings
from feedloom.session import work_dir

#: Words that the automaton holds at most. All other words are merged exactly, so this bounds memory, not results.
LEXICON_WORDS = 1 << 16
#: Words and pieces of text between white space whose ids a worker keeps.
KNOWN = 500_000

# The layout of the array, and marks that are a word of their own behind letters.
HEADER = 4
MARKS = frozenset(".,;:!?")


def build(entries: list[tuple[bytes, list[int]]]) -> np.ndarray:
    """The automaton of (word, ids) pairs with distinct words, as one array.

    Words are added in sorted order; the states behind the last shared prefix can then no longer change and
    are replaced by equal ones, if there are any.
    """
    entries = sorted(entries)
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...], int]] = []  # final, arcs (byte, state), words below

    def freeze(final: bool, arcs: list[tuple[int, int]]) -> int:
        key = (final, *arcs)
        if key not in register:
            register[key] = len(states)
            states.append((final, tuple(arcs), final + sum(states[t][2] for _, t in arcs)))
        return register[key]

    path: list[list] = [[False, []]]  # states of the last word's prefixes that may still change
    last = b""

    def close(keep: int) -> None:
        while len(path) > keep + 1:
            final, arcs = path.pop()
            path[-1][1].append((last[len(path) - 1], freeze(final, arcs)))

    for word, _ in entries:
        shared = next((i for i, (a, b) in enumerate(zip(word, last)) if a != b), min(len(word), len(last)))
        close(shared)
        path.extend([False, []] for _ in word[shared:])
        path[-1][0] = True
        last = word
    close(0)
    root = freeze(*path[0])

    # The rank of a word: words that end on its prefixes, and words below smaller arcs on the way.
    keys, targets, adds = [], [], []
    for at, (final, arcs, _) in enumerate(states):
        below = itertools.accumulate((states[t][2] for _, t in arcs), initial=int(final))
        for (byte, target), before in zip(arcs, below):
            keys.append(at * 256 + byte)
            targets.append(target)
            adds.append(before)
    finals = [int(s[0]) for s in states]
    ends = np.cumsum([0, *(len(ids) for _, ids in entries)])
    if len(states) >= 1 << 23:
        raise ValueError("too many states for 32-bit arc keys")
    parts = [[len(keys), len(states), len(entries), root], keys, targets, adds, finals, ends]
    return np.concatenate([np.asarray(p, np.int32) for p in [*parts, [i for _, ids in entries for i in ids]]])


class Lexicon:
    """Look words up in an array of `build`, many at a time."""

    def __init__(self, data: np.ndarray):
        arcs, states, words, self.root = (int(x) for x in data[:HEADER])
        sizes = np.cumsum([HEADER, arcs, arcs, arcs, states, words + 1])
        self.keys, self.targets, self.adds, self.finals, self.ends = (data[a:b] for a, b in zip(sizes, sizes[1:]))
        self.ids = data[sizes[-1] :]
        self.words = words

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """Rank of each word, -1 where it is not in the lexicon. All words step through the automaton at once."""
        sizes = np.array([len(w) for w in words], np.int64)
        starts = np.cumsum(sizes) - sizes
        text = np.frombuffer(b"".join(words), np.uint8)
        state, rank = np.full(len(words), self.root, np.int64), np.zeros(len(words), np.int64)
        live, depth = np.arange(len(words)), 0
        out = np.full(len(words), -1, np.int64)
        while len(live) and len(self.keys):
            over = sizes[live] == depth
            ended = live[over]
            good = ended[self.finals[state[ended]] == 1]
            out[good] = rank[good]
            live = live[~over]
            wanted = state[live] * 256 + text[starts[live] + depth]
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            found = self.keys[at] == wanted
            live, at = live[found], at[found]
            rank[live] += self.adds[at]
            state[live] = self.targets[at]
            depth += 1
        return out

    def ids_of(self, rank: int) -> bytes:
        return self.ids[self.ends[rank] : self.ends[rank + 1]].tobytes()


class WordBPE:
    """The vocabulary's own rules: normalise, cut into words, merge the bytes of a word."""

    # Characters whose lower case, class and composition are the same in every Unicode version. Other texts
    # are normalised and cut by the tokenizers library.
    ODD = re.compile(r"[^\t\n\r\x20-\x7e¡-¬®-ɏ]")

    def __init__(self, path: str):
        import regex
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        self.special = {x["content"]: x["id"] for x in model["added_tokens"]}
        self.token = {at: t for t, at in (model["model"]["vocab"] | self.special).items()}
        pattern = model["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern)
        library = Tokenizer.from_file(path)
        self.normalizer, self.model = library.normalizer, library.model
        self.splitter = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = (b for b in range(256) if b not in plain)
        self.char = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(other)}

    def plain(self, text: str) -> bool:
        return "<|" not in text and not self.ODD.search(text)

    def pieces(self, chunk: str) -> str | list[str]:
        """The words of a piece of plain text without white space; the word itself if it is one of letters."""
        low = chunk.lower()
        if low.isalpha():
            return low
        if low[-1:] in MARKS and low[:-1].isalpha():
            return [low[:-1], low[-1]]
        return self.pattern.findall(low)

    def any_pieces(self, text: str) -> list[str]:
        """The words of any text; special tokens stay whole."""
        out = []
        for part in self.specials.split(text):
            if part in self.special:
                out.append(part)
            elif part:
                out += [x for x, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(part))]
        return out

    def merge(self, word: str) -> bytes:
        """Ids of a word as 32-bit integers: its bytes, merged by the vocabulary's own merge table."""
        if word in self.special:
            return array("i", [self.special[word]]).tobytes()
        # The bytes of ASCII letters stand for themselves.
        spelt = word if word.isascii() and word.isalpha() else "".join(map(self.char.__getitem__, word.encode()))
        return array("i", [t.id for t in self.model.tokenize(spelt)]).tobytes()


class Codec:
    """Encode texts through the lexicon, merging the words that it lacks; decode ids."""

    def __init__(self, path: str, lexicon: np.ndarray):
        self.bpe, self.lexicon = WordBPE(path), Lexicon(lexicon)
        # The ids of a word or chunk, and what they decode to. A chunk that is one word has that word's.
        self.known: Memo = Memo(self.bpe.merge, "lexicon")
        self.said: Memo = Memo(lambda word: self.decode(self.known[word]), "lexicon")

    def look_up(self, words: list[str]) -> None:
        """Take the ids of new words from the automaton; the rest is merged when it is needed."""
        words = [w for w in words if w not in self.known and w not in self.bpe.special]
        ranks = self.lexicon.ranks([w.encode() for w in words])
        for k in np.flatnonzero(ranks >= 0).tolist():
            self.known[words[k]] = self.lexicon.ids_of(ranks[k])

    def learn(self, chunks: list[str], words: list[str]) -> None:
        """Put chunks of plain text, and words, into the memos; those that the worker has not met go through the automaton together."""
        ids, said = self.known, self.said
        single, others = {}, []
        for chunk in chunks:
            if chunk not in ids:
                some = self.bpe.pieces(chunk)
                if type(some) is str:
                    single[chunk] = some
                else:
                    others.append((chunk, some))
        self.look_up(list({w for _, some in others for w in some}.union(words, single.values())))
        for chunk, word in single.items():
            ids[chunk], said[chunk] = ids[word], said[word]
        for chunk, some in others:
            ids[chunk] = b"".join([ids[w] for w in some])
            said[chunk] = " ".join([said[w] for w in some])

    def gathered(self, parts: pa.ListArray, plain: bool) -> tuple[pa.ListArray, pa.Array]:
        """The ids of each list of chunks or words, and the text they stand for. Each different one is looked up once."""
        each = parts.flatten().dictionary_encode()
        names = each.dictionary.to_pylist()
        self.learn(*((names, []) if plain else ([], names)))
        known = list(map(self.known.__getitem__, names))
        ends = np.cumsum(np.fromiter(map(len, known), np.int64, len(known))) // 4
        ids = pa.array(np.frombuffer(b"".join(known), np.int32))
        found = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int64()), ids).take(each.indices)
        said = pa.array(list(map(self.said.__getitem__, names)), pa.large_string()).take(each.indices)
        bounds = parts.offsets.to_numpy()
        bounds = bounds - bounds[0]
        ends = found.offsets.to_numpy()[bounds]
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), said)
        values = found.values.slice(ends[0], ends[-1] - ends[0])
        return pa.LargeListArray.from_arrays(pa.array(ends - ends[0], pa.int64()), values), pc.binary_join(lists, pa.scalar(" ", pa.large_string()))

    def encode_decode(self, texts: pa.Array) -> tuple[pa.ListArray, pa.Array]:
        """The ids of each text, and the text they stand for. A null text is the empty text."""
        self.known.trim(KNOWN)
        self.said.trim(KNOWN)
        texts = texts.cast(pa.large_string()).fill_null("")
        odd = [not self.bpe.plain(t) for t in texts.to_pylist()]
        rare = np.flatnonzero(odd)
        usual = texts if not len(rare) else texts.filter(pc.invert(pa.array(odd)))
        # White space of plain text is ASCII. A text without words is one empty chunk.
        ids, said = self.gathered(pc.ascii_split_whitespace(pc.ascii_trim_whitespace(usual)), True)
        if not len(rare):
            return ids, said
        words = pa.array([self.bpe.any_pieces(t) for t in texts.take(pa.array(rare)).to_pylist()], pa.list_(pa.large_string()))
        both = zip((ids, said), self.gathered(words, False))
        back = pa.array(np.argsort(np.argsort(odd, kind="stable"), kind="stable"))
        return tuple(pa.concat_arrays(pair).take(back) for pair in both)

    def encode(self, texts: list[str]) -> list[bytes]:
        return [x.values.to_numpy().tobytes() for x in self.encode_decode(pa.array(texts, pa.string()))[0]]

    def decode(self, ids: bytes) -> str:
        """The vocabulary names no decoder: tokens are joined by spaces, as they are."""
        return " ".join(map(self.bpe.token.__getitem__, memoryview(ids).cast("i")))


@lru_cache(2)
def word_bpe(path: str) -> WordBPE:
    return WordBPE(path)


@lru_cache(2)
def codec(path: str, name: str) -> Codec:
    return Codec(path, np.memmap(SparkFiles.get(name), np.int32, "r"))


Memo.kept["lexicon"] = [word_bpe.cache_clear, codec.cache_clear]


def word_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """How often each word occurs in the texts: rows (word, n)."""

    def count(batches):
        def emit():
            words: Counter = Counter()
            bpe = word_bpe(tokenizer)
            for chunk, n in chunks.items():
                some = bpe.pieces(chunk) if chunk.isascii() and "<|" not in chunk or bpe.plain(chunk) else bpe.any_pieces(chunk)
                for w in (some,) if type(some) is str else some:
                    words[w] += n
            chunks.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], names=["word", "n"]
            )

        chunks: Counter = Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for t in strings(batch.slice(at, 256), "text"):
                    chunks.update(t.split())
                if len(chunks) > MEMO_ENTRIES:
                    yield emit()
        yield emit()

    return docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, words: int) -> list[str]:
    """The `words` most frequent words of settled `counts`, ties in order of the word.

    Few different counts occur (n words in all have at most the root of 2n), so the driver finds the smallest count that
    is needed. What has it or more is sorted in ranges, and only the first ranges are taken: a top list of each
    partition would bring that many words of every partition to the driver.
    """
    sizes = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).collect()
    cut, above = 0, 0
    for r in sorted(sizes, key=lambda r: -r["n"]):
        cut, above = r["n"], above + r["words"]
        if above >= words:
            break
    conf, key = counts.sparkSession.conf, "spark.sql.execution.topKSortFallbackThreshold"
    usual = conf.get(key)
    conf.set(key, "0")
    try:
        top = counts.where(F.col("n") >= cut).orderBy(F.desc("n"), "word").limit(words).select("word").collect()
    finally:
        conf.set(key, usual)
    return [r["word"] for r in top]


def publish(spark: SparkSession, data: np.ndarray) -> str:
    """Put an array on the shared folder and hand it to the executors; the name to ask `SparkFiles` for."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"  # a session takes a file name only once
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(f"{work_dir(spark, 'lexicon')}/{name}")
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(data.tobytes()))
    out.close()
    spark.sparkContext.addFile(target.toString())
    return name


def frequent_lexicon(docs: DataFrame, tokenizer: str, words: int = LEXICON_WORDS, rows: int | None = None) -> np.ndarray:
    """The automaton of the most frequent words of all texts, ties in order of the word.

    `rows` counts about that many texts only, where a caller asks for it. The lexicon has no say in any result: words
    that it lacks are merged exactly.
    """
    if rows is not None and (share := rows / max(docs.count(), 1)) < 1:
        docs = docs.sample(share, 7)
    top = most_frequent(settle(word_counts(docs, tokenizer), "words"), words)
    bpe = word_bpe(tokenizer)
    entries = ((w, np.frombuffer(bpe.merge(w), np.int32).tolist()) for w in top)
    return build([(w.encode(), ids) for w, ids in entries if w not in bpe.special])


def encode_decode(docs: DataFrame, tokenizer: str, words: int = LEXICON_WORDS) -> DataFrame:
    """All columns of `docs` but `ids` and `decoded`, and then (ids array<int>, decoded string).

    A null text is the empty text: no ids, empty decoded text. Rows stay apart, also if they repeat. Texts of
    any length are encoded whole; an empty table gives no rows.
    """
    given = [c for c in docs.columns if c not in ("ids", "decoded")]
    name = publish(docs.sparkSession, frequent_lexicon(docs, tokenizer, words))

    def run(batch):
        ids, decoded = codec(tokenizer, name).encode_decode(batch.column("text"))
        yield {c: batch.column(c) for c in given} | {"ids": ids.cast(pa.list_(pa.int32())), "decoded": decoded.cast(pa.string())}

    kept = docs.select(*(F.col(f"`{c}`") for c in given))
    kinds = (f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return mapped(kept, run, ", ".join([*kinds, "ids array<int>", "decoded string"]), rows=256)


def text_bytes(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Where each text starts and ends in the bytes of all, and these bytes."""
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return ends, np.frombuffer(data or b"", np.uint8)


def sha256_of(ends: np.ndarray, data: np.ndarray) -> list[str]:
    """Digests of the stretches of an array, between bounds in bytes."""
    data = memoryview(data).cast("B") if len(data) else b""
    ends = ends.tolist()
    return [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(ends, ends[1:])]


def token_digests(docs: DataFrame, tokenizer: str, words: int = LEXICON_WORDS) -> DataFrame:
    """Per document: (doc_id, n_tokens, ids_sha256, decoded_sha256) of its ids and of the text decoded from them.

    The same rows as `encode_decode`, digested in the same task.
    """
    name = publish(docs.sparkSession, frequent_lexicon(docs, tokenizer, words))

    def run(batch):
        ids, decoded = codec(tokenizer, name).encode_decode(batch.column("text"))
        yield {
            "doc_id": batch.column("doc_id"),
            "n_tokens": pc.list_value_length(ids).cast(pa.int64()),
            "ids_sha256": sha256_of(ids.offsets.to_numpy() * 4, ids.values.to_numpy()),
            "decoded_sha256": sha256_of(*text_bytes(decoded)),
        }

    columns = docs.select(F.col("doc_id").cast("long"), "text")
    return mapped(columns, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", rows=1_024)
