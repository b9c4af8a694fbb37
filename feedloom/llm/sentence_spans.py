"""Substring de-duplication on runs of consecutive sentences: of equal runs anywhere, only the first one stays."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import WORD_HASH, changed, long_of, mapped, mix, settle, strings
from feedloom.llm.near_join import keyed

#: A run has at least so many sentences and words. A single sentence of `LONG_SENTENCE` words counts as a run.
SENTENCES = 2
RUN_WORDS = 20
LONG_SENTENCE = 40
#: Sentences with more words are cut behind commas as well.
CLAUSE_WORDS = 30

_END = re.compile(r"[.!?…]+[\"'”’»)\]]*\s+|\n\s*")
_COMMA = re.compile(r"[,;:]\s+")


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of the sentences with the white space behind them; together they are the whole text."""
    out, start = [], 0
    for end in [*(m.end() for m in _END.finditer(text)), len(text)]:
        if end > start:
            cuts = [end]
            if end - start > 2 * CLAUSE_WORDS and len(text[start:end].split()) > CLAUSE_WORDS:
                cuts = [*(m.end() for m in _COMMA.finditer(text, start, end) if m.end() < end), end]
            for cut in cuts:
                out.append((start, cut))
                start = cut
    return out


def runs(text: str, parts: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first sentence and end sentence of the shortest long-enough runs from each sentence and up to each.

    Together they cover every run that is long enough: up to the last sentence from which the run's end is far enough,
    the run from a sentence ends inside it, and the run up to its end has the rest. A run that holds a long-enough run
    is long enough itself. Words are compared in lower case; white space does not count.
    """
    words = [text[a:b].lower().encode("utf-8", "surrogatepass").split() for a, b in parts]
    sizes = np.array([len(w) for w in words], np.int64)
    # A polynomial prefix hash gives the hash of any run of words in one step.
    # Hashed each time: a memo of words takes as long and leaves a worker's memory in pieces.
    listed = [w for some in words for w in some]
    flat = mix(np.fromiter(map(xxhash.xxh3_64_intdigest, listed), np.uint64, len(listed)))
    total = np.concatenate([[0], np.cumsum(sizes)])
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(len(flat) + 1, 0x9E3779B97F4A7C15, np.uint64))
        prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(flat * power[:-1], dtype=np.uint64)]) if len(flat) else np.zeros(1, np.uint64)
        n = len(parts)
        last = shortest_ends(sizes)
        start = n - shortest_ends(sizes[::-1])[::-1]
        from_each, up_to_each = np.flatnonzero(last <= n), np.flatnonzero(start >= 0)
        # Both lists as one of numbers, without repeats.
        both = np.concatenate([from_each * (n + 1) + last[from_each], start[up_to_each] * (n + 1) + up_to_each + 1])
        first, end = np.divmod(np.unique(both), n + 1)
        a, b = total[first], total[end]
        # Bring the run's terms to the same power before comparing: multiply by the inverse of power[a].
        span = (prefix[b] - prefix[a]) * inverse_powers(len(flat) + 1)[a]
        return mix(span ^ mix((b - a).astype(np.uint64))), first, end


def shortest_ends(sizes: np.ndarray) -> np.ndarray:
    """End of the shortest long-enough run from each sentence with words; one more than there are sentences if none is."""
    n = len(sizes)
    total = np.concatenate([[0], np.cumsum(sizes)])
    first = np.arange(n)
    filled = np.flatnonzero(sizes)
    if not len(filled):
        return np.full(n, n + 1)
    # The first sentence end that completes the words; then at least SENTENCES sentences with words.
    by_words = np.searchsorted(total, total[:-1] + RUN_WORDS, side="left")
    at = np.searchsorted(filled, first) + SENTENCES - 1
    by_count = np.where(at < len(filled), filled[np.minimum(at, len(filled) - 1)] + 1, n + 1)
    end = np.where(sizes >= LONG_SENTENCE, first + 1, np.maximum(by_words, by_count))
    return np.where(sizes > 0, end, n + 1)


_INVERSES = np.ones(1, np.uint64)


def inverse_powers(n: int) -> np.ndarray:
    """Inverses of the powers of the hash base modulo 2^64, starting with that of the first power."""
    global _INVERSES
    if len(_INVERSES) < n:
        inverse = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
        _INVERSES = np.cumprod(np.full(max(n, 65_536), inverse, np.uint64))
    return _INVERSES


def without_repeats(text: str, repeated: set[int]) -> tuple[str, int, list[tuple[int, int]]]:
    """The text without sentences that a repeated run covers, their number, and the removed character spans."""
    parts = sentences(text)
    hashes, first, end = runs(text, parts)
    covered = np.zeros(len(parts), bool)
    seen: set[int] = set()
    for h, a, b in zip(long_of(hashes).tolist(), first, end):
        if h in seen or h in repeated:
            covered[a:b] = True
        seen.add(h)
    spans: list[tuple[int, int]] = []
    for k in np.flatnonzero(covered):
        a, b = parts[k]
        spans = [*spans[:-1], (spans[-1][0], b)] if spans and spans[-1][1] == a else [*spans, (a, b)]
    kept = "".join(text[a:b] for (a, b), gone in zip(parts, covered) if not gone)
    return (kept.rstrip() if spans else text), int(covered.sum()), spans


def drop_repeats(docs: DataFrame) -> DataFrame:
    """All columns of `docs` (doc_id, text, ...) with the new `text`, and then (n_removed long, removed array).

    Every run of several sentences that occurred before, in an earlier document by doc_id or earlier in the same
    text, is removed; `removed` has the character spans in the old text. A null text stays null. Rows that share a
    doc_id count as one document and keep what they share; rows without doc_id are ordered by a hash of
    their text. An empty table gives no rows. Only a text's own runs are gathered in one place.
    """
    def span_keys(batch):
        WORD_HASH.trim(0)
        keys, found, again = [], [], []
        for key, text in zip(batch.column("_key").to_pylist(), strings(batch, "text")):
            hashes = runs(text, sentences(text))[0]
            different = np.unique(hashes)
            keys.append(np.full(len(different), key, np.int64))
            found.append(long_of(different))
            if len(different) < len(hashes):
                again.append(key)
        if keys:
            # A row without a span marks a text that repeats itself.
            spans = pa.concat_arrays([pa.array(np.concatenate(found)), pa.nulls(len(again), pa.int64())])
            yield {"_key": np.concatenate([*keys, np.array(again, np.int64)]), "span": spans}

    spans = settle(mapped(keyed(docs).select("_key", "text"), span_keys, "_key long, span long"), "spans")
    within = spans.where("span IS NULL")
    spans = spans.where("span IS NOT NULL")
    repeated = spans.groupBy("span").agg(F.min("_key").alias("first"), F.max("_key").alias("last")).where("first <> last")
    again = (
        spans.join(repeated.select("span", "first"), "span")
        .where("_key <> first")
        .select("_key", "span")
        .unionByName(within)
        .groupBy(F.col("_key").alias("__key"))
        .agg(F.collect_set("span").alias("__spans"))
    )
    # The same join at every size: what repeats grows with the corpus and is never broadcast.
    names = [c for c in docs.columns if c not in ("n_removed", "removed")]
    key = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))
    joined = docs.select(*(F.col(f"`{c}`") for c in names), key.alias("__key")).join(again.hint("merge"), "__key", "left").drop("__key")

    def clean(batch):
        WORD_HASH.trim(0)
        # A text that neither repeats itself nor another one is passed on as it is.
        some = batch.column("__spans").is_valid()
        at = np.flatnonzero(some.to_numpy(zero_copy_only=False))
        n_removed, removed, texts = np.zeros(batch.num_rows, np.int64), [[]] * batch.num_rows, batch.column("text")
        if len(at):
            part = batch.take(pa.array(at))
            texts = texts.to_pylist()
            for k, text, spans in zip(at, part.column("text").to_pylist(), part.column("__spans").to_pylist()):
                if text is not None:
                    texts[k], n_removed[k], cut = without_repeats(text, set(spans))
                    removed[k] = [{"from": a, "to": b} for a, b in cut]
        yield {c: batch.column(c) for c in names} | {"text": texts, "n_removed": n_removed, "removed": removed}

    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names]
    return mapped(joined, clean, ", ".join([*kinds, "n_removed long", "removed array<struct<`from`: long, `to`: long>>"]))


def keep_first(docs: DataFrame) -> DataFrame:
    """`docs` with repeats removed and `n_chars` counted anew; texts of which nothing is left go."""
    out = drop_repeats(docs).where("n_removed = 0 or trim(text) <> ''").select(*(F.col(f"`{c}`") for c in docs.columns))
    return changed(out, n_chars=F.length("text").cast(docs.schema["n_chars"].dataType))
