"""Line-first quality rules: judge every line, remove those that fail, reject documents that lose too much text."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import WORD_HASH, changed, gram_hashes, mapped, strings, word_hashes

#: A line of fewer words has to end in a sentence mark, unless it stands before one that does (a heading).
SHORT_LINE = 3
#: Share of a line's word characters that may be symbols; exclamation marks per word; words in capitals.
SYMBOL_SHARE = 0.08
SHOUT_SHARE = 0.5
#: Share of a document's words that may stand in lines that fail.
LOST_SHARE = 0.3

# Symbols, sentence marks, and the phrases of lines that belong to a site rather than to a text.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
END_MARKS = ".!?…。！？:;\"'”’»)]"
NAVIGATION = re.compile(r"(?:^|\s)(?:home|login|log in|sign in|sign up|menu|next|previous|back to top|site ?map|contact us|share this|read more|skip to content)(?:$|\s)", re.I)
SEPARATORS = re.compile(r"\s[|>»·•/]\s")
BOILERPLATE = re.compile(
    r"all rights reserved|terms of (?:use|service)|privacy policy|cookie (?:policy|settings)|we use cookies|"
    r"enable javascript|javascript is disabled|subscribe to our|click here|copyright ©|© \d{4}|lorem ipsum",
    re.I,
)


def line_fails(line: str, words: list[str]) -> bool:
    """Whether a line with words breaks a punctuation, navigation or boilerplate rule."""
    n = len(words)
    chars = sum(map(len, words))
    symbols = sum(map(line.count, SYMBOLS))
    if symbols > SYMBOL_SHARE * chars:
        return True
    if n >= 5 and line.count("!") > SHOUT_SHARE * n:
        return True
    if n < SHORT_LINE and words[-1][-1] not in END_MARKS:
        return True
    if n <= 12 and (len(SEPARATORS.findall(line)) >= 2 or (n <= 4 and NAVIGATION.search(line))):
        return True
    return n <= 40 and bool(BOILERPLATE.search(line))


def counts(text: str) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a text."""
    words = text.encode("utf-8", "surrogatepass").split()
    word_chars = len(text) - sum(map(text.count, SPACES))
    seen: set[str] = set()
    dup_lines = 0
    if "\n" in text:
        for line in text.split("\n"):
            if line.strip(SPACES):
                dup_lines += line in seen
                seen.add(line)
    repeated = 0
    if len(words) > 3:
        grams = gram_hashes(word_hashes(words), 3)
        _, inverse, times = np.unique(grams, return_inverse=True, return_counts=True)
        at = np.flatnonzero(times[inverse] > 1)
        covered = np.zeros(len(words), bool)
        for k in range(3):
            covered[at + k] = True
        repeated = int(covered.sum())
    return len(words), word_chars, sum(map(text.count, SYMBOLS)), dup_lines, repeated


def cleaned(text: str) -> tuple[str, int]:
    """The text without the lines that fail, and the number of words in those lines."""
    kept, lost = [], 0
    for line in text.split("\n"):
        words = line.split()
        if words and line_fails(line, words):
            lost += len(words)
        else:
            kept.append(line)
    return "\n".join(kept), lost


def judge(docs: DataFrame, lost_share: float = LOST_SHARE) -> DataFrame:
    """All columns of `docs` (doc_id, text, ...) and then the counts, base_failed, kept, n_lost_words, clean_text.

    Columns of `docs` with one of those names are dropped. A null text is the empty text: no words, base_failed,
    not kept. Rows that repeat are judged alike, each for itself; an empty table gives no rows. Lines of any
    length are judged whole.
    """
    added = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, n_lost_words long, clean_text string"
    names = [x.split()[0] for x in added.split(", ")]
    base = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in names))
    given = base.columns

    def run(batch):
        WORD_HASH.trim()
        rows = []
        for text in strings(batch, "text"):
            found = counts(text)
            failed = found[0] < 50 or 100 * found[4] > 50 * found[0]
            clean, lost = cleaned(text)
            rows.append((*found, failed, not failed and lost <= lost_share * found[0], lost, clean))
        columns = dict(zip(names, zip(*rows))) if rows else {c: [] for c in names}
        yield {c: batch.column(c) for c in given} | columns

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema), added])
    return mapped(base, run, schema)


def keep_good(docs: DataFrame) -> DataFrame:
    """The kept rows with the columns of `docs`; `text` without failed lines, `n_chars` counted anew."""
    good = judge(docs).where("kept").drop("text").withColumnRenamed("clean_text", "text")
    return changed(good.select(*docs.columns), n_chars=F.length("text").cast(docs.schema["n_chars"].dataType))
