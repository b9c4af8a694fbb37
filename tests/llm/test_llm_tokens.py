"""Operators 7 and 8 against the tokenizers library."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from feedloom.llm import lexicon, token_orc
from feedloom.llm.common import Memo
from feedloom.session import work_dir

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = [
    "", "  a   b\n\n c\t", "ΣΑΣ İstanbul é é ﬁ  ", "x<|endoftext|> y<|startoftext|>", "a\x1cb\x85c d", " z 12½ ³",
    "don't WE'LL 's'S", "a" * 500, "ab" * 300 + " " + "é" * 400, "日本語 テスト", "\n \n  x  ", " lead", "trail ",
    "<|endoftext|>", "  <|endoftext|>  q", "😀😀 hi", "the cat, the hat.", "the cat, the hat.",
]


def ids(tokenizer, text):
    return tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("words", [0, 50])
def test_word_codec_equals_library(words):
    library, bpe = Tokenizer.from_file(WORD), lexicon.WordBPE(WORD)
    entries = {w: np.frombuffer(bpe.merge(w), np.int32).tolist() for w in ("the", "cat", "hat", "that", "don", "é")[:words]}
    codec = lexicon.Codec(WORD, lexicon.build([(w.encode(), i) for w, i in entries.items()]))
    for text, data in zip(ODD, codec.encode(ODD)):
        want = ids(library, text)
        assert np.frombuffer(data, np.int32).tolist() == want
        assert codec.decode(data) == library.decode(want, skip_special_tokens=False)


def test_automaton_shares_suffixes_and_ranks_words():
    words = [b"nation", b"station", b"ration", b"rations", b"", b"a"]
    data = lexicon.build([(w, [k, k + 1]) for k, w in enumerate(words)])
    found = lexicon.Lexicon(data)
    ranks = found.ranks([*words, b"natio", b"rationss", b"x"])
    assert list(ranks[-3:]) == [-1, -1, -1]
    assert [np.frombuffer(found.ids_of(r), np.int32).tolist() for r in ranks[:-3]] == [[k, k + 1] for k in range(len(words))]
    assert data[1] < sum(map(len, words)) + 1
    assert list(lexicon.Lexicon(lexicon.build([])).ranks([b"a"])) == [-1]


def test_byte_encoder_equals_library():
    library = Tokenizer.from_file(BYTE)
    for text, data in zip(ODD, token_orc.Encoder(BYTE).encode(ODD)):
        assert np.frombuffer(data, np.int32).tolist() == ids(library, text)


ROWS = [(9, "b b"), (3, None), (5, "x\n\ny  z"), (4, ""), (9, "b b"), (7, "long " * 30_000)]


def test_every_different_word_is_looked_up_once():
    class Counted(Memo):
        looked_up = 0

        def get(self, key, other=None):
            self.looked_up += 1
            return super().get(key, other)

    texts = [" ".join(f"word{k % 7} été{k % 5}," for k in range(300)), None, "a  b", "", "word1", " x ", *ODD, "été3, word2 the end"]
    encoder, plain = token_orc.Encoder(BYTE), Tokenizer.from_file(BYTE)
    encoder.spaced = Counted(encoder.spaced.fn, "chunks")
    ids, counts = encoder.encode_column(pa.array(texts))
    wanted = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(x) for x in wanted]
    assert ids.tolist() == [k for x in wanted for k in x]
    assert encoder.spaced.looked_up < 300
    # A word is held once.
    encoder.encode(["one two three"])
    assert "two" in encoder.spaced and " two" not in encoder.pieces


def test_word_digests(docs):
    library = Tokenizer.from_file(WORD)
    want = []
    for i, t in ROWS:
        x = ids(library, t or "")
        text = library.decode(x, skip_special_tokens=False)
        want.append((i, len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    got = [tuple(r) for r in lexicon.token_digests(docs(ROWS), WORD).collect()]
    assert sorted(got) == sorted(want)
    again = [tuple(r) for r in lexicon.token_digests(docs(ROWS), WORD).collect()]
    assert sorted(again) == sorted(want)
    both = lexicon.encode_decode(docs(ROWS[:2]), WORD).collect()
    assert sorted(len(r.ids) for r in both) == [0, 2] and "lang" in both[0].asDict()


def test_token_files(docs):
    library, want, start = Tokenizer.from_file(BYTE), [], 0
    for i, t in sorted(ROWS, key=lambda r: r[0]):
        x = [*ids(library, t or ""), 0]
        want.append((i, start, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        start += len(x)
    got = [tuple(r) for r in token_orc.token_files(docs(ROWS), BYTE, end_id=0).collect()]
    assert sorted(got) == sorted(want)


def test_token_lookup_skips_stripes(spark, docs):
    path = work_dir(spark, "test-orc")
    token_orc.write_tokens(docs(ROWS), path, BYTE, end_id=0)
    found = token_orc.find_documents(spark, path, [5])
    assert [r.doc_id for r in found.collect()] == [5]
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().toString() or "EqualTo(doc_id" in found._jdf.queryExecution().toString()


def test_empty_tables(docs):
    assert lexicon.token_digests(docs([]), WORD).count() == 0
    assert token_orc.token_files(docs([]), BYTE, end_id=0).count() == 0


def test_files_follow_each_other_by_number(spark):
    """Also past the numbers that sort as text."""
    rows = [(100_000, 7, 0, 0, 2, [5, 6]), (99_999, 3, 0, 0, 1, [4]), (99_999, 5, 1, 1, 1, [9]), (9, 1, 0, 0, 3, [1, 2, 3])]
    table = spark.createDataFrame(rows, "part int, doc_id long, row long, token_offset long, n_tokens long, ids array<int>")
    got = {r.doc_id: r.start for r in token_orc.token_digests(table).collect()}
    assert got == {1: 0, 3: 3, 5: 4, 7: 5}
