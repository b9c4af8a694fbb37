"""Operators 3, 4, 5, 6, 9, 10 and the pipeline against brute force."""

import os
import random
import re
import time
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from tests.check import TESTDATA

from feedloom.llm import fm_quality, line_rules, lm_score, near_join, sentence_spans, tiling
from feedloom.llm.common import WORD_HASH, components
from feedloom.session import shared_dir

SF = os.path.join(TESTDATA, "sf0.001")


def words(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(n)]


def sentences(n, seed):
    out = words(n, seed)
    return " ".join(w + ("." if k % 9 == 8 else "") for k, w in enumerate(out)) + "."


def edited(text, seed, share=0.02):
    rng = random.Random(seed)
    return " ".join("zz" + w if rng.random() < share else w for w in text.split())


BASE = sentences(200, 1)
NEAR = [
    (1, BASE), (2, BASE), (3, edited(BASE, 3, 0.01)), (4, edited(BASE, 4, 0.01)), (5, sentences(150, 5)), (6, None), (7, ""),
    (8, "one two"), (9, "One  two"), (10, "one two three"), (11, " \n "), (None, BASE.upper()), (12, sentences(300, 12)),
    (13, edited(sentences(300, 12), 13, 0.005)), (13, edited(sentences(300, 12), 13, 0.005)), (14, sentences(20_000, 14)),
    *((100 + k, edited(sentences(120, 100), k, 0.008)) for k in range(30)),
]


def gram_set(text):
    w = (text or "").lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute_classes(rows):
    sets = [gram_set(t) for _, t in rows]
    n, parent = len(rows), list(range(len(rows)))
    links, texts = [0] * n, [set() for _ in range(n)]

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a in range(n):
        for b in range(n):
            if a != b and sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                if sets[a] != sets[b]:
                    texts[a].add(frozenset(sets[b]))
                parent[root(a)] = root(b)
    named = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        named[root(k)].append(i)
    low = {r: min((i for i in ids if i is not None), default=None) for r, ids in named.items()}
    return [(i, low[root(k)], links[k], len(texts[k])) for k, (i, _) in enumerate(rows)]


@pytest.mark.parametrize("block", [1_024, 7])
def test_near_classes(docs, monkeypatch, block):
    monkeypatch.setattr(near_join, "BLOCK_TEXTS", block)
    got = near_join.near_classes(docs(NEAR)).collect()
    assert sorted(map(str, [(r.doc_id, r.class_id, r.n_links, r.n_text_links) for r in got])) == sorted(map(str, brute_classes(NEAR)))


@pytest.mark.parametrize("block", [40, 150])
def test_near_classes_with_empty_blocks(docs, monkeypatch, block):
    monkeypatch.setattr(near_join, "BLOCK_GRAMS", block)  # more blocks than texts in every group
    got = near_join.near_classes(docs(NEAR)).collect()
    assert sorted(map(str, brute_classes(NEAR))) == sorted(str((r.doc_id, r.class_id, r.n_links, r.n_text_links)) for r in got)


def test_near_keeps_one(docs):
    kept = near_join.keep_one(docs(NEAR))
    assert kept.columns == docs([]).columns
    want = {i for i, low, *_ in brute_classes(NEAR) if i == low}
    assert {r.doc_id for r in kept.collect()} == want
    assert near_join.keep_one(docs([])).count() == 0


def test_bands_reach_recall():
    b, r = near_join.bands_for(0.8)
    assert b * r <= near_join.HASHES and 1 - (1 - 0.8**r) ** b >= near_join.RECALL


def test_components(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 101), (200, 200), (7, 300)]
    got = components(spark.createDataFrame(chain, "a long, b long"), "test")
    want = {**{k: 0 for k in [*range(41), 300]}, 100: 100, 101: 100, 200: 200}
    assert {r.node: r.root for r in got.collect()} == want


PASSAGE = sentences(60, 77)


def test_sentences_tile_the_text():
    for text in ["", "a", "A b. C d!\n\nE f? g", "x" * 9_000, sentences(500, 3), "no end, " * 60]:
        assert "".join(text[a:b] for a, b in sentence_spans.sentences(text)) == text


def test_repeated_passages(docs):
    own = [sentences(60, k) for k in range(3)]
    rows = [
        (3, f"{own[0]}\n{PASSAGE}\n{own[1]}"), (1, f"{PASSAGE}\n{own[2]}"), (2, "Short. Text. Short. Text."), (5, "Short. Text."),
        (6, None), (7, ""), (8, f"{PASSAGE}\n{PASSAGE.upper()}"), (None, own[0]), (9, own[2]), (9, own[2]),
    ]
    got = {(r.doc_id, k): r for k, r in enumerate(sentence_spans.drop_repeats(docs(rows)).collect())}
    by_id = defaultdict(list)
    for (i, _), r in got.items():
        by_id[i].append(r)
    assert by_id[1][0].text == rows[1][1] and by_id[1][0].n_removed == 0
    assert by_id[3][0].text.split() == f"{own[0]} {own[1]}".split()
    assert by_id[8][0].text.strip() == "" and by_id[2][0].text == rows[2][1] and by_id[5][0].text == "Short. Text."
    assert by_id[6][0].text is None and by_id[7][0].text == "" and [r.text.strip() for r in by_id[9]] == ["", ""]
    assert by_id[3][0].removed[0]["from"] == len(own[0]) + 1
    kept = sentence_spans.keep_first(docs(rows))
    assert {r.doc_id for r in kept.collect()} >= {1, 2, 3, 5} and kept.columns == docs([]).columns
    assert sentence_spans.drop_repeats(docs([])).count() == 0


def uneven(sizes, seed):
    """Sentences of the given numbers of words."""
    rng = random.Random(seed)
    return [" ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(n)) + ". " for n in sizes]


def brute_spans(rows):
    """Per text the sentences in a long-enough run that occurred in an earlier document or earlier in the text."""
    seen, out = set(), {}
    for i, text in rows:
        parts = [tuple(text[a:b].lower().split()) for a, b in sentence_spans.sentences(text)]
        own, gone = set(), set()
        for a in range(len(parts)):
            for b in range(a + 1, len(parts) + 1):
                run = sum(parts[a:b], ())
                long = len(run) >= 20 and sum(map(bool, parts[a:b])) >= 2 or any(len(p) >= 40 for p in parts[a:b])
                if long and (run in seen or run in own):
                    gone |= set(range(a, b))
                if long:
                    own.add(run)
        seen |= own
        out[i] = len(gone)
    return out


def test_runs_equal_all_sentence_runs(docs):
    rng = random.Random(8)
    rows = []
    for n, sizes in enumerate([(39, 3, 3, 3, 3), (45, 10), (10, 45), (8, 8, 8), (3, 3, 3, 3, 39), (9, 9), (41,), (45, 2, 3, 50, 1, 1)]):
        passage = "".join(uneven(sizes, 50 + n))
        rows += [(2 * n + 1, passage + "".join(uneven((7, 12), 90 + n))), (2 * n + 2, "".join(uneven((6,), 70 + n)) + passage + "".join(uneven((5, 30), 80 + n)))]
    pool = [uneven([rng.choice((1, 2, 5, 9, 19, 25, 39, 40, 44))], 1_000 + k)[0] for k in range(40)]
    for k in range(40):
        at = [rng.randrange(40) for _ in range(3)]
        rows.append((100 + k, "".join(s for a in at for s in pool[a : a + rng.randint(1, 6)])))
    got = {r.doc_id: r.n_removed for r in sentence_spans.drop_repeats(docs(rows)).collect()}
    assert got == brute_spans(rows) and [got[2 * n + 2] for n in range(8)] == [5, 2, 2, 3, 5, 0, 1, 6]


def brute_counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    covered = {k + j for k in range(len(w) - 2) for j in range(3) if seen[tuple(w[k : k + 3])] > 1}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


RULES = [
    (1, sentences(80, 1)), (2, "Home | About | Login | Contact\n" + sentences(80, 2)), (3, sentences(30, 3)), (4, None), (5, ""),
    (6, "a b c " * 60), (7, "\n".join([sentences(60, 7)] * 2)), (8, " ".join(w + "%%%" for w in words(80, 8)) + "\n" + sentences(40, 8)),
    (9, "é ü x \x0b\x0c#|<\x1c \r\n\r\n" * 5), (9, "x " * 10), (10, sentences(30_000, 10)), (None, "we use cookies here"),
]


def test_rule_counts_and_verdicts(docs):
    got = line_rules.judge(docs(RULES)).collect()
    want = []
    for i, t in RULES:
        counts = brute_counts(t or "")
        want.append((i, *counts, counts[0] < 50 or 100 * counts[4] > 50 * counts[0]))
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted(map(str, want)) == sorted(str(tuple(r[c] for c in names)) for r in got)
    kept = {r.doc_id for r in got if r.kept}
    assert kept == {1, 2, 10}
    clean = {r.doc_id: r.text for r in line_rules.keep_good(docs(RULES)).collect()}
    assert clean[1] == RULES[0][1] and not clean[2].startswith("Home")
    assert line_rules.judge(docs([])).count() == 0


def test_tiling_finds_reordered_items(spark, docs):
    item = words(40, 5)
    moved = item[20:] + words(15, 6) + item[:20]
    rows = [
        (1, " ".join(words(30, 1) + item + words(30, 2))), (2, " ".join(moved).upper() + "!"), (3, " ".join(words(90, 3))), (4, None),
        (5, ""), (6, " ".join(item[:12])), (7, "what is it"), (None, " ".join(item)), (1, " ".join(item)), (8, " ".join(words(9_000, 9) + item)),
    ]
    bench = spark.createDataFrame([(1, " ".join(item), 0), (2, None, 0), (3, "", 0), (4, "what is it", 0)], "item_id long, text string, doc_id int")
    got = [(r.doc_id, r.item_id, r.n_covered, r.n_tiles) for r in tiling.leaks(docs(rows), bench).collect()]
    want = [(1, 1, 40, 1), (1, 1, 40, 1), (2, 1, 40, 2), (None, 1, 40, 1), (7, 4, 3, 1), (8, 1, 40, 1)]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert {r.doc_id for r in tiling.keep_clean(docs(rows), bench).collect()} == {3, 4, 5, 6}
    assert tiling.leaks(docs([]), bench).count() == 0 and tiling.leaks(docs(rows), bench.limit(0)).count() == 0


def brute_tiles(doc, item, shortest):
    out, fd, fi = [], [True] * len(doc), [True] * len(item)
    while True:
        best = (shortest - 1, 0, 0)
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while i + n < len(item) and d + n < len(doc) and fi[i + n] and fd[d + n] and item[i + n] == doc[d + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, d)
        n, i, d = best
        if n < shortest:
            return out
        out.append(best)
        for k in range(n):
            fi[i + k] = fd[d + k] = False


def test_tiles_equal_greedy_tiling():
    rng = np.random.default_rng(3)
    for _ in range(60):
        doc, item = (rng.integers(1, 4, n).astype(np.uint64) for n in rng.integers(0, 40, 2))
        want = brute_tiles(doc.tolist(), item.tolist(), min(3, max(1, len(item))))
        assert tiling.tiles(doc, item, 3) == want


def test_tiles_of_repetitive_words():
    same = lambda n: np.full(n, 7, np.uint64)
    began = time.monotonic()
    assert tiling.tiles(same(5_000), same(1_000)) == [(1_000, 0, 0)]
    assert tiling.tiles(same(40), same(100)) == [(40, 0, 0)]
    turn = np.arange(1, 8, dtype=np.uint64)
    assert tiling.tiles(np.tile(turn, 20_000), np.tile(turn, 300)) == [(2_100, 0, 0)]
    assert time.monotonic() - began < 5


def test_leaks_equal_tiling_of_all_pairs(spark):
    """Few words, so that seeds repeat inside texts and over items; odd ids; repeated rows."""
    rng = np.random.default_rng(11)
    draw = lambda n: " ".join("abcd"[k] for k in rng.integers(0, 4, n))
    items = [(f"i{k}", draw(n)) for k, n in enumerate([3, 5, 9, 14, 20, 20, 31, 60])] + [(None, "a a a a a a a a"), ("z", "...")]
    items.append(items[4])
    docs = [(f"d{k}", draw(int(n))) for k, n in enumerate(rng.integers(0, 90, 40))] + [(None, "A, a a. " * 9), ("x", None)]
    docs += [docs[0], ("y", " ".join(t or "" for _, t in items))]
    for coverage in (0.5, 0.9):
        want = []
        for d, t in docs:
            for i, x in items:
                doc, item = tiling.tokens(t or ""), tiling.tokens(x)
                found = brute_tiles(doc.tolist(), item.tolist(), min(5, len(item))) if len(item) else []
                covered = sum(n for n, _, _ in found)
                if found and covered >= coverage * len(item):
                    want.append((d, i, len(item), covered, len(found)))
        leaks = tiling.leaks(
            spark.createDataFrame(docs, "doc_id string, text string"),
            spark.createDataFrame(items, "item_id string, text string"), coverage,
        )
        assert sorted(map(str, (tuple(r)[:5] for r in leaks.collect()))) == sorted(map(str, want))


def test_keep_clean_with_clashing_columns(spark):
    item = " ".join(words(30, 5))
    rows = [("a", item, 1, 2, 3), (None, item, 1, 2, 3), ("b", "fine", 1, 2, 3), (None, "fine too", 1, 2, 3), ("c", None, 1, 2, 3)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, key int, `__key` int, row int")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted(map(str, map(tuple, tiling.keep_clean(docs, bench).collect()))) == sorted(map(str, rows[2:]))


def test_runs_leave_no_words_in_a_worker():
    WORD_HASH.clear()
    text = " ".join(words(50_000, 7)) + "."
    assert len(sentence_spans.runs(text, sentence_spans.sentences(text))[0]) == 1
    assert not WORD_HASH


def test_losses_and_matched_models(spark, docs):
    good, bad = [sentences(60, 20 + k % 3) for k in range(6)], ["%% ## 12 " * 30] * 4
    rows = [*enumerate(good + bad), (50, None), (51, ""), (None, good[0]), (3, good[3])]
    target = spark.createDataFrame([(k,) for k in (0, 1, 2, 2)], "doc_id long")
    got = lm_score.cross_entropy(docs(rows), target, words=20).collect()
    assert len(got) == len(rows)
    top = sorted(Counter(w for _, t in rows for w in (t or "").lower().split()).items(), key=lambda x: (-x[1], x[0]))[:20]
    known = {w: lm_score.START + 1 + k for k, (w, _) in enumerate(top)}
    entry = lambda w: known.get(w, lm_score.shape(w))
    size = lm_score.START + 21
    seqs = [(i, [lm_score.START, *map(entry, (t or "").lower().split())]) for i, t in rows]
    loss = {}
    for name, some in (("background_loss", [s for _, s in seqs]), ("target_loss", [s for i, s in seqs if i in (0, 1, 2)])):
        pair = Counter(p for s in some for p in zip(s, s[1:]))
        second, first = Counter(), Counter()
        for (a, b), n in pair.items():
            first[a] += n
            second[b] += n
        total = sum(second.values()) + size

        def bits(a, b, pair=pair, first=first, second=second, total=total):
            weight = lm_score.BIGRAM_WEIGHT if first[a] else 0.0
            return -np.log2(weight * pair[a, b] / max(first[a], 1) + (1 - weight) * (second[b] + 1) / total)

        for i, s in seqs:
            loss[i, name, len(s)] = sum(bits(a, b) for a, b in zip(s, s[1:])) / max(len(s) - 1, 1)
    for r in got:
        for name in ("target_loss", "background_loss"):
            assert r[name] == pytest.approx(loss[r.doc_id, name, r.n_words + 1], abs=1e-3)
        assert r.difference == pytest.approx(r.target_loss - r.background_loss)
    assert lm_score.cross_entropy(docs([]), target).count() == 0


@pytest.mark.parametrize("chunk", [1, 700, 1_000_000])
def test_losses_know_every_word(spark, docs, monkeypatch, chunk):
    monkeypatch.setattr(lm_score, "CHUNK_WORDS", chunk)
    monkeypatch.setattr(lm_score, "BUCKET_BYTES", 3_000)
    common = [f"c{k:05d}" for k in range(1_200)]  # more frequent than any topic word
    rng = random.Random(4)
    topic = lambda name, k: " ".join(rng.choice(common) if j % 2 else f"{name}{(7 * k + j) % 90:05d}" for j in range(400))
    rows = [(k, topic("a" if k < 12 else "b", k)) for k in range(24)] + [(30, " ".join(common * 3)), (31, None), (32, ""), (32, "One"), (None, "one")]
    target = spark.createDataFrame([(k,) for k in range(8)], "doc_id long")
    got = {(r.doc_id, r.n_words): r for r in lm_score.cross_entropy(docs(rows), target).collect()}
    assert len(got) == len(rows)
    seqs = [(i, ["", *(t or "").lower().split()]) for i, t in rows]
    size = len({w for _, s in seqs for w in s})
    for name, some in (("target_loss", [s for i, s in seqs if i in range(8)]), ("background_loss", [s for _, s in seqs])):
        pair = Counter(p for s in some for p in zip(s, s[1:]))
        first, second = Counter(), Counter()
        for (a, b), n in pair.items():
            first[a] += n
            second[b] += n
        for i, s in seqs:
            bits = 0
            for a, b in zip(s, s[1:]):
                weight = lm_score.BIGRAM_WEIGHT if first[a] else 0.0
                bits -= np.log2(weight * pair[a, b] / max(first[a], 1) + (1 - weight) * (second[b] + 1) / (sum(second.values()) + size))
            assert got[i, len(s) - 1][name] == pytest.approx(bits / max(len(s) - 1, 1))
    held_out, other = ([got[k, 400].difference for k in some] for some in (range(8, 12), range(12, 24)))
    assert max(held_out) < min(other)


def test_losses_keep_chunks_packed(spark, docs):
    texts = [" ".join(words(3_000, k)) for k in range(40)]
    top = os.path.join(shared_dir(spark), "feedloom")
    seen = set(os.listdir(top)) if os.path.isdir(top) else set()
    got = lm_score.cross_entropy(docs([*enumerate(texts)]), spark.range(20).withColumnRenamed("id", "doc_id"))
    assert got.count() == len(texts)
    kept = [os.path.join(top, d) for d in os.listdir(top) if d.startswith("language-") and d not in seen]
    size = sum(os.path.getsize(os.path.join(d, f)) for d in kept for f in os.listdir(d) if f.endswith(".parquet"))
    # Hashes of all bigrams of a chunk alone are larger than its texts.
    assert 0 < size < sum(map(len, texts))


def test_factors_in_linear_time():
    rng = np.random.default_rng(1)
    model = fm_quality.Model(0.3, rng.normal(size=fm_quality.WIDTH), rng.normal(size=(fm_quality.WIDTH, 4)))
    parts = [(np.array([3, 70, 9]), np.array([0.5, 1.0, 2.0])), (np.array([4]), np.array([1.0]))]
    got = model.raw(*fm_quality.joined(parts), 2)[0]
    for k, (i, v) in enumerate(parts):
        pairs = sum(model.factors[a] @ model.factors[b] * x * y for n, (a, x) in enumerate(zip(i, v)) for b, y in list(zip(i, v))[n + 1 :])
        assert got[k] == pytest.approx(0.3 + model.weights[i] @ v + pairs)


def test_quality_scores(spark, docs):
    rows = [(k, sentences(80, k) if k % 3 else " ".join(w + "%%%" for w in words(60, k))) for k in range(120)]
    rows += [(200, None), (201, ""), (None, "x"), (202, "w " * 50_000), (1, rows[1][1])]
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(120)] + [(5, None, 0)], "doc_id long, quality int, toxic int")
    got = fm_quality.score_documents(docs(rows), labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 120]
    assert len(held) > 10 and all(r.predicted == int(r.doc_id % 3 > 0) for r in held)
    assert fm_quality.score_documents(docs([]), labels).count() == 0
    assert fm_quality.score_documents(docs(rows[:3]), labels.limit(0)).count() == 3


def test_quality_held_out_accuracy(spark):
    folder = os.path.join(TESTDATA, "sf0.01")
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    read = lambda t: spark.read.parquet(f"{folder}/{t}.parquet")
    known = {r.doc_id: r.quality for r in read("labels").collect()}
    held = [r for r in fm_quality.score_documents(read("documents"), read("labels")).collect() if r.held_out and r.doc_id in known]
    assert sum(r.predicted == known[r.doc_id] for r in held) >= 0.9 * len(held)


def test_pipeline(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    read = lambda t: spark.read.parquet(f"{SF}/{t}.parquet")
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, SF).collect()}
    rows = {r.doc_id: r.text or "" for r in read("documents").collect()}
    kept = {}
    for i, t in rows.items():
        n, _, _, _, repeated = brute_counts(t)
        clean, lost = line_rules.cleaned(t)
        if n >= 50 and 100 * repeated <= 50 * n and lost <= line_rules.LOST_SHARE * n:
            kept[i] = clean
    one = {i for i, low, *_ in brute_classes(list(kept.items())) if i == low}
    kept = {i: t for i, t in kept.items() if i in one}
    seen, out = {}, {}
    spans = {i: sentence_spans.runs(t, sentence_spans.sentences(t))[0].view(np.int64).tolist() for i, t in kept.items()}
    for i in sorted(kept):
        text, removed, _ = sentence_spans.without_repeats(kept[i], {h for h in spans[i] if seen.get(h, i) != i})
        for h in spans[i]:
            seen.setdefault(h, i)
        if not removed or text.strip():
            out[i] = text
    items = [tiling.tokens(r.text) for r in read("benchmark").collect()]
    clean = {}
    for i, t in out.items():
        doc = tiling.tokens(t)
        if not any(sum(n for n, _, _ in tiling.tiles(doc, item)) >= tiling.COVERAGE * len(item) for item in items):
            clean[i] = t
    from tokenizers import Tokenizer
    import public_tokenizers

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert got == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in clean.items()}
