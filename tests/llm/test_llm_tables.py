"""Operators 11 to 13 against brute force, with odd rows."""

import hashlib
import math
import random
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from feedloom.llm import centroids, mixing, prefix_trie


def nearest(x, cs):
    return min((sum((a - b) ** 2 for a, b in zip(x, c)), i) for i, c in enumerate(cs))


@pytest.mark.parametrize("size", [3, 10**9])
def test_tournament_finds_the_nearest(size):
    rng = random.Random(size)
    cs = [[rng.randint(-size, size) for _ in range(3)] for _ in range(7)]
    cs += [cs[2], cs[0]]
    xs = [[rng.randint(-size, size) for _ in range(3)] for _ in range(500)] + cs
    kind = np.int64 if size == 3 else object
    best, distance = centroids.Tournament(cs).nearest(np.array(xs, kind))
    assert list(zip(distance.tolist(), best.tolist())) == [nearest(x, cs) for x in xs]


def clusters(rows, k, rounds, dims):
    """Brute force over (vec_id, components) pairs."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    xs = [[math.floor(64 * Fraction(x)) for x in v] for _, v in kept]
    first = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v, x) for (i, v), x in zip(kept, xs))
    cs = [x for _, _, x in first[:k]]
    for _ in range(rounds):
        of = defaultdict(list)
        for x in xs:
            of[nearest(x, cs)[1]].append(x)
        cs = [[sum(c) // len(of[n]) for c in zip(*of[n])] if n in of else c for n, c in enumerate(cs)]
    found = [nearest(x, cs) for x in xs]
    sums = defaultdict(int)
    for d, c in found:
        sums[c] += d
    fit = lambda x: x if x < 1 << 63 else None
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return [(i, c, fit(d), fit(sums[c]), fit(sum(sums.values())), name[c]) for (i, _), (d, c) in zip(kept, found)]


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("scale", [1.0, 1e7, 1e30])
def test_clusters_equal_brute_force(spark, scale):
    rng = random.Random(int(scale))
    rows = [(i, [rng.gauss(0, scale) for _ in range(4)]) for i in range(120)]
    rows += [(500 + i, [0.5, 0.5, -0.5, 0.0]) for i in range(40)] + rows[:5]
    rows += [(700, None), (701, []), (702, [1.0] * 3), (703, [1.0] * 5), (704, [1.0, None, 1.0, 1.0]), (705, [1.0, math.nan, 1.0, 1.0])]
    rows += [(706, [1.0, math.inf, 1.0, 1.0]), (707, [1.0, -math.inf, 1.0, 1.0]), (None, [0.1] * 4), (None, [0.2] * 4)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, _hash string, cluster int")
    got = centroids.cluster(df.repartition(5), k=6, dims=4).collect()
    assert in_order(got) == in_order(clusters(rows, 6, 3, 4))


def test_few_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    rows = [(1, [0.25, 1.0]), (1, [0.25, 1.0]), (2, [-0.01, 3.0])]
    got = centroids.cluster(spark.createDataFrame(rows, schema), k=6, dims=2).collect()
    assert in_order(got) == in_order(clusters([(1, [0.25, 1.0])] * 2 + [(2, [float(np.float32(-0.01)), 3.0])], 6, 3, 2))
    assert centroids.cluster(spark.createDataFrame([], schema)).count() == 0
    assert centroids.cluster(spark.createDataFrame([(1, None)], schema)).count() == 0


def test_slots_are_minimal_and_checked():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-(2**63), 2**63 - 1, (2, 50_000))
    table = prefix_trie.SlotTable(a, b)
    assert np.array_equal(np.sort(table.slots(a, b)), np.arange(len(a)))
    assert (table.slots(b, a) == -1).all() and (table.slots(a, b + 1) == -1).all()
    none = np.zeros(0, np.int64)
    assert list(prefix_trie.SlotTable(none, none).slots(a[:2], b[:2])) == [-1, -1]
    with pytest.raises(ValueError):
        prefix_trie.SlotTable(np.zeros(2, np.int64), np.zeros(2, np.int64))


def brute_trie(rows):
    """Nodes of (conv_id, turn, role, text) rows by whole lists of turns."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = turns.get(c - c % 100, [])[:h] + turns[c][h:]
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            kids[path[:-1]] += 1
    for path, cs in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not kids[path]
            saved[path[:d]] += (len(cs) - 1) * (len(path[-1][1]) if path else 0)
    out = []
    for path, cs in members.items():
        ends = ",".join(str(c) for c in cs if len(built[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(cs), len(path), parent, len(cs), kids[path], leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def conversations(spark, rows):
    full = [(*r, "x", 7) for r in rows]
    return spark.createDataFrame(full, "conv_id long, turn long, role string, text string, pos string, _block int")


def nodes(spark, rows, **kw):
    turns, convs = prefix_trie.shared_starts(prefix_trie.turn_rows(conversations(spark, rows)))
    return prefix_trie.trie(turns, convs, **kw)


def some_conversations():
    rng = random.Random(4)
    rows = [(None, 0, "user", "lost")]
    for c in [*range(0, 40), *range(100, 130), *range(205, 230), 10**12, 10**12 + 7]:
        same = rng.random() < 0.5
        for turn in range(rng.choice([0, 1, 1, 2, 3, 5, 9])):
            word = "hi" if same else rng.choice("abc")
            rows.append((c, rng.choice([turn, turn, None]) if not turn else turn, rng.choice(["user", "user", None]), rng.choice([word, None, "é😀 long"])))
    return list(dict.fromkeys(rows))


@pytest.mark.parametrize("shard_nodes", [7, 1 << 18])
def test_trie_equals_brute_force(spark, shard_nodes, monkeypatch):
    """Also with shards, blocks and neighbourhoods so small that sums cross many shards."""
    if shard_nodes == 7:
        monkeypatch.setattr(prefix_trie, "NEAR_IDS", 0)
        monkeypatch.setattr(prefix_trie, "NEAR_DEPTHS", 0)
    rows = some_conversations()
    assert in_order(nodes(spark, rows, shard_nodes=shard_nodes).collect()) == in_order(brute_trie(rows))


def test_one_long_conversation_and_many_equal_ones(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "NEAR_DEPTHS", 4)
    rows = [(0, t, "user", f"t{t % 3}") for t in range(150)] + [(c, t, "user", f"t{t % 3}") for c in range(1, 60) for t in range(40)]
    assert in_order(nodes(spark, rows, shard_nodes=50).collect()) == in_order(brute_trie(rows))


def test_repeated_rows_and_no_rows(spark):
    rows = [(1, 0, "user", "a")] * 3 + [(7, 0, "user", "a"), (7, None, None, None)]
    assert in_order(nodes(spark, rows).collect()) == in_order(brute_trie(rows))
    assert nodes(spark, []).count() == 0
    assert nodes(spark, [(None, 1, "user", "x")]).count() == 0


def test_blocks_of_long_conversations_carry_their_digest(spark):
    n = prefix_trie.BLOCK + 300
    i = spark.range(n)
    turns = i.selectExpr("100L AS conv_id", "id AS turn", "'u' AS role", "cast(id % 5 AS string) AS text").unionByName(
        i.where("id <> 9").selectExpr("200L AS conv_id", "id AS turn", "'u' AS role", "cast(id % 5 AS string) AS text")
    )
    built, convs = prefix_trie.shared_starts(prefix_trie.turn_rows(turns))
    paths = prefix_trie.prefixes(built, convs)
    assert paths.select("a", "b").distinct().count() == paths.select("a", "b", "pos").distinct().count()
    out = {r["depth"]: r for r in prefix_trie.trie(built, convs).where("conv_id = 100").collect()}
    assert len(out) == n + 1 and out[n]["n_leaves"] == 1 and out[0]["n_convs"] == 2


def brute_targets(sizes):
    """Exact targets of (source, size) pairs by the rule, round by round."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        open_ = sum(weight[s] for s in order if s not in capped)
        share = {s: Fraction(3 * sizes[s]) if s in capped else Fraction(rest * weight[s], open_) for s in order}
        above = {s for s in order if s not in capped and share[s] > 3 * sizes[s]}
        if not above:
            return share
        capped |= above


MIXES = {
    "even": {"a": 40, "b": 40, "c": 40, "d": 40},
    "small first": {"a": 2, "b": 1, "c": 300, "é": 7, None: 30, "zz": 1},
    "one": {"a": 9},
    "no words": {"a": 0, "b": 0},
    "one without words": {"a": 0, "b": 12, "c": 5},
}


@pytest.mark.parametrize("name", MIXES)
def test_mix(spark, name):
    rng = random.Random(name)
    rows = []
    for source, n in MIXES[name].items():
        for _ in range(max(n, 1)):
            rows.append((len(rows), source, " \t w\x0b" * rng.randint(0, 9) if n else rng.choice(["", None, "\n "])))
    rows += rows[:3] + [(None, rows[0][1], rows[0][2])] * 2
    full = [(*r, 5, "x") for r in rows]
    df = spark.createDataFrame(full, "doc_id long, source string, text string, size int, _key string")
    sizes = defaultdict(int)
    for _, s, t in rows:
        sizes[s] += len((t or "").split())
    want = brute_targets(sizes) if sum(sizes.values()) else {s: Fraction(0) for s in sizes}
    got = mixing.mix(df.repartition(3), rows_per_range=11).collect()
    assert sorted((str(r["doc_id"]), r["size"]) for r in got) == sorted((str(i), len((t or "").split())) for i, _, t in rows)
    taken = defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(float(want[r["source"]]))
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - math.floor(float(t))) <= 1 for s, t in want.items())
    again = mixing.mix(df.repartition(7), rows_per_range=1_000).collect()
    assert in_order(got) == in_order(again)
    assert mixing.mix(df.limit(0)).count() == 0
