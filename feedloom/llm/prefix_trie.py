"""The trie of conversation prefixes, with counts over subtrees.

A prefix is named by a 128-bit digest of its turns. The distinct digests are the nodes. Nodes are dealt to shards of
bounded size; in a shard a minimal perfect hash gives every node its own slot, checked against the stored digest, and
counts lie in flat numpy arrays by slot. A parent-slot array adds them up in order of depth, deepest first. Nodes whose
parent lies in another shard are the tops of local trees. The sums of local trees are carried over to the trees above by
pointer doubling, so the number of Spark jobs grows with the logarithm of the longest chain of shards.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import mix, settle
from feedloom.operators.keyed import enumerate_positions, key_counts, lookup

#: Turns of a conversation that one task adds up; longer conversations take several tasks.
BLOCK = 1 << 16
#: Nodes that a shard aims at. Nodes of up to 128 neighbouring conversations and 4,096 depths stay together.
SHARD_NODES = 1 << 18
NEAR_IDS, NEAR_DEPTHS = 7, 12
#: The rebuilt conversations: whose start they take, and how many turns at most.
FAMILY, STARTS = 100, 6

EMPTY_SHA = hashlib.sha256(b"").hexdigest()


class SlotTable:
    """A minimal perfect hash of distinct 128-bit digests (a, b): every digest has its own slot below their number.

    Level by level, the digests left are hashed into a bit array, and those alone in their cell stay there; the rank of
    a digest's cell among all used cells is its slot. A lookup compares the digest stored in the slot, so a digest that
    is not in the table, or collides with one, gets -1.
    """

    SPREAD = 1.6

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.levels: list[tuple[np.ndarray, int]] = []
        left, used = np.arange(len(a)), 0
        while len(left):
            if len(self.levels) == 64:
                raise ValueError("digests repeat")
            cells = max(1, int(self.SPREAD * len(left)))
            cell = self.cell(a[left], b[left], len(self.levels), cells)
            alone = np.bincount(cell, minlength=cells) == 1
            self.levels.append((np.where(alone, np.cumsum(alone) - 1 + used, -1), cells))
            used += int(alone.sum())
            left = left[~alone[cell]]
        self.a, self.b = np.zeros(used, np.int64), np.zeros(used, np.int64)
        slot = self.find(a, b)
        self.a[slot], self.b[slot] = a, b

    @staticmethod
    def cell(a: np.ndarray, b: np.ndarray, level: int, cells: int) -> np.ndarray:
        seeded = a.view(np.uint64) ^ mix(b.view(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64))
        return (mix(seeded) % np.uint64(cells)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        slot, open_ = np.full(len(a), -1, np.int64), np.arange(len(a))
        for level, (slots, cells) in enumerate(self.levels):
            here = slots[self.cell(a[open_], b[open_], level, cells)]
            slot[open_] = here
            open_ = open_[here < 0]
        return slot

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        slot = self.find(a, b)
        return np.where((slot >= 0) & (self.a[slot] == a) & (self.b[slot] == b), slot, -1) if len(self.a) else slot


def accumulate(parent: np.ndarray, depth: np.ndarray, *counts: np.ndarray) -> np.ndarray:
    """Add every slot's counts to its parent's, deepest first; the slot of the top of each slot's tree."""
    order = np.argsort(depth, kind="stable")
    starts = np.flatnonzero(np.diff(depth[order], prepend=-1))
    of_depth = [x for x in np.split(order, starts) if len(x)]
    top = np.arange(len(parent))
    for some in reversed(of_depth):
        some = some[parent[some] >= 0]
        for c in counts:
            np.add.at(c, parent[some], c[some])
    for some in of_depth:
        some = some[parent[some] >= 0]
        top[some] = top[parent[some]]
    return top


def turn_rows(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, pos, a, b, chars): the turns of each conversation in order, by digest of role and text.

    Turns are ordered by `turn`, null first; turns that share it by the digest. Null role or text is the empty text.
    Rows without conv_id belong to no conversation. A conversation of any length is spread over many tasks.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.xxhash64(role, text).alias("a"),
        F.xxhash64(F.lit(1), text, role).alias("b"),
        F.length(text).cast("long").alias("chars"),
    )
    return enumerate_positions(rows, ["conv_id"], [F.asc_nulls_first("turn"), "a", "b"], name="pos").drop("turn")


def shared_starts(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt with the start of another one: rows (conv_id, pos, n_turns, a, b, chars), and (conv_id, n_turns).

    Conversation c takes the first crc32(c) % 6 turns of conversation c - c % 100, as far as there are any, and then
    its own turns behind as many of its own.
    """
    start = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % STARTS).cast("int")
    turns = settle(turns, "turns")
    lengths = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_own"))
    turn = F.struct("pos", "a", "b", "chars")
    bases = (
        turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < STARTS))
        .groupBy(F.col("conv_id").alias("_base"))
        .agg(F.sort_array(F.collect_list(turn)).alias("_turns"))
    )
    head = F.slice(F.coalesce("_turns", F.array()), F.lit(1), F.col("_start"))
    convs = settle(
        lengths.withColumn("_base", F.col("conv_id") - F.col("conv_id") % FAMILY)
        .join(bases, "_base", "left")
        .withColumn("_start", start)
        .withColumn("_head", head)
        .withColumn("n_turns", F.size("_head") + F.greatest(F.col("_own") - F.col("_start"), F.lit(0)))
        .select("conv_id", "n_turns", "_own", (F.size("_head") - F.col("_start")).alias("_shift"), "_head"),
        "conversations",
    )
    first = convs.select("conv_id", "n_turns", F.inline("_head")).select("conv_id", "pos", "n_turns", "a", "b", "chars")
    # One row per block of turns, so that no task joins more than a block of one conversation.
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("_own") - 1, 16))).alias("_block")
    own = (
        turns.where(F.col("pos") > start)
        .withColumn("_block", F.shiftright(F.col("pos") - 1, 16))
        .join(convs.select("conv_id", "n_turns", "_shift", blocks), ["conv_id", "_block"])
        .select("conv_id", (F.col("pos") + F.col("_shift")).alias("pos"), "n_turns", "a", "b", "chars")
    )
    return first.unionByName(own), convs.select("conv_id", "n_turns")


def prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Rows (conv_id, pos, n_turns, a, b, pa, pb, turn, chars): the digests of each prefix and of the one before.

    A digest is the exclusive or of its turns' hashes, each mixed with its position. Runs of `BLOCK` turns are added up apart, and
    the blocks of longer conversations start from the blocks before.
    """
    block = F.shiftright(F.col("pos") - 1, 16).alias("_block")
    term = (F.xxhash64("pos", "a", "b"), F.xxhash64(F.lit(2), F.col("b"), F.col("a"), F.col("pos")))
    terms = turns.select("conv_id", "pos", "n_turns", "chars", F.xxhash64("a", "b").alias("turn"), block, term[0].alias("ta"), term[1].alias("tb"))
    long = settle(convs.where(F.col("n_turns") > BLOCK).select("conv_id"), "long")
    along = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    xor = lambda c: F.coalesce(F.bit_xor(c).over(along), F.lit(0).cast("long"))
    carry = (
        terms.join(long, "conv_id", "left_semi")
        .groupBy("conv_id", "_block")
        .agg(F.bit_xor("ta").alias("ta"), F.bit_xor("tb").alias("tb"))
        .select("conv_id", "_block", xor("ta").alias("ca"), xor("tb").alias("cb"))
    )
    within = Window.partitionBy("conv_id", "_block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0).cast("long")
    return (
        terms.withColumn("a", F.bit_xor("ta").over(within))
        .withColumn("b", F.bit_xor("tb").over(within))
        .join(carry, ["conv_id", "_block"], "left")
        .withColumn("a", F.col("a").bitwiseXOR(F.coalesce("ca", zero)))
        .withColumn("b", F.col("b").bitwiseXOR(F.coalesce("cb", zero)))
        .select("conv_id", "pos", "n_turns", "a", "b", F.col("a").bitwiseXOR(F.col("ta")).alias("pa"), F.col("b").bitwiseXOR(F.col("tb")).alias("pb"), "turn", "chars")
    )


def distinct_nodes(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """Rows (a, b, pa, pb, depth, chars, conv_id, n_convs), one per distinct prefix; the root has the digest (0, 0).

    Two prefixes of one digest that differ in depth, parent or last turn end the job.
    """
    same = ("pos", "pa", "pb", "turn", "chars")
    found = paths.groupBy("a", "b").agg(
        *(F.min(c).alias(c) for c in same),
        *(F.max(c).alias(f"_{c}") for c in same),
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
    )
    differ = F.lit(False)
    for c in same:
        differ = differ | (F.col(c) != F.col(f"_{c}"))
    depth = F.when(differ, F.raise_error(F.lit("two prefixes share a digest")).cast("long")).otherwise(F.col("pos"))
    inner = found.select("a", "b", "pa", "pb", depth.alias("depth"), "chars", "conv_id", "n_convs")
    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    return inner.unionByName(
        root.select(zero.alias("a"), zero.alias("b"), none.alias("pa"), none.alias("pb"), zero.alias("depth"), zero.alias("chars"), "conv_id", "n_convs")
    )


def in_shards(nodes: DataFrame, shards: int) -> DataFrame:
    """Subtree sums inside each shard: rows (a, b, pa, pb, ta, tb, leaves, saved), (ta, tb) the top of the local tree."""

    def local(table: pa.Table) -> pa.Table:
        a, b, up_a, up_b, depth, leaves, saved = (
            table.column(c).fill_null(0).to_numpy() for c in ("a", "b", "pa", "pb", "depth", "leaves", "saved")
        )
        slots = SlotTable(a, b)
        slot = slots.slots(a, b)
        has_parent = table.column("pa").is_valid().to_numpy()
        flat = [np.zeros(len(a), np.int64) for _ in range(4)]
        flat[0][slot] = np.where(has_parent, slots.slots(up_a, up_b), -1)
        for to, values in zip(flat[1:], (depth, leaves, saved)):
            np.add.at(to, slot, values)
        top = accumulate(*flat)[slot]
        columns = (a, b, table.column("pa"), table.column("pb"), slots.a[top], slots.b[top], flat[2][slot], flat[3][slot])
        return pa.table(dict(zip(("a", "b", "pa", "pb", "ta", "tb", "leaves", "saved"), columns)))

    near = F.xxhash64(F.shiftright("conv_id", NEAR_IDS), F.shiftright("depth", NEAR_DEPTHS))
    rows = nodes.select(F.pmod(near, F.lit(shards)).alias("shard"), "a", "b", "pa", "pb", "depth", "leaves", "saved")
    names = ("a", "b", "pa", "pb", "ta", "tb", "leaves", "saved")
    return rows.groupBy("shard").applyInArrow(local, ", ".join(f"{c} long" for c in names))


def carried_over(local: DataFrame) -> DataFrame:
    """Sums of whole local trees, with all local trees below them, by the node above: rows (a, b, leaves, saved).

    After round k a tree holds the sums of all trees less than 2^k steps below it, and points 2^k steps up.
    """
    top = (F.col("a") == F.col("ta")) & (F.col("b") == F.col("tb"))
    tops = settle(local.where(top).select("a", "b", "pa", "pb", "leaves", "saved"), "tops")
    above = local.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("ta").alias("ua"), F.col("tb").alias("ub"))
    trees = settle(lookup(tops, above, ["pa", "pb"], ["a", "b"]), "trees")
    while True:
        moving = trees.where("ua IS NOT NULL")
        if moving.isEmpty():
            break
        sums = moving.groupBy(F.col("ua").alias("a"), F.col("ub").alias("b")).agg(
            F.sum("leaves").alias("_leaves"), F.sum("saved").alias("_saved")
        )
        further = trees.select(F.col("a").alias("ua"), F.col("b").alias("ub"), F.col("ua").alias("na"), F.col("ub").alias("nb"))
        stepped = lookup(trees, further, ["ua", "ub"], ["a", "b"])
        more = lambda c: (F.col(c) + F.coalesce(f"_{c}", F.lit(0).cast("long"))).alias(c)
        trees = settle(
            stepped.join(sums, ["a", "b"], "left").select(
                "a", "b", "pa", "pb", more("leaves"), more("saved"), F.col("na").alias("ua"), F.col("nb").alias("ub")
            ),
            "trees",
        )
    below = trees.where("pa IS NOT NULL").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b"))
    return below.agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def end_digests(ends: DataFrame) -> DataFrame:
    """Rows (a, b, ends_sha256) of rows (a, b, conv_id): the hash of each node's ids in ascending order.

    A hash runs through its text from start to end. The ids are sorted in ranges by node and id and written as pieces
    of text by many tasks; one task per node then only feeds the pieces to the hash, some at a time.
    """

    def pieces(batches):
        for batch in batches:
            a, b, ids = (batch.column(c).to_numpy() for c in ("a", "b", "conv_id"))
            cuts = np.flatnonzero((np.diff(a) != 0) | (np.diff(b) != 0)) + 1
            starts = np.concatenate([[0], cuts])[: len(a)].astype(np.int64)
            texts = [",".join(map(str, part.tolist())) for part in np.split(ids, cuts)][: len(starts)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (a[starts], b[starts], ids[starts])] + [pa.array(texts, pa.string())], names=["a", "b", "first", "ids"])

    def hashed(batches):
        node, state = None, None
        for batch in batches:
            rows = []
            for a, b, _, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "first", "ids"))):
                if (a, b) == node:
                    state.update(b"," + ids.encode())
                    continue
                if node:
                    rows.append((*node, state.hexdigest()))
                node, state = (a, b), hashlib.sha256(ids.encode())
            yield found(rows)
        if node:
            yield found([(*node, state.hexdigest())])

    def found(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.string()))], names=["a", "b", "ends_sha256"]
        )

    ranged = ends.repartitionByRange("a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id")
    texts = ranged.mapInArrow(pieces, "a long, b long, first long, ids string")
    return texts.repartition("a", "b").sortWithinPartitions("a", "b", "first").mapInArrow(hashed, "a long, b long, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """One row per distinct prefix of the conversations: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    `turns` has (conv_id, pos, n_turns, a, b, chars) with positions from 1, `convs` (conv_id, n_turns) has every conversation
    once, also one without turns, which ends at the root. `conv_id` is the smallest one that starts with the prefix and, with the
    depth, names the node. `saved_tokens` sums (n_convs - 1) times the code points of the last text over the subtree.
    Conversations that repeat each other share nodes. Without conversations there are no rows.
    """
    paths = settle(prefixes(turns, convs), "prefixes")
    nodes = settle(distinct_nodes(paths, convs), "nodes")
    children = settle(key_counts(nodes, ["pa", "pb"]), "children")
    parents = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    placed = lookup(nodes, parents, ["pa", "pb"], ["a", "b"], counts=children)
    below = children.select(F.col("pa").alias("a"), F.col("pb").alias("b"), F.col("_rows").alias("n_children"))
    nodes = settle(
        placed.join(below, ["a", "b"], "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
        .withColumn("leaves", (F.col("n_children") == 0).cast("long"))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")),
        "linked-nodes",
    )
    shards = max(1, math.ceil(nodes.count() / shard_nodes))
    local = settle(in_shards(nodes, shards), "local")
    more = carried_over(local).select("a", "b", F.col("leaves").alias("_leaves"), F.col("saved").alias("_saved"))
    added: dict[str, Column] = {c: F.col(c) + F.coalesce(f"_{c}", F.lit(0).cast("long")) for c in ("leaves", "saved")}
    summed = in_shards(nodes.join(more, ["a", "b"], "left").withColumns(added), shards)
    zero = F.lit(0).cast("long")
    ends = paths.where("pos = n_turns").select("a", "b", "conv_id").unionByName(
        convs.where("n_turns = 0").select(zero.alias("a"), zero.alias("b"), "conv_id")
    )
    return (
        nodes.drop("leaves", "saved")
        .join(summed.select("a", "b", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens")), ["a", "b"])
        .join(end_digests(ends), ["a", "b"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"),
        )
    )


#: The same nodes by comparing the whole lists of turns. crc32 runs over the bits of the number's digits.
ORACLE = """WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
      coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
    bits AS (SELECT conv_id, list_concat([4294967295], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
      lambda ch: list_transform(range(8), lambda k: (ascii(ch) >> k) & 1)))) AS b FROM (SELECT DISTINCT conv_id FROM t)),
    c AS (SELECT conv_id, xor(list_reduce(b, lambda s, x: xor(s >> 1, 3988292384 * (xor(s, x) & 1))), 4294967295) % 6 AS h FROM bits),
    s AS (SELECT c.conv_id, t.pos AS p, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.pos <= c.h
      UNION ALL SELECT c.conv_id, t.pos + 1000 AS p, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
    w AS (SELECT c.conv_id, coalesce(l.turns, []) AS turns FROM c LEFT JOIN
      (SELECT conv_id, list({'role': role, 'text': text} ORDER BY p) AS turns FROM s GROUP BY conv_id) l ON l.conv_id = c.conv_id),
    p AS (SELECT conv_id, len(turns) AS n, d AS depth, sha256(CAST(turns[1:d] AS VARCHAR)) AS path,
        CASE WHEN d > 0 THEN sha256(CAST(turns[1:d - 1] AS VARCHAR)) END AS up, CASE WHEN d > 0 THEN len(turns[d].text) ELSE 0 END AS chars
      FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM w)),
    n AS (SELECT path, depth, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
      sha256(coalesce(string_agg(CASE WHEN n = depth THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256 FROM p GROUP BY path, depth),
    k AS (SELECT up, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY up),
    m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON k.up = n.path),
    sub AS (SELECT a.path AS path, sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((v.n_convs - 1) * v.chars) AS saved
      FROM m v JOIN p q ON q.conv_id = v.conv_id AND q.depth <= v.depth JOIN m a ON a.path = q.path GROUP BY a.path)
    SELECT m.conv_id, m.depth, par.conv_id AS parent_conv_id, m.n_convs, m.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
      CAST(saved AS BIGINT) AS saved_tokens, m.ends_sha256
    FROM m JOIN sub ON sub.path = m.path LEFT JOIN n par ON par.path = m.up"""
