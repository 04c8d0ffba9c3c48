"""Conversations as a prefix trie, counted in minimal-perfect-hash node tables.

A conversation is its turns in order: by ``turn`` (null first), equal turns by
the digest of role and text. Each conversation c is rebuilt with the first
crc32(c) % 4 turns of conversation c - c % 20 in place of its own first ones.
Every distinct sequence of first d turns is a node; conversations that start
with it are its members.

1. Spark digests every turn where it lies (16 bytes of SHA-256 and a word
   count), so no text is shuffled. Turns meet by block of 20 conversations and are
   walked in order: the digest of a prefix is that of the one before and the turn.
   The walk holds one turn and the block's first three.
2. Prefixes are counted with partial aggregates. T is the number of all
   (conversation, prefix) pairs and L the root of T; a node of more than L
   members is tall. The counts of tall nodes add up to T at most, so there are
   at most L of them, and their digests and smallest members go to all tasks.
   Members never grow along a path, so what hangs below the tall nodes are whole
   subtrees of at most L members each: the shards. A first turn that a third of
   all conversations share is a tall node above many shards.
3. A task takes its shards in turn. The distinct digests of a shard get slots by
   a minimal perfect hash (levels of bits, each for the digests that are alone in
   their place, ranked), and the digest kept in a slot verifies every lookup, so
   a digest from elsewhere has no slot. Counts are scattered to flat arrays, and
   leaves and saved tokens are accumulated through the array of parent slots,
   deepest nodes first. What each shard's top carries upwards is summed by
   parent, and the tall nodes are one more table of at most L slots.
4. Members that end in a node are listed in ranges of (node, conversation),
   so a node in which a third of all conversations end is spread over tasks that
   write out decimal ids; its SHA-256, which has to be taken in order, then
   runs over those pieces one by one.

Two different sequences with one digest would show as a node with two parents,
depths or word counts; that is checked for every node and raises.

Cases: rows with a null conv_id are left out; null roles and texts are empty
ones; equal turns are ordered as above, repeated rows are turns of their own; a
conversation may be left without turns and is then a member of the root alone;
an empty table has no nodes. Negative ids take the remainder towards zero, as SQL
does. Texts of any length are digested by Spark; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.tables import written
from strata.llm.text import mix

BLOCK = 20
HEADS = 4
ROOT = bytes(16)
#: Places of a level of the hash for each digest in it.
ROOM = 2
#: Nodes worked on at once, if shards are smaller.
SHARD_NODES = 100_000
ROWS = 10_000
#: Characters of a piece of an id list.
PIECE = 1 << 20

STEPS = T.StructType([
    T.StructField("node", T.BinaryType()),
    T.StructField("parent", T.BinaryType()),
    T.StructField("depth", T.LongType()),
    T.StructField("conv_id", T.LongType()),
    T.StructField("words", T.LongType()),
    T.StructField("ends", T.BooleanType()),
    T.StructField("shard", T.BinaryType()),
])
NODES = T.StructType([
    T.StructField("node", T.BinaryType()),
    T.StructField("parent", T.BinaryType()),
    T.StructField("conv_id", T.LongType()),
    T.StructField("depth", T.LongType()),
    T.StructField("parent_conv_id", T.LongType()),
    T.StructField("n_convs", T.LongType()),
    T.StructField("n_children", T.LongType()),
    T.StructField("n_leaves", T.LongType()),
    T.StructField("saved_tokens", T.LongType()),
    T.StructField("top", T.BooleanType()),
])
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


# ---------------------------------------------------------------- prefixes

def turn_digests(conversations: DataFrame) -> DataFrame:
    """``block``, ``conv_id``, ``turn``, ``digest`` of role and text, and ``words`` of the text."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    conv = F.col("conv_id").cast("long")
    digest = F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16)
    # Every word becomes one letter, then the separators go.
    letters = F.translate(F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x"), " \t\n\x0b\x0c\r", "")
    return conversations.where(F.col("conv_id").isNotNull()).select(
        (conv - conv % BLOCK).alias("block"), conv.alias("conv_id"), F.col("turn").cast("long").alias("turn"), digest.alias("digest"), F.length(letters).cast("long").alias("words")
    )


class _Walk:
    """The conversations of blocks, turn by turn; collects rows of ``STEPS``."""

    def __init__(self, tall: dict[bytes, int] | None):
        self.tall, self.rows = tall, []
        self.block = self.conv = None
        self.head: list[tuple[bytes, int]] = []

    def _put(self, node: bytes, parent: bytes | None, words: int) -> None:
        if self.tall is not None and self.shard is None and node not in self.tall:
            self.shard = node
        self.last = [node, parent, self.depth, self.conv, words, False, self.shard]
        self.rows.append(self.last)
        self.node = node

    def _step(self, digest: bytes, words: int) -> None:
        self.depth += 1
        self._put(hashlib.blake2b(self.node + digest, digest_size=16).digest(), self.node, words)

    def close(self) -> None:
        if self.conv is not None:
            self.last[5] = True

    def turn(self, block: int, conv: int, digest: bytes, words: int) -> None:
        if conv != self.conv:
            self.close()
            if block != self.block:
                self.block, self.head = block, []
            self.conv, self.own, self.depth, self.shard = conv, 0, 0, None
            self.skip = zlib.crc32(str(conv).encode()) % HEADS if conv != block else 0
            self._put(ROOT, None, 0)
            for d, w in self.head[: self.skip]:
                self._step(d, w)
        self.own += 1
        if conv == block and self.own < HEADS:
            self.head.append((digest, words))
        if self.own > self.skip:
            self._step(digest, words)


def steps(turns: DataFrame, tall: dict[bytes, int] | None = None) -> DataFrame:
    """A row for each rebuilt conversation and each of its prefixes, the root included.

    With the digests of the tall nodes, ``shard`` is the first node of the path
    that is not tall (null for tall nodes); without, it is null.
    """

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(zip(*rows), _types(STEPS))], names=STEPS.names)

    def run(batches):
        walk = _Walk(tall)
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                walk.turn(*row)
                if len(walk.rows) > ROWS:  # the last row may still become an end
                    done, walk.rows = walk.rows[:-1], walk.rows[-1:]
                    yield batch_of(done)
        walk.close()
        if walk.rows:
            yield batch_of(walk.rows)

    own_first = [F.col("block"), (F.col("conv_id") != F.col("block")), F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]
    dealt = turns.repartition("block").sortWithinPartitions(*own_first)
    return dealt.select("block", "conv_id", "digest", "words").mapInArrow(run, STEPS)


def _types(schema: T.StructType) -> list[pa.DataType]:
    kinds = {T.BinaryType(): pa.binary(), T.LongType(): pa.int64(), T.BooleanType(): pa.bool_(), T.StringType(): pa.string()}
    return [kinds[f.dataType] for f in schema.fields]


# ---------------------------------------------------------------- the node table

class NodeTable:
    """Slots 0..n-1 for n distinct digests by a minimal perfect hash.

    Each level hashes the digests that are left to ``ROOM`` places for each. Those alone
    in their place are settled: the slot is the rank of that place among all settled places.
    """

    def __init__(self, digests: np.ndarray):
        self.levels, left, base = [], np.arange(len(digests)), 0
        self.slots = np.full(len(digests), -1, np.int64)
        while len(left):
            if len(self.levels) > 200:
                raise ValueError("the digests are not distinct")
            size = ROOM * len(left)
            place = self._place(digests[left], len(self.levels), size)
            alone = np.bincount(place, minlength=size)[place] == 1
            settled = np.zeros(size, bool)
            settled[place[alone]] = True
            rank = np.cumsum(settled) - 1 + base
            self.levels.append((size, settled, rank))
            self.slots[left[alone]] = rank[place[alone]]
            base += int(alone.sum())
            left = left[~alone]
        self.kept = np.zeros_like(digests)
        self.kept[self.slots] = digests

    @staticmethod
    def _place(digests: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(digests[:, 0] ^ mix(digests[:, 1] + np.uint64(level))) % np.uint64(size)).astype(np.int64)

    def lookup(self, digests: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 for a digest that the table does not hold."""
        slots, left = np.full(len(digests), -1, np.int64), np.arange(len(digests))
        for level, (size, settled, rank) in enumerate(self.levels):
            place = self._place(digests[left], level, size)
            hit = settled[place]
            slots[left[hit]] = rank[place[hit]]
            left = left[~hit]
        found = np.flatnonzero(slots >= 0)
        slots[found[(self.kept[slots[found]] != digests[found]).any(1)]] = -1
        return slots


def _digests(col: list[bytes | None]) -> np.ndarray:
    return np.frombuffer(b"".join(c if c is not None else b"\xff" * 16 for c in col), np.uint64).reshape(-1, 2)


def accumulated(node, parent, depth, conv, n, words, children, leaves, saved):
    """Arrays in the order given: parent's conv (-1 where the parent is not in the table), whether it
    is, children, leaves and saved tokens, with what is already known of the last three added in."""
    table = NodeTable(node)
    slots, size = table.slots, len(node)

    def scattered(values):
        out = np.zeros(size, np.int64)
        out[slots] = values
        return out

    up = np.full(size, -1, np.int64)
    up[slots] = table.lookup(parent)
    level, convs = scattered(depth), scattered(conv)
    below, ends, gain = scattered(children), scattered(leaves), scattered(saved)
    inner = up >= 0
    below += np.bincount(up[inner], minlength=size)
    ends += below == 0
    gain += scattered((n - 1) * words)
    order = np.argsort(-level, kind="stable")
    order = order[inner[order]]
    cuts = np.flatnonzero(np.diff(level[order])) + 1
    for part in np.split(order, cuts):  # deepest nodes first
        np.add.at(ends, up[part], ends[part])
        np.add.at(gain, up[part], gain[part])
    above = np.where(inner, convs[up], -1)
    return above[slots], inner[slots], below[slots], ends[slots], gain[slots]


def counted(nodes: DataFrame, tall: dict[bytes, int]) -> DataFrame:
    """The rows of ``NODES`` for whole shards; ``nodes`` holds ``shard``, node, parent, depth, conv_id,
    n_convs, words and what is known of children, leaves and saved tokens from elsewhere."""

    def out(rows):
        _, node, parent, depth, conv, n, words, children, leaves, saved = zip(*rows)
        longs = [np.array(c, np.int64) for c in (depth, conv, n, words, children, leaves, saved)]
        above, inner, below, ends, gain = accumulated(_digests(node), _digests(parent), *longs)
        names = [int(a) if i else tall.get(p) for a, i, p in zip(above.tolist(), inner.tolist(), parent)]
        cols = [node, parent, conv, depth, names, n, below, ends, gain, ~inner]
        return pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(cols, _types(NODES))], names=NODES.names)

    def run(batches):
        rows = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if len(rows) >= SHARD_NODES and row[0] != rows[-1][0]:  # only whole shards go
                    yield out(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield out(rows)

    return nodes.select("shard", "node", "parent", "depth", "conv_id", "n_convs", "words", "children", "leaves", "saved").mapInArrow(run, NODES)


# ---------------------------------------------------------------- members that end in a node

def end_lists(ends: DataFrame) -> DataFrame:
    """``node`` and ``ends_sha256`` of the conversations (node, conv_id) that end in it."""

    def pieces(batches):
        node, first, parts, size = None, None, [], 0
        rows, held = [], 0
        for batch in batches:
            for n, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if n != node or size > PIECE:
                    if parts:
                        rows.append((node, first, ",".join(parts)))
                        held += size
                    node, first, parts, size = n, c, [], 0
                    if len(rows) >= ROWS or held > PIECE:
                        yield listed(rows)
                        rows, held = [], 0
                parts.append(str(c))
                size += len(parts[-1]) + 1
        if parts:
            rows.append((node, first, ",".join(parts)))
        if rows:
            yield listed(rows)

    def listed(rows):
        node, first, text = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(node, pa.binary()), pa.array(first, pa.int64()), pa.array(text, pa.string())], names=["node", "first", "ids"])

    def digests(batches):
        node, running = None, None
        for batch in batches:
            done = []
            for n, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if n != node:
                    if running is not None:
                        done.append((node, running.hexdigest()))
                    node, running = n, hashlib.sha256(text.encode())
                else:
                    running.update(b"," + text.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], names=["node", "ends_sha256"])
        if running is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([running.hexdigest()], pa.string())], names=["node", "ends_sha256"])

    ranged = ends.select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    listed_ids = ranged.mapInArrow(pieces, "node binary, first long, ids string")
    return listed_ids.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digests, "node binary, ends_sha256 string")


# ---------------------------------------------------------------- the trie

def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row for each node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``; see the module's text."""
    turns = written(turn_digests(conversations), "turns")
    sizes = written(steps(turns).groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id")), "prefixes")
    total = sizes.agg(F.sum("n").alias("t")).first()["t"] or 0
    most = max(1, math.isqrt(total))
    tall = {bytes(r["node"]): r["conv_id"] for r in sizes.where(F.col("n") > most).collect()}

    path = written(steps(turns, tall), "paths")
    one = lambda c: F.min(c).eqNullSafe(F.max(c))
    sole = one("parent") & one("depth") & one("words")
    nodes = path.groupBy("node").agg(
        F.min("shard").alias("shard"), F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"), F.when(sole, F.min("words")).otherwise(F.raise_error(F.lit("two prefixes have one digest"))).alias("words"),
    )
    nodes = written(nodes, "nodes")
    blank = [F.lit(0).cast("long").alias(c) for c in ("children", "leaves", "saved")]
    low = nodes.where("shard is not null").select("*", *blank).repartition("shard").sortWithinPartitions("shard", "depth")
    low = written(counted(low, tall), "shards")
    carried = low.where("top").groupBy(F.col("parent").alias("node")).agg(
        F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
    )
    high = nodes.where("shard is null").join(carried, "node", "left").fillna(0, ["children", "leaves", "saved"])
    high = counted(high.coalesce(1), tall)  # at most L rows
    ended = end_lists(path.where("ends"))
    none = hashlib.sha256(b"").hexdigest()
    return low.unionByName(high).join(ended, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(none))).select(*RESULT)
