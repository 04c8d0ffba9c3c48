"""N-gram Jaccard join by prefix trees.

A text's set holds its distinct shingles of ``gram`` words, A-Z in lower case; a
text of fewer words has its whole sequence as one shingle, a text without words
has none. Two texts link when 100 * |A & B| >= ``percent`` * |A | B|. The result
is a row per document with the smallest id that it reaches by links.

All sets share one global order, rare shingles first: shingles fall by hash
into ``BUCKETS`` buckets whose counts over the whole corpus give a shingle its
level. The order changes only the cost. The steps:

1. Equal sets are one node, named after their smallest id.
2. Linked sets share a shingle among the first n - ceil(percent n / 100) + 1 of each.
   Shingles that several nodes have there are kept as candidates' meeting places.
3. Each such shingle's nodes are paired with two of them, its hubs; verified
   links give components, so a group of near copies is nearly one component
   after work in proportion to its size. One hub is the node with the fewest shingles before this one
   in the order: in a group of near copies what sets a copy apart comes first, so that
   node is nearest to what the copies have in common, and most of them link to it.
4. What may still link lies in different components. At each meeting place the
   nodes outside the most frequent component there meet the nodes of all other
   components, if sizes and positions leave room for the overlap. Verified
   links are added. Pairs within one component need no look: they change nothing.

A pair goes on to verification only if its parity bitmaps allow a link: bit k
of a set's bitmap is the parity of its shingles in class k, so two sets differ
in at least as many shingles as their bitmaps differ in bits. This is exact: no
pair that links is left out, and few that do not link get through.

Verification is the prefix-tree join. Pairs are dealt by their first node; the
sets of the second nodes, frequent shingles first, form a path-compressed trie
and the first node's set walks it: the overlap along a path is counted once for
all sets below, and a subtree is left when the overlap so far and what remains
of either side cannot reach the need of its smallest set. A node with many
partners is split into blocks of about ``BLOCK_SETS``.

Cases: null and empty texts have no shingles and link with nothing; rows with a
null id get a null component; rows that share an id are one node; repeated rows
are returned each; extra columns are ignored; an empty table gives an empty
result. Shingles are told apart by 64-bit hashes, equal sets by 128 bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.tables import doc_texts, written
from strata.llm.text import column_bytes, sequence_hashes, slices, split_words, window_hashes, word_hashes

#: The shingle width and the percentage if none are given.
GRAM = 4
PERCENT = 85
BUCKETS = 1 << 20
CHUNKS = 256
#: What comes first among the nodes at a meeting place, for each hub.
HUBS = ("at, xxhash64(node)", "xxhash64(node, 1)")
RECENT = 3
BLOCK_SETS = 512
#: Bits of the filter for texts that verification needs. A multiple of 32768.
FILTER_BITS = 1 << 24
#: Longs of a parity bitmap.
BITMAP = [f"b{k}" for k in range(8)]

SETS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("n", T.LongType()),
    T.StructField("same", T.BinaryType()),
    *[T.StructField(b, T.LongType()) for b in BITMAP],
    T.StructField("chunk", T.IntegerType()),
    T.StructField("counts", T.BinaryType()),
])
MEETINGS = T.StructType([
    T.StructField("shingle", T.LongType()),
    T.StructField("doc_id", T.LongType()),
    T.StructField("n", T.IntegerType()),
    T.StructField("at", T.IntegerType()),
])
LINKS = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def needed(n: int, m: int, percent: int = PERCENT) -> int:
    """The least overlap with which sets of ``n`` and ``m`` shingles link."""
    return -(-percent * (n + m) // (100 + percent))


def shingle_sets(texts: pa.Array, gram: int = GRAM):
    """The sorted distinct shingle hashes of each text, in order."""
    data, offsets = column_bytes(texts)
    for lo, hi in slices(offsets):
        words = split_words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], lower=True)
        hashes = word_hashes(words)
        grams = window_hashes(hashes, tuple(range(gram)))
        for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
            if b - a >= gram:
                yield np.unique(grams[a : b - gram + 1])
            elif b > a:
                yield sequence_hashes(hashes, np.array([a]), np.array([b]))
            else:
                yield np.zeros(0, np.uint64)


def _bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(44)).astype(np.int64)


def ordered(shingles: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The set in the global order: each shingle's level, then its hash."""
    return np.sort(levels[_bucket(shingles)].astype(np.uint64) << np.uint64(56) | shingles & np.uint64((1 << 56) - 1))


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """The parity of the set's shingles in each of 64 * ``len(BITMAP)`` classes, as longs."""
    odd = np.bincount((shingles & np.uint64(64 * len(BITMAP) - 1)).astype(np.int64), minlength=64 * len(BITMAP)) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


# ---------------------------------------------------------------- sets and their order

def _sets(docs: DataFrame, gram: int) -> DataFrame:
    """A row for each text (n, ``same``, a digest of the set, and its bitmap), and each task's bucket counts in chunks."""

    def run(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            n, same, bits, buckets = [], [], [], [np.zeros(0, np.int64)]
            for s in shingle_sets(batch.column(1), gram):
                n.append(len(s))
                same.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                bits.append(bitmap(s))
                buckets.append(_bucket(s))
                if len(buckets) > 500:  # not the whole batch's shingles at once
                    total += np.bincount(np.concatenate(buckets), minlength=BUCKETS)
                    buckets = [np.zeros(0, np.int64)]
            total += np.bincount(np.concatenate(buckets), minlength=BUCKETS)
            blank = pa.nulls(len(n))
            longs = np.array(bits, np.int64).reshape(len(n), len(BITMAP))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(same, pa.binary()), *[pa.array(c) for c in longs.T.copy()], blank.cast(pa.int32()), blank.cast(pa.binary())],
                names=SETS.names,
            )
        if total.any():
            zstd = zstandard.ZstdCompressor(level=1)
            parts = [zstd.compress(c.tobytes()) for c in total.reshape(CHUNKS, -1)]
            blank, long = pa.nulls(CHUNKS), pa.nulls(CHUNKS, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [long, long, blank.cast(pa.binary()), *[long] * len(BITMAP), pa.array(range(CHUNKS), pa.int32()), pa.array(parts, pa.binary())], names=SETS.names
            )

    return docs.mapInArrow(run, SETS)


def _levels(sets: DataFrame) -> np.ndarray:
    """The level of each bucket: its count on a logarithmic scale. ``BUCKETS`` bytes, whatever the corpus."""

    def run(batches):
        unzip, totals = zstandard.ZstdDecompressor(), {}
        for batch in batches:
            for chunk, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                totals[chunk] = totals.get(chunk, 0) + np.frombuffer(unzip.decompress(raw), np.int64)
        for chunk, total in totals.items():
            level = np.minimum(255, 8 * np.log2(1 + total)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([level.tobytes()], pa.binary())], names=["chunk", "levels"])

    chunks = sets.where("chunk is not null").select("chunk", "counts").repartition("chunk")
    out = np.zeros((CHUNKS, BUCKETS // CHUNKS), np.uint8)
    for r in chunks.mapInArrow(run, "chunk int, levels binary").collect():
        out[r["chunk"]] = np.frombuffer(r["levels"], np.uint8)
    return out.ravel()


def _meetings(docs: DataFrame, levels: Broadcast, gram: int, percent: int) -> DataFrame:
    """The prefix of every set, a row for each shingle; equal sets of one task once."""

    def run(batches):
        seen = set()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            parts, own, size, at = [], [], [], []
            for doc_id, s in zip(ids, shingle_sets(batch.column(1), gram)):
                if doc_id is None or not len(s):
                    continue
                digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                if digest in seen:
                    continue
                seen.add(digest)
                p = prefix_length(len(s), percent)
                parts.append(ordered(s, levels.value)[:p])
                own.append(doc_id)
                size.append(len(s))
                at.append(p)
            if parts:
                at = np.array(at)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(parts).astype(np.int64)), pa.array(np.repeat(np.array(own, np.int64), at)),
                        pa.array(np.repeat(np.array(size, np.int32), at)), pa.array(np.concatenate([np.arange(a, dtype=np.int32) for a in at])),
                    ],
                    names=MEETINGS.names,
                )

    return docs.mapInArrow(run, MEETINGS)


# ---------------------------------------------------------------- the prefix tree

class Trie:
    """Sets in a path-compressed prefix tree; elements ascend along every path."""

    __slots__ = ("run", "below", "ends", "least", "most")

    def __init__(self, run: np.ndarray):
        self.run, self.below, self.ends = run, {}, []
        self.least, self.most = 1 << 62, 0

    def add(self, items: np.ndarray, name) -> None:
        node, rest = self, items
        while True:
            node.least, node.most = min(node.least, len(items)), max(node.most, len(items))
            if not len(rest):
                node.ends.append(name)
                return
            child = node.below.get(int(rest[0]))
            if child is None:
                child = node.below[int(rest[0])] = Trie(rest)
                child.least = child.most = len(items)
                child.ends.append(name)
                return
            n = min(len(rest), len(child.run))
            differ = np.flatnonzero(rest[:n] != child.run[:n])
            shared = int(differ[0]) if len(differ) else n
            if shared < len(child.run):  # the path splits inside this run
                upper = Trie(child.run[:shared])
                upper.least, upper.most = child.least, child.most
                child.run = child.run[shared:]
                upper.below[int(child.run[0])] = child
                node.below[int(rest[0])] = child = upper
            node, rest = child, rest[shared:]

    def linked(self, probe: np.ndarray, percent: int = PERCENT) -> list:
        """Names of the sets that link with ``probe``."""
        found, n = [], len(probe)
        stack = [(self, 0, 0)]
        while stack:
            node, overlap, depth = stack.pop()
            left = n
            if len(node.run):
                at = np.searchsorted(probe, node.run)
                inner = at < n
                overlap += int((probe[at[inner]] == node.run[inner]).sum())
                depth += len(node.run)
                left = n - int(np.searchsorted(probe, node.run[-1], "right"))
            if overlap + min(left, node.most - depth) < needed(n, node.least, percent):
                continue
            if node.ends and overlap >= needed(n, depth, percent):
                found += node.ends
            stack += [(child, overlap, depth) for child in node.below.values()]
        return found


def packed_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node`` and its compressed ``text``, the form in which texts travel, for the nodes of
    ``wanted`` and some others: a hash of the id is looked up among ``FILTER_BITS`` bits,
    which are broadcast whatever the corpus, so texts that no pair needs stay where they are."""
    place = lambda node: F.pmod(F.xxhash64(node), F.lit(FILTER_BITS)) + 1
    bits = wanted.select(place("node").alias("p")).groupBy(F.expr("bitmap_bucket_number(p)").alias("bucket"))
    table = np.zeros((FILTER_BITS // 32768, 4096), np.uint8)
    for r in bits.agg(F.expr("bitmap_construct_agg(bitmap_bit_position(p))").alias("bits")).collect():
        table[r["bucket"] - 1] = np.frombuffer(r["bits"], np.uint8)
    held = docs.sparkSession.sparkContext.broadcast(table.ravel())

    def run(batches):
        zstd = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            at = batch.column(2).fill_null(1).to_numpy() - 1
            batch = batch.filter(pa.array(held.value[at >> 3] >> (at & 7) & 1 == 1))
            data, offsets = column_bytes(batch.column(1))
            cut = offsets.tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([zstd.compress(data[a:b].tobytes()) for a, b in zip(cut[:-1], cut[1:])], pa.binary())], names=["node", "text"])

    return docs.select("doc_id", "text", place("doc_id").alias("place")).mapInArrow(run, "node long, text binary")


def verified(pairs: DataFrame, docs: DataFrame, levels: Broadcast, gram: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose sets link; nodes are ids of ``docs``."""
    pairs = pairs.select("u", "v")
    blocks = pairs.groupBy("u").agg(F.ceil(F.count(F.lit(1)) / BLOCK_SETS).alias("blocks"))
    members = pairs.join(blocks, "u").select("u", F.pmod(F.xxhash64("v"), "blocks").alias("block"), F.col("v").alias("node"), F.lit(1).alias("member"))
    probes = blocks.select("u", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.col("u").alias("node"), F.lit(0).alias("member"))

    def run(batches):
        group, probes, trie = None, [], None
        unzip = zstandard.ZstdDecompressor()

        def out():
            # A node of several rows (one id, different texts) has several sets.
            names = sorted({v for p in probes for v in trie.linked(p, percent)}) if trie is not None and trie.below else []
            if names:
                yield pa.RecordBatch.from_arrays([pa.array([group[0]] * len(names), pa.int64()), pa.array(names, pa.int64())], names=LINKS.names)

        for batch in batches:
            keys = zip(*(batch.column(k).to_pylist() for k in range(4)))
            texts = pa.array([unzip.decompress(t) for t in batch.column(4).to_pylist()], pa.binary())
            for (u, block, node, member), s in zip(keys, shingle_sets(texts, gram)):
                # Ascending from the most frequent shingles.
                s = np.sort(~ordered(s, levels.value))
                if (u, block) != group:
                    yield from out()
                    group, trie, probes = (u, block), Trie(np.zeros(0, np.uint64)), []
                if member:
                    trie.add(s, node)
                else:
                    probes.append(s)
        yield from out()

    dealt = members.unionByName(probes)
    dealt = dealt.join(packed_texts(docs, dealt.select("node")), "node").select("u", "block", "node", "member", "text")
    return dealt.repartition("u", "block").sortWithinPartitions("u", "block", "member").mapInArrow(run, LINKS)


# ---------------------------------------------------------------- components

def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node it reaches) for all nodes of the edges (u, v).

    Each round a node takes the least label among its neighbours and then the
    label of its label, until nothing changes.
    """
    both = edges.select("u", "v").union(edges.select("v", "u")).distinct()
    both = written(both, "edges")
    labels = written(both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("u"), F.min("v")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("v"), "label"), "v").groupBy("u").agg(F.min("label").alias("near"))
        step = labels.join(near, F.col("node") == F.col("u")).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        step = step.join(jump, "label", "left").select("node", "old", F.least("label", F.coalesce("far", "label")).alias("label"))
        step = written(step, "labels")
        labels = step.select("node", "label")
        if step.where("old <> label").isEmpty():
            return labels


def _room(n: str, at: str, m: str, to: str, percent: int) -> Column:
    """Whether sets of ``n`` and ``m`` shingles that first meet at these places can overlap enough."""
    need = F.ceil(percent * (F.col(n) + F.col(m)) / (100 + percent))
    return F.least(F.col(n) - F.col(at), F.col(m) - F.col(to)) >= need


def _may_link(n: str, m: str, a: list[str], b: list[str], percent: int) -> Column:
    """Whether bitmaps differ in no more bits than linked sets of ``n`` and ``m`` shingles may differ in shingles.
    A node without a bitmap may link with any."""
    differ = sum((F.bit_count(F.col(x).bitwiseXOR(F.col(y))) for x, y in zip(a, b)), F.lit(0))
    need = F.ceil(percent * (F.col(n) + F.col(m)) / (100 + percent))
    return F.coalesce(differ <= F.col(n) + F.col(m) - 2 * need, F.lit(True))


def _side(meetings: DataFrame, end: str) -> DataFrame:
    return meetings.select("shingle", *[F.col(c).alias(f"{c}_{end}") for c in meetings.columns if c != "shingle"])


def jaccard_components(docs: DataFrame, gram: int = GRAM, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles and component_id, for shingles of ``gram`` words and links from ``percent`` on."""
    spark, docs = docs.sparkSession, doc_texts(docs)
    sets = written(_sets(docs, gram), "sets")
    levels = spark.sparkContext.broadcast(_levels(sets))
    rows = sets.where("chunk is null").select("doc_id", "n", "same", *BITMAP)
    # Nodes: equal sets, or rows of one id, under their smallest id.
    named = rows.where("same is not null and doc_id is not null")
    least = named.groupBy("same").agg(F.min("doc_id").alias("node"))
    nodes = written(named.join(least, "same").select("doc_id", "node").distinct(), "nodes")

    meetings = _meetings(docs, levels, gram, percent)
    shared = meetings.groupBy("shingle").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("shingle")
    meetings = meetings.join(shared, "shingle").join(nodes, "doc_id").select("shingle", "node", "n", "at").distinct()
    meetings = written(meetings, "meetings")
    # A node whose rows have different sets has no bitmap of its own.
    one = F.min("same") == F.max("same")
    bitmaps = named.groupBy(F.col("doc_id").alias("node")).agg(*[F.when(one, F.min(b)).alias(b) for b in BITMAP])
    bitmaps = written(bitmaps.join(meetings.select("node").distinct(), "node", "left_semi"), "bitmaps")

    # Rows of one id are one node though their sets may differ.
    several = nodes.groupBy("doc_id").agg(F.min("node").alias("v"), F.max("node").alias("w")).where("v <> w")
    several = nodes.join(several, "doc_id")
    same_id = several.where("node <> v").select(F.col("node").alias("u"), "v")
    mixed_sets = several.select("node", F.lit(True).alias("several")).distinct()
    hubs = meetings.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("c"), *[F.min_by(F.struct("node", "n", "at"), F.expr(f"struct({order}, node)")).alias(f"h{k}") for k, order in enumerate(HUBS)]
    ).where("c > 1").select("shingle", F.explode(F.array_distinct(F.array(*[f"h{k}" for k in range(len(HUBS))]))).alias("h"))
    hubs = hubs.select("shingle", F.col("h.node").alias("node_a"), F.col("h.n").alias("n_a"), F.col("h.at").alias("at_a"))
    spokes = _side(meetings, "b").join(hubs, "shingle").where((F.col("node_a") != F.col("node_b")) & _room("n_a", "at_a", "n_b", "at_b", percent))
    spokes = spokes.select(F.col("node_a").alias("u"), F.col("node_b").alias("v"), F.col("n_a").alias("n_u"), F.col("n_b").alias("n_v")).distinct()

    def may_link(pairs: DataFrame) -> DataFrame:
        """The pairs (u, v) of ``n_u`` and ``n_v`` shingles that their bitmaps let through."""
        bits = lambda end: bitmaps.select(F.col("node").alias(end), *[F.col(b).alias(f"{b}_{end}") for b in BITMAP])
        pairs = pairs.join(bits("u"), "u").join(bits("v"), "v")
        return pairs.where(_may_link("n_u", "n_v", [f"{b}_u" for b in BITMAP], [f"{b}_v" for b in BITMAP], percent)).select("u", "v").distinct()

    links = written(verified(written(may_link(spokes), "spokes"), docs, levels, gram, percent), "links")
    labels = components(links.unionByName(same_id))

    held = meetings.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    held = written(held, "meetings")
    by_label = held.groupBy("shingle", "label").agg(F.count(F.lit(1)).alias("c"))
    mixed = by_label.groupBy("shingle").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.count(F.lit(1)).alias("labels")).where("labels > 1").select("shingle", "main")
    # A pair that has just met need not be looked at again: it is left out where the last few
    # meeting places of both have one in common, and stays where it first meets.
    before = Window.partitionBy("node", "n").orderBy("at").rowsBetween(-RECENT, -1)
    held = held.join(mixed, "shingle").join(mixed_sets, "node", "left").withColumn("earlier", F.collect_list("shingle").over(before))
    held = held.withColumn("earlier", F.when(F.col("several"), F.slice("earlier", 1, 0)).otherwise(F.col("earlier"))).drop("several")
    fewer = _side(held.where("label <> main").drop("main"), "a")
    others = _side(held, "b")
    once = (F.col("label_b") == F.col("main_b")) | (F.col("node_a") < F.col("node_b"))
    room = _room("n_a", "at_a", "n_b", "at_b", percent) & ~F.arrays_overlap("earlier_a", "earlier_b")
    rest = fewer.join(others, "shingle").where((F.col("label_a") != F.col("label_b")) & once & room)
    rest = rest.select(F.col("node_a").alias("u"), F.col("node_b").alias("v"), F.col("n_a").alias("n_u"), F.col("n_b").alias("n_v"))
    rest = may_link(rest).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    more = written(verified(written(rest, "pairs"), docs, levels, gram, percent), "links")
    labels = components(links.unionByName(more).unionByName(same_id))

    placed = rows.join(least, "same", "left").join(labels, "node", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "node", "doc_id"))
    # A row without shingles, or whose id has no links of its own, stands for itself.
    return placed.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
