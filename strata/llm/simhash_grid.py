"""SimHash near-duplicates by a grid over segment popcounts.

A text's fingerprint has 64 bits: A-Z go to lower case, every run of three words
(joined by a space, repeats included) is hashed by XXH64 with seed 42, and a bit
is 1 if more than half of the hashes have it. A text of one or two words is one
such run, a text without words has fingerprint zero. Fingerprints link at two or
fewer differing bits; a component is all that links reach.

The distinct fingerprints are nodes, so exact copies cost one row a task before
the shuffle. A node's point has a coordinate for each of 16 segments of 4 bits:
the number of ones there. Two fingerprints that differ in k bits lie at a
Manhattan distance of at most k, so that distance is a lower bound, and the join
looks only at points within 2. Between two such points there is a grid cell
within 1 of both: each node therefore goes to its own cell and to the 32 cells
one step away, and nodes meet in cells.

A cell of more than ``CELL`` nodes is refined: its nodes go on, inside the cell,
to a grid of twice as many segments, half as wide. The same argument holds at
each step. The last grid has one bit a segment, where the bound is the
distance itself and a cell holds at most 65 nodes; no cell is capped or skipped,
and none puts more than ``CELL`` nodes, or 65, together.

In each cell every pair is verified on the fingerprints themselves. What leaves
the cell is a star for each group of nodes that verified links hold together, so a cell
of n near copies sends n - 1 links, not n * n / 2. Components of all links come
from label rounds over written tables. Fingerprints with more than a
thousandth of all rows, at most a thousand of them, are broadcast for the last
join; the others are joined by shuffle.

Cases: null and empty texts have fingerprint zero and link as others do; every
row has a result, also repeated ones; rows that share an id but not a text are
rows of their own; a null id never names a component unless all ids in it are
null (then the component is null); texts of any length are hashed in slices;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.jaccard_join import components
from strata.llm.tables import doc_texts, written
from strata.llm.text import Words, column_bytes, ranges, slices, split_words

GRAM = 3
SEED = 42
#: Differing bits at which fingerprints still link. The grid's reach of one cell from both sides covers two.
DISTANCE = 2
#: Segments of the grids, each finer than the one before; the last has one bit a segment.
GRIDS = (16, 32, 64)
#: Nodes that a cell may hold before it is refined.
CELL = 256
#: Hashes whose bits are counted at once.
BLOCK = 1 << 15
#: Fingerprints with more than this share of all rows are broadcast.
HOT = 1000

PRINTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("print", T.LongType())])
LINKS = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])


# ---------------------------------------------------------------- fingerprints

def _joined(words: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words with one space between, and where each starts and ends."""
    size = words.end - words.start
    end = np.cumsum(size + 1) - 1
    start = end - size
    out = np.full(int(end[-1]) + 1 if len(end) else 0, 32, np.uint8)
    out[ranges(start, size)] = words.data[ranges(words.start, size)]
    return out.tobytes(), start, end


def fingerprints(texts: pa.Array, gram: int = GRAM) -> np.ndarray:
    """The fingerprint of each text, as unsigned 64-bit integers."""
    data, offsets = column_bytes(texts)
    out = np.zeros(len(texts), np.uint64)
    digest = xxhash.xxh64_intdigest
    for lo, hi in slices(offsets):
        words = split_words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], lower=True)
        joined, start, end = _joined(words)
        n = words.counts()
        runs = np.where(n >= gram, n - gram + 1, np.minimum(n, 1))
        first = ranges(words.first[:-1], runs)
        last = first + np.repeat(np.minimum(n, gram), runs) - 1
        # Bits of each text, counted block by block.
        ones = np.zeros((hi - lo, 64), np.int64)
        owner = np.repeat(np.arange(hi - lo), runs)
        for a in range(0, len(first), BLOCK):
            cut = zip(start[first[a : a + BLOCK]].tolist(), end[last[a : a + BLOCK]].tolist())
            hashes = np.array([digest(joined[i:j], SEED) for i, j in cut], np.uint64)
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            own = owner[a : a + BLOCK]
            begins = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            ones[own[begins]] += np.add.reduceat(bits, begins, axis=0, dtype=np.int32)
        majority = (2 * ones > runs[:, None]).astype(np.uint8)
        out[lo:hi] = np.packbits(majority, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def prints(docs: DataFrame, gram: int = GRAM) -> DataFrame:
    """``doc_id`` and ``print``, the fingerprint as a signed long, for every row."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fingerprints(batch.column(1), gram).view(np.int64))], names=PRINTS.names)

    return doc_texts(docs).mapInArrow(run, PRINTS)


# ---------------------------------------------------------------- the grid

def coordinates(nodes: np.ndarray, segments: int) -> np.ndarray:
    """The number of ones in each segment of each fingerprint."""
    bits = np.unpackbits(nodes.astype(np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.reshape(len(nodes), segments, 64 // segments).sum(2, dtype=np.int64)


def cells(nodes: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """For each node its cell and those one step away that hold points: row indices and cells.

    A cell is its coordinates as the digits of one number. For 16 segments
    of 4 bits these are 16 digits up to 4, which fit 37.2 bits; for 32 of 2 bits digits
    up to 2 (50.8 bits); for 64 of one bit the fingerprint itself.
    """
    width = 64 // segments
    at = coordinates(nodes, segments).astype(np.uint64)
    base = np.uint64(width + 1)
    with np.errstate(over="ignore"):
        place = np.cumprod(np.concatenate([[np.uint64(1)], np.full(segments - 1, base, np.uint64)]), dtype=np.uint64)
        own = (at * place).sum(1, dtype=np.uint64)
        rows, keys = [np.arange(len(nodes))], [own]
        for k in range(segments):
            up, down = np.flatnonzero(at[:, k] < width), np.flatnonzero(at[:, k] > 0)
            rows += [up, down]
            keys += [own[up] + place[k], own[down] - place[k]]
    return np.concatenate(rows), np.concatenate(keys).view(np.int64)


def met(nodes: DataFrame, level: int) -> DataFrame:
    """``nodes`` (node and the cells of coarser grids) with their cells of grid ``level``, a row for each."""
    above = [f"cell{k}" for k in range(level)]

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                rows, keys = cells(part.column(0).to_numpy().view(np.uint64), GRIDS[level])
                each = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [*[c.take(each) for c in part.columns], pa.array(keys)], names=[*part.schema.names, f"cell{level}"]
                )

    schema = "node long" + "".join(f", {c} long" for c in above) + f", cell{level} long"
    return nodes.select("node", *above).mapInArrow(run, schema)


def _stars(group: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (u, v) that join, in each run of equal ``group``, the nodes that verified links hold together."""
    n = len(node)
    left, right = [], []
    for step in range(1, n):
        same = np.flatnonzero(group[step:] == group[:-step])
        if not len(same):
            break
        close = same[np.bitwise_count(node[same] ^ node[same + step]) <= DISTANCE]
        left.append(close)
        right.append(close + step)
    if not left:
        return node[:0], node[:0]
    left, right = np.concatenate(left), np.concatenate(right)
    label = np.arange(n)
    while True:
        least = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, left, least)
        np.minimum.at(label, right, least)
        label = label[label]
        if (label == before).all():
            break
    other = np.flatnonzero(label != np.arange(n))
    return node[label[other]], node[other]


def cell_links(rows: DataFrame, depth: int) -> DataFrame:
    """Verified links of rows (cell0 .. cell``depth - 1``, node), each cell's stars."""
    names = [f"cell{k}" for k in range(depth)]

    def run(batches):
        held = None  # the last cell's rows so far: it may go on in the next batch

        def out(keys, node):
            change = np.any(keys[1:] != keys[:-1], axis=1) if len(node) > 1 else np.zeros(0, bool)
            group = np.concatenate([[0], np.cumsum(change)])
            u, v = _stars(group, node)
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=LINKS.names)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(k).to_numpy() for k in range(depth)], axis=1)
            node = batch.column(depth).to_numpy().view(np.uint64)
            if held is not None:
                keys, node = np.concatenate([held[0], keys]), np.concatenate([held[1], node])
            last = np.flatnonzero(np.any(keys != keys[-1], axis=1))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield from out(keys[:cut], node[:cut])
            held = keys[cut:], node[cut:]
        if held is not None and len(held[1]):
            yield from out(*held)

    dealt = rows.select(*names, "node").repartition(*names).sortWithinPartitions(*names, "node")
    return dealt.mapInArrow(run, LINKS)


def links(nodes: DataFrame) -> DataFrame:
    """Enough of the links (u, v) between the distinct fingerprints ``node`` to hold every component together."""
    found, rest = None, nodes
    for level in range(len(GRIDS)):
        names = [f"cell{k}" for k in range(level + 1)]
        at = met(rest, level)
        if level < len(GRIDS) - 1:
            at = written(at, f"grid{level}")
            size = at.groupBy(*names).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
            full = size.where(F.col("size") > CELL).select(*names)
            # Cells of one node need no look; cells of many go on to the next grid.
            some = at.join(size.where(F.col("size") <= CELL).select(*names), names, "left_semi")
            rest = at.join(full, names, "left_semi")
        else:
            some = at
        more = cell_links(some, level + 1)
        found = more if found is None else found.unionByName(more)
        if level < len(GRIDS) - 1:
            rest = written(rest, f"refined{level}")
            if rest.isEmpty():
                break
    return found.distinct()


# ---------------------------------------------------------------- components

def simhash_components(docs: DataFrame, gram: int = GRAM) -> DataFrame:
    """Per row: ``doc_id``, ``fingerprint`` (16 lowercase hex digits) and ``component_id``, the
    smallest id of its component. See the module's text for the cases."""
    rows = written(prints(docs, gram), "prints")
    nodes = written(rows.groupBy(F.col("print").alias("node")).agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "nodes")
    labels = components(written(links(nodes.select("node")), "links"))
    own = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = own.groupBy("label").agg(F.min("first").alias("component_id"))
    placed = written(own.select("node", "label", "n").join(least, "label").select("node", "n", "component_id"), "placed")
    total = rows.count()
    hot = F.col("n") * HOT > total
    frequent = placed.where(hot).select(F.col("node").alias("print"), F.col("component_id").alias("near"), F.lit(True).alias("hot"))
    marked = rows.join(F.broadcast(frequent), "print", "left")
    rare = marked.where("hot is null").drop("near", "hot").join(placed.where(~hot).select(F.col("node").alias("print"), "component_id"), "print")
    result = marked.where("hot").select("doc_id", "print", F.col("near").alias("component_id")).unionByName(rare.select("doc_id", "print", "component_id"))
    return result.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
