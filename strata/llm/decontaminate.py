"""Benchmark decontamination by spaced seeds.

Tokens are runs of letters and digits of the lower-cased text (any byte above
ASCII counts as a letter). A mask names the places of a window that count; the
hash of the tokens there ignores the others, so a substitution between two
counted places does not hide a passage. Hashes of the benchmark's windows
(test) meet those of the documents' windows (training) under every mask. Around
each meeting the benchmark item is laid along the document on that diagonal,
and a stretch is an overlap if it has at least ``MIN_OVERLAP`` tokens, or the
whole item if that is shorter, and ``MIN_IDENTITY`` of them match. Of a
diagonal's stretches the one with the best score (a match counts 1, a
substitution ``-PENALTY``) is taken if it is an overlap, else the overlap
with the most matches beyond ``MIN_IDENTITY``; the rest of the diagonal on both
sides is searched for more.

An item shorter than ``MIN_OVERLAP`` must overlap as a whole, with few
substitutions. Its masks count every place but those of equal remainder, one
mask more than it may have substitutions, so one of them misses all of these:
such overlaps are found without loss. For longer items the four masks are a
heuristic; the tests measure their recall.

The benchmark is a query set: it is dealt into blocks of about ``BLOCK_TOKENS``
tokens, each block's index is broadcast, and all documents are read against
it. The number of blocks follows the benchmark's size, which Spark counts.

Cases: null or empty texts and items have no tokens and meet nothing; items
of fewer than ``MIN_EVIDENCE`` tokens are found and reported, but no reason
to drop a document; every overlap of an item counts in ``n_overlaps``, also several
on one diagonal; a very long text is worked on alone, as a whole;
repeated documents are reported each, and items with the same text each;
items of a null id count as others and are reported under a null id;
extra columns are carried by ``drop_contaminated`` as they are; empty tables
give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.tables import doc_texts
from strata.llm.text import Words, column_bytes, range_hashes, ranges, slices, window_hashes

# The places that each mask counts.
MASKS = (
    (0, 1, 2, 3, 4, 5),
    (0, 1, 3, 4, 6, 7),
    (0, 2, 3, 5, 7, 8),
    (0, 1, 4, 6, 9, 10),
)
PENALTY = 2
MIN_OVERLAP = 13
MIN_IDENTITY = 0.8
MIN_EVIDENCE = 6
BLOCK_TOKENS = 500_000
FILTER_BITS = 20
OVERLAPS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("doc_start", T.LongType()),
    T.StructField("doc_end", T.LongType()),
    T.StructField("item_start", T.LongType()),
    T.StructField("n_match", T.LongType()),
    T.StructField("n_overlaps", T.LongType()),
])

_TOKEN = np.zeros(256, bool)
_TOKEN[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def tokens(texts: pa.Array) -> tuple[Words, np.ndarray]:
    """The tokens of the texts and their hashes."""
    data, offsets = column_bytes(pc.utf8_lower(pc.fill_null(texts, "")))
    inside = _TOKEN[data]
    n = len(data)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    start = np.flatnonzero(inside & (np.append(True, ~inside[:-1])[:n] | cut[:n]))
    end = np.flatnonzero(inside & (np.append(~inside[1:], True)[:n] | cut[1:])) + 1
    words = Words(data, start, end, np.searchsorted(start, offsets).astype(np.int64))
    return words, range_hashes(data, start, end)


def _seeds(words: Words, hashes: np.ndarray, mask: tuple[int, ...], span: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose window of ``span`` tokens stays inside its text, and their hashes under the mask."""
    seed = window_hashes(hashes, mask)
    last = np.repeat(words.first[1:], words.counts())[: len(seed)]
    at = np.flatnonzero(np.arange(len(seed)) + span <= last)
    return at, seed[at]


def short_masks(length: int) -> list[tuple[int, ...]]:
    """Masks for a whole item of this length: however its substitutions fall, one mask counts none of them."""
    may = length - math.ceil(Fraction(str(MIN_IDENTITY)) * length)
    return [tuple(range(k, length, may + 1)) for k in range(may + 1)]


class BenchmarkIndex:
    """Spaced-seed hashes of benchmark items, for each mask sorted with the places they come from."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        self.ids = [i for i, _ in items]
        words, self.hashes = tokens(pa.array([t for _, t in items], pa.string()))
        self.first = words.first
        self.item = words.doc()
        size = words.counts()
        short = sorted({int(n) for n in size if 0 < n < MIN_OVERLAP})
        self.masks = []
        for mask, span, whole in [*((m, max(m) + 1, False) for m in MASKS), *((m, n, True) for n in short for m in short_masks(n))]:
            at, seed = _seeds(words, self.hashes, mask, span)
            # A short item counts at its start alone, a longer one everywhere.
            own = size[self.item[at]] == span if whole else size[self.item[at]] >= MIN_OVERLAP
            at, seed = at[own], seed[own]
            order = np.argsort(seed, kind="stable")
            near = np.zeros(1 << FILTER_BITS, bool)
            near[seed >> np.uint64(64 - FILTER_BITS)] = True
            if len(at):
                self.masks.append((mask, span, near, seed[order], at[order]))

    def size(self, item: int) -> int:
        return int(self.first[item + 1] - self.first[item])

    def overlaps(self, texts: pa.Array) -> list[tuple[int, int, int, int, int, int, int]]:
        """Of each text and item that overlap: text, item, best stretch (start and end in the
        text, start in the item, matches) and the number of overlaps."""
        words, hashes = tokens(texts)
        places, diagonals = [], []
        for mask, span, near, seeds, at in self.masks:
            here, seed = _seeds(words, hashes, mask, span)
            maybe = near[seed >> np.uint64(64 - FILTER_BITS)]
            here, seed = here[maybe], seed[maybe]
            lo = np.searchsorted(seeds, seed, "left")
            count = np.searchsorted(seeds, seed, "right") - lo
            source = at[ranges(lo, count)]
            target = np.repeat(here, count)
            places.append(self.item[source])
            diagonals.append(target - (source - self.first[self.item[source]]))
        if not sum(map(len, places)):  # also of an index without tokens
            return []
        pairs = np.unique(np.stack([np.concatenate(places), np.concatenate(diagonals)]), axis=1)
        found: dict[tuple[int, int], list[tuple[int, int, int, int]]] = {}
        for item, diagonal in zip(pairs[0].tolist(), pairs[1].tolist()):
            for text, stretch in self._stretches(words, hashes, item, diagonal):
                found.setdefault((text, item), []).append(stretch)
        out = []
        for (text, item), all_ in sorted(found.items()):
            best = max(all_, key=lambda s: (s[3], -s[0], s[2]))
            out.append((text, item, best[0], best[1], best[2], best[3], len({s[0] for s in all_})))
        return out

    def _stretches(self, words: Words, hashes: np.ndarray, item: int, diagonal: int):
        """Overlaps of the item laid along the tokens from ``diagonal`` on, in each text that it touches."""
        a, b = int(self.first[item]), int(self.first[item + 1])
        lo, hi = max(diagonal, 0), min(diagonal + b - a, len(hashes))
        text = int(np.searchsorted(words.first, lo, "right")) - 1
        while lo < hi:
            edge = min(hi, int(words.first[text + 1]))
            if edge > lo:
                same = hashes[lo:edge] == self.hashes[a + lo - diagonal : a + edge - diagonal]
                for start, end, n in all_stretches(same, min(MIN_OVERLAP, b - a)):
                    at = lo + start
                    yield text, (at - int(words.first[text]), lo + end - int(words.first[text]), at - diagonal, n)
            lo, text = edge, text + 1


def all_stretches(same: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Overlaps of at least ``least`` tokens that share no place, the best first on each part that the one before leaves."""
    out, parts = [], [(0, len(same))]
    while parts:
        lo, hi = parts.pop()
        if hi - lo < least:
            continue
        start, end, n = best_stretch(same[lo:hi])
        if end - start >= least and n >= MIN_IDENTITY * (end - start):
            out.append((lo + start, lo + end, n))
            parts += [(lo, lo + start), (lo + end, hi)]
    return out


def best_stretch(same: np.ndarray) -> tuple[int, int, int]:
    """Start, end and matches of the stretch with the best score (the first of equals), or of
    another of at least ``MIN_OVERLAP`` tokens, or all, if only that one has enough matches."""
    score = np.append(0, np.cumsum(np.where(same, 1, -PENALTY)))
    low = np.minimum.accumulate(score)
    end = int(np.argmax(score - low))
    start = int(np.argmin(score[: end + 1]))
    best = start, end, int(same[start:end].sum())
    # An item shorter than MIN_OVERLAP overlaps as a whole, so then this is its length.
    least = min(MIN_OVERLAP, len(same))
    if end - start >= least and best[2] >= MIN_IDENTITY * (end - start):
        return best
    # In whole numbers, a stretch has enough matches if its sum is not negative.
    share = Fraction(str(MIN_IDENTITY))
    total = np.append(0, np.cumsum(np.where(same, share.denominator, 0) - share.numerator))
    over = total[least:] - np.minimum.accumulate(total[: len(total) - least])
    end = int(np.argmax(over))
    if over[end] < 0:
        return best
    start = int(np.argmin(total[: end + 1]))
    end += least
    return start, end, int(same[start:end].sum())


def _index_blocks(benchmark: DataFrame) -> Iterator[BenchmarkIndex]:
    """The benchmark's index in blocks of about ``BLOCK_TOKENS`` tokens (one item at least)."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / 4 / BLOCK_TOKENS))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for k in range(n):
        rows = sorted(((r[0], r[1]) for r in items.where(block == k).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        if rows:
            yield BenchmarkIndex(rows)


def _batches(texts: pa.Array):
    _, offsets = column_bytes(pc.fill_null(texts, ""))
    return slices(offsets)


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and benchmark item that overlap (``OVERLAPS``), in token offsets:
    the best stretch, its matching tokens, and the number of overlaps of that item."""
    spark, out = docs.sparkSession, None
    for block in _index_blocks(benchmark):
        index = spark.sparkContext.broadcast(block)

        def run(batches, index=index):
            for batch in batches:
                for lo, hi in _batches(batch.column(1)):
                    part = batch.slice(lo, hi - lo)
                    found = index.value.overlaps(part.column(1))
                    if found:
                        text, item, *rest = zip(*found)
                        yield pa.RecordBatch.from_arrays(
                            [part.column(0).take(pa.array(text)), pa.array([index.value.ids[i] for i in item], pa.int64()), *[pa.array(c, pa.int64()) for c in rest]],
                            names=OVERLAPS.names,
                        )

        rows = doc_texts(docs).mapInArrow(run, OVERLAPS)
        out = rows if out is None else out.unionByName(rows)
    return spark.createDataFrame([], OVERLAPS) if out is None else out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, least_tokens: int = MIN_EVIDENCE) -> DataFrame:
    """The rows of ``docs`` that overlap no benchmark item of ``least_tokens`` tokens or more, all columns as they are."""
    out = docs
    at = docs.columns.index("text")
    for block in _index_blocks(benchmark):
        index = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, index=index):
            for batch in batches:
                for lo, hi in _batches(batch.column(at)):
                    part = batch.slice(lo, hi - lo)
                    clean = np.ones(hi - lo, bool)
                    clean[[f[0] for f in index.value.overlaps(part.column(at)) if index.value.size(f[1]) >= least_tokens]] = False
                    yield part if clean.all() else part.filter(pa.array(clean))

        out = out.mapInArrow(run, docs.schema)
    return out
