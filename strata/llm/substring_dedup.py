"""Substring dedup: suffix automata of reference shards give matching statistics.

A window is ``WINDOW`` consecutive words of one document. A word goes if some
window over it has a word sequence that starts earlier as well: in a smaller
``doc_id``, or in the same document before. Windows are judged on the input.

The corpus is its own reference, so it is dealt into shards that must hold
every place where a window can recur. Each window has an anchor, the
``GRAM``-word run of least hash in it; equal windows have equal anchors, and a
run of windows with one anchor is a context. Contexts are routed by the hash
of their anchor:

1. Equal contexts of one anchor: all but the first are repeats throughout.
   Within a batch they are resolved at once, so a passage in any share of the
   documents sends one row a batch.
2. Anchors with one distinct context are done. The distinct contexts of the
   others are the reference shards. In the order of their places each context
   is streamed through the suffix automaton of those before it; a matching
   length of ``WINDOW`` words at a word means that the window ending there
   starts earlier. Then the automaton takes the context in.
   No shard holds more than ``SHARD_CONTEXTS`` contexts: the windows of an
   anchor with more are settled each by its own hash, as contexts are in 1. Within
   a batch all but the first of equal windows are repeats at once; of those left a
   partial aggregate keeps the least place of each hash, and all others are
   repeats. So a window that a share of all documents hold costs a task a row
   a batch, and no automaton grows with a group of near copies.
3. The windows found are gathered by document and their words removed.

A shard meets only the documents that share its anchor. Sending every shard's
automaton to all documents would cost the square of the corpus.

Cases: a null or empty text has no words and keeps the empty text; fewer than
``WINDOW`` words are kept whole; a null id counts as the smallest; rows with
the same id and text are one document and each gets its result; rows with the
same id and different texts are ordered by a hash of the text; extra columns
are ignored; an empty table gives an empty result. Word sequences are told
apart by 64-bit hashes of anchors and contexts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.tables import doc_texts, written
from strata.llm.text import Words, column_bytes, ranges, sequence_hashes, slices, split_words, window_hashes, window_starts, word_hashes

WINDOW = 20
GRAM = 8
SHARD_CONTEXTS = 2000

CONTEXTS = T.StructType([
    T.StructField("anchor", T.LongType()),
    T.StructField("context", T.LongType()),
    T.StructField("doc_id", T.LongType()),
    T.StructField("text_hash", T.LongType()),
    T.StructField("place", T.LongType()),
])
SHARDS = T.StructType([
    T.StructField("shard", T.LongType()),
    T.StructField("doc_id", T.LongType()),
    T.StructField("text_hash", T.LongType()),
    T.StructField("place", T.LongType()),
    T.StructField("words", T.BinaryType()),  # null for a window of a split anchor, whose shard is its own hash
    T.StructField("repeated", T.BooleanType()),
])
FOUND = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text_hash", T.LongType()),
    T.StructField("place", T.LongType()),
])
RESULT = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_words", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("kept", T.StringType()),
    T.StructField("kept_sha256", T.StringType()),
])

# A place is one long: the first word of the first window, then how many windows follow on
# (16 bits: a bit for each window that counts), so places sort by their first word.
MASK_BITS = 16
RESOLVED = 1 << 14
ALL = (1 << (WINDOW - GRAM + 1)) - 1


def contexts_of(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, context hash, first window (a word position) and number of windows of every context."""
    at = window_starts(words, WINDOW)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    gram = window_hashes(hashes, tuple(range(GRAM)))
    least, where = gram[at], at.copy()
    for k in range(1, WINDOW - GRAM + 1):
        other = gram[at + k]
        less = other < least
        least = np.where(less, other, least)
        where = np.where(less, at + k, where)
    new = np.flatnonzero(np.append(True, (where[1:] != where[:-1]) | (at[1:] != at[:-1] + 1)))
    first, n = at[new], np.diff(np.append(new, len(at)))
    return least[new], sequence_hashes(hashes, first, first + n + WINDOW - 1), first, n


def _context_rows(docs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            data, offsets = column_bytes(batch.column(2))
            ids = batch.column(0).fill_null(-(1 << 63)).to_numpy()
            text_hashes = batch.column(1).to_numpy()
            for lo, hi in slices(offsets):
                words = split_words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                anchor, context, first, n = contexts_of(words, word_hashes(words))
                if not len(first):
                    continue
                doc = np.searchsorted(words.first, first, "right") - 1
                place = (first - words.first[doc]) << MASK_BITS | n
                doc_id, text_hash = ids[lo:hi][doc], text_hashes[lo:hi][doc]
                order = np.lexsort((place, text_hash, doc_id, context, anchor))
                a, c = anchor[order], context[order]
                again = np.append(False, (a[1:] == a[:-1]) & (c[1:] == c[:-1]))
                same_place = np.append(False, (doc_id[order][1:] == doc_id[order][:-1]) & (text_hash[order][1:] == text_hash[order][:-1]) & (place[order][1:] == place[order][:-1]))
                # The first of equal contexts goes on; rows of one document and place are one.
                order, again = order[~(again & same_place)], again[~(again & same_place)]
                place = place[order] | np.where(again, RESOLVED, 0)
                # Resolved rows only pass through: they are dealt by their place, not by the anchor.
                to = np.where(again, sequence_hashes(place.astype(np.uint64) ^ anchor[order], np.arange(len(order)), np.arange(len(order)) + 1), anchor[order])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to.astype(np.int64)), pa.array(context[order].astype(np.int64)), pa.array(doc_id[order]), pa.array(text_hash[order]), pa.array(place)],
                    names=CONTEXTS.names,
                )

    return docs.select("doc_id", "text_hash", "text").mapInArrow(run, CONTEXTS)


class SuffixAutomaton:
    """The suffix automaton of several word sequences (one root, no match across sequences)."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, link: int, step: dict[int, int]) -> int:
        self.next.append(step)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, q: int, w: int) -> int:
        """The state of the sequences of ``q`` no longer than one step from ``p``."""
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def add(self, sequence: list[int]) -> None:
        last = 0
        for w in sequence:
            q = self.next[last].get(w)
            if q is not None:  # known from an earlier sequence
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, q, w)
                continue
            now, p = self._state(self.length[last] + 1, 0, {}), last
            while p >= 0 and w not in self.next[p]:
                self.next[p][w] = now
                p = self.link[p]
            if p >= 0:
                q = self.next[p][w]
                self.link[now] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
            last = now

    def matching_lengths(self, sequence: list[int]) -> list[int]:
        """For each word, the length of the longest run ending there that some added sequence holds."""
        state = size = 0
        out = []
        for w in sequence:
            while state and w not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if w in self.next[state]:
                state = self.next[state][w]
                size += 1
            out.append(size)
        return out


def _shard_rows(docs: DataFrame, places: DataFrame) -> DataFrame:
    """The contexts that shards need, cut out of their documents as word hashes, and the windows of split anchors."""
    lists = places.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("anchor", "place", "split")).alias("places"))
    both = docs.join(lists, (docs.doc_id.eqNullSafe(lists.doc_id)) & (docs.text_hash == lists.text_hash)).select(lists.doc_id, lists.text_hash, "text", "places")

    def run(batches):
        for batch in batches:
            data, offsets = column_bytes(batch.column(2))
            wanted = batch.column(3)
            held, starts = wanted.flatten(), np.append(0, np.cumsum(wanted.value_lengths().to_numpy()))
            anchors, place, split = (held.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            ids, text_hashes = batch.column(0).fill_null(-(1 << 63)).to_numpy(), batch.column(1).to_numpy()

            def rows(shard, row, where, words, repeated):
                at = pa.array(row)
                return pa.RecordBatch.from_arrays([pa.array(shard), batch.column(0).take(at), batch.column(1).take(at), pa.array(where), words, pa.array(repeated)], names=SHARDS.names)

            for lo, hi in slices(offsets):
                words = split_words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                hashes = word_hashes(words)
                doc = np.repeat(np.arange(hi - lo), np.diff(starts[lo : hi + 1]))
                a, p, s = (x[starts[lo] : starts[hi]] for x in (anchors, place, split))
                first, n = words.first[doc] + (p >> MASK_BITS), p & (RESOLVED - 1)
                s = s.astype(bool)
                if not s.all():
                    begin, size = first[~s], n[~s] + WINDOW - 1
                    flat = hashes[ranges(begin, size)]
                    cuts = pa.array(np.append(0, np.cumsum(size)) * 8, pa.int32())
                    sequences = pa.Array.from_buffers(pa.binary(), len(begin), [None, cuts.buffers()[1], pa.py_buffer(flat.tobytes())])
                    yield rows(a[~s], doc[~s] + lo, p[~s], sequences, np.zeros(len(begin), bool))
                if s.any():
                    row = np.repeat(np.flatnonzero(s), n[s])
                    step = ranges(np.zeros(int(s.sum()), np.int64), n[s])
                    begin, where, of = first[row] + step, ((p[row] >> MASK_BITS) + step) << MASK_BITS | 1, doc[row] + lo
                    window = sequence_hashes(hashes, begin, begin + WINDOW).astype(np.int64)
                    # The first of equal windows goes on; the others are repeats.
                    order = np.lexsort((where, text_hashes[of], ids[of], window))
                    again = np.append(False, window[order][1:] == window[order][:-1])
                    same_place = np.append(False, np.all([x[order][1:] == x[order][:-1] for x in (ids[of], text_hashes[of], where)], axis=0))
                    order, again = order[~(again & same_place)], again[~(again & same_place)]
                    yield rows(window[order], of[order], where[order], pa.nulls(len(order), pa.binary()), again)

    return both.mapInArrow(run, SHARDS)


def _match_windows(windows: DataFrame) -> DataFrame:
    """Places of windows that some place before them holds, by hash."""
    place = F.struct("doc_id", "text_hash", "place")
    firsts = windows.groupBy("shard").agg(F.min(place).alias("first"))
    return windows.join(firsts, "shard").where(place != F.col("first")).select(*FOUND.names)


def _match_shards(shards: DataFrame) -> DataFrame:
    """Places whose mask marks the windows that start earlier, one shard after the other."""

    def run(batches):
        automaton, shard, before = SuffixAutomaton(), None, None
        mask = 0
        for batch in batches:
            rows: list[tuple] = []
            for s, d, t, p, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if s != shard:
                    automaton, shard, before = None, s, None
                if (d, t, p) != before:  # rows of one document and place are one
                    sequence = np.frombuffer(raw, np.int64).tolist()
                    if automaton is None:  # the first context has nothing before it
                        automaton, mask = SuffixAutomaton(), 0
                    else:
                        lengths = automaton.matching_lengths(sequence)[WINDOW - 1 :]
                        mask = sum(1 << k for k, size in enumerate(lengths) if size >= WINDOW)
                    automaton.add(sequence)
                    before = d, t, p
                    if mask:
                        rows.append((d, t, p >> MASK_BITS << MASK_BITS | mask))
            if rows:
                d, t, p = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(t, pa.int64()), pa.array(p, pa.int64())], names=FOUND.names)

    # All contexts of a shard in one task, in the order of their places.
    return shards.repartition("shard").sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "text_hash", "place").mapInArrow(run, FOUND)


def _remove(docs: DataFrame, found: DataFrame, texts: bool) -> DataFrame:
    lists = found.groupBy("doc_id", "text_hash").agg(F.collect_list("place").alias("places"))
    both = docs.join(lists, (docs.doc_id.eqNullSafe(lists.doc_id)) & (docs.text_hash == lists.text_hash), "left").select(docs.doc_id, "text", "places")

    def run(batches):
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            lists = batch.column(2)
            places, starts = lists.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))).astype(np.int64)
            for lo, hi in slices(offsets):
                words = split_words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                own = places[starts[lo] : starts[hi]].astype(np.int64)
                doc = np.repeat(np.arange(hi - lo), np.diff(starts[lo : hi + 1]))
                bit = np.arange(MASK_BITS)
                row, k = np.nonzero(own[:, None] >> bit & 1)
                begin = words.first[doc[row]] + (own[row] >> MASK_BITS) + k
                over = np.bincount(begin, minlength=len(words.start) + WINDOW + 1) - np.bincount(begin + WINDOW, minlength=len(words.start) + WINDOW + 1)
                keep = np.flatnonzero(np.cumsum(over[: len(words.start)]) == 0) if len(begin) else np.arange(len(words.start))
                size = words.end[keep] - words.start[keep] + 1
                flat = np.append(words.data, np.uint8(32))[ranges(words.start[keep], size)]
                flat[np.cumsum(size) - 1] = 32
                first = np.searchsorted(keep, words.first)
                cut = np.append(0, np.cumsum(size))[first]
                raw = flat.tobytes()
                kept = [raw[a : b - 1] if b > a else b"" for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
                total = words.counts()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo), pa.array(total), pa.array(total - np.diff(first)),
                        pa.array([k.decode() for k in kept] if texts else [None] * len(kept), pa.string()), pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
                    ],
                    names=RESULT.names,
                )

    return both.mapInArrow(run, RESULT)


def remove_repeats(docs: DataFrame, texts: bool = True) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, ``kept`` (the words that stay, joined by one
    space; null without ``texts``) and kept_sha256 of its UTF-8."""
    docs = doc_texts(docs).withColumn("text_hash", F.xxhash64("text"))
    by_anchor = _context_rows(docs).repartition("anchor")
    first = Window.partitionBy("anchor", "context").orderBy("doc_id", "text_hash", "place")
    ranked = by_anchor.withColumn("rank", F.rank().over(first))
    ranked = ranked.withColumn("distinct", F.sum(F.when(F.col("rank") == 1, 1).otherwise(0)).over(Window.partitionBy("anchor")))
    resolved = F.col("place").bitwiseAND(RESOLVED) != 0
    repeated = (resolved | (F.col("rank") > 1)).alias("repeated")
    ids = F.when(F.col("doc_id") != -(1 << 63), F.col("doc_id")).alias("doc_id")
    hits = ranked.where(repeated | (F.col("distinct") > 1)).select("anchor", ids, "text_hash", F.col("place").bitwiseAND(~RESOLVED).alias("place"), repeated, (F.col("distinct") > SHARD_CONTEXTS).alias("split"))
    hits = written(hits, "repeated-contexts")
    rows = written(_shard_rows(docs, hits.where("not repeated")), "shard-contexts")
    matched = _match_shards(rows.where("words is not null").drop("repeated"))
    windows = rows.where("words is null")
    settled = windows.where("repeated").select(*FOUND.names).unionByName(_match_windows(windows.where("not repeated")))
    n = F.col("place").bitwiseAND(RESOLVED - 1)
    whole = (F.col("place") - n).bitwiseOR(F.expr("shiftleft(1L, cast(place & %d as int)) - 1" % (RESOLVED - 1)))
    return _remove(docs, hits.where("repeated").select("doc_id", "text_hash", whole.alias("place")).unionByName(matched).unionByName(settled), texts)
