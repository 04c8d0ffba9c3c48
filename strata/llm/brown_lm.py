"""Language-model scoring by Brown class-based bigrams.

Tokens are the words of the text with A-Z in lower case, then one end. The
``CLASS_WORDS`` most frequent training words are put into ``CLASSES`` classes
by exchange clustering: each word in turn moves to the class that gives the
class bigrams the highest likelihood, until a sweep moves none. The other
words share one class, and the end has its own. The probability of a token is
P(its class | class before it) * P(token | its class); the class before the
first token is the end's.

* Transitions interpolate class bigrams with class frequencies.
* A clustered word's emission is its share of its class.
* Another word's emission is (c + 0.5) / (n + 0.5 * (v + 1)) over the n tokens
  and v words of the shared class, so unseen words have a share.

With ``every_word`` no training word is left in the shared class. Each other
word joins the class that gains the most likelihood from the word's pairs,
where its neighbours count by their classes so far. Then class bigrams are
counted anew over all tokens, and every word's emission is (c + 0.5) /
(n + 0.5 * (v + 1)) over its class, whose last half is for unseen words: one
of them has the sum over all classes, and class frequencies hold after it.

Counts cover all training texts. Word counts are summed by Spark. The counts
of the ``COMMON_WORDS`` most frequent words, a fixed number, are broadcast;
all other words meet their counts in a join, where none of them can be hot.
Pairs of clustered words, at most (``CLASS_WORDS`` + 2) squared, come to the
driver for clustering whatever the corpus's size. With ``every_word``, counts of (word,
neighbour's class) are dealt by word, words out of the broadcast meet their
class and count in the join, and texts are written as one byte of class a token.

Cases: a null or empty text is one end; a null id counts as the empty text for
the split; repeated rows, also of one id, are scored each (a row is told apart
by its place in its partition, so the input must read back in the same order);
words are told apart by a 64-bit hash; extra columns are ignored; an empty
table gives an empty result; with no training text every base count is 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.tables import doc_texts, written
from strata.llm.text import column_bytes, range_hashes, slices, split_words, word_hashes

COMMON_WORDS = 100_000
CLASS_WORDS = 1000
CLASSES = 48
SWEEPS = 12
#: Weight of class bigrams against class frequencies.
BIGRAM_WEIGHT = 0.95
#: Distinct words that a task holds before it passes their counts on.
HELD_WORDS = 1_000_000
#: Tokens of classed texts worked on at once; a longer text is worked on alone.
TOKENS = 1 << 18
_END_BYTES = np.frombuffer(b"\n", np.uint8)
#: The end's place among words: the hash of a separator, which no word can be.
END = int(range_hashes(_END_BYTES, np.array([0]), np.array([1]))[0].astype(np.int64))


def crc_remainder(doc_id: str, by: int) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % by


def _slices(batch: pa.RecordBatch, column: int):
    """Words of bounded slices of a batch: first row, words, hashes."""
    data, offsets = column_bytes(batch.column(column))
    for lo, hi in slices(offsets):
        words = split_words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], lower=True)
        yield lo, words, word_hashes(words).astype(np.int64)


# ---------------------------------------------------------------- counts

def word_counts(train: DataFrame) -> DataFrame:
    """``word`` (hash) and ``n`` of all training tokens, ends included."""
    schema = T.StructType([T.StructField("word", T.LongType()), T.StructField("n", T.LongType())])

    def run(batches):
        words, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def out():
            return pa.RecordBatch.from_arrays([pa.array(words), pa.array(counts)], names=schema.names)

        for batch in batches:
            ends = batch.num_rows
            for _, _, hashes in _slices(batch, 1):
                w, n = np.unique(hashes, return_counts=True)
                all_, inverse = np.unique(np.concatenate([words, w]), return_inverse=True)
                words, counts = all_, np.bincount(inverse.ravel(), np.concatenate([counts, n]), len(all_)).astype(np.int64)
                if len(words) > HELD_WORDS:
                    yield out()
                    words, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([END]), pa.array([ends])], names=schema.names)
        if len(words):
            yield out()

    return train.mapInArrow(run, schema).groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """The most frequent words, sorted by hash, with their counts; ``slot`` is the
    place of a clustered word, ``size`` for any other, ``size + 1`` for the end."""

    def __init__(self, words: np.ndarray, counts: np.ndarray):
        self.size = min(CLASS_WORDS, len(words))
        rank = np.empty(len(words), np.int64)
        rank[np.lexsort((words, -counts))] = np.arange(len(words))
        order = np.argsort(words)
        self.words, self.counts = words[order], counts[order]
        self.slot = np.minimum(rank[order], self.size)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each word's place (or 0) and whether it is here."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return at, self.words[at] == hashes

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        at, known = self.find(hashes)
        return np.where(known, self.slot[at] if len(self.slot) else 0, self.size)


def with_ends(values: np.ndarray, first: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The values of consecutive texts with ``end`` after each text, and the values before them."""
    now = np.insert(values, first[1:], end)
    return now, np.append(end, now[:-1])


def pair_counts(train: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """How often each slot follows each slot in the training texts (the end also before the first word)."""
    side = vocabulary.size + 2
    held = train.sparkSession.sparkContext.broadcast(vocabulary)
    schema = T.StructType([T.StructField("pair", T.LongType()), T.StructField("n", T.LongType())])

    def run(batches):
        total = np.zeros(side * side, np.int64)
        for batch in batches:
            for _, words, hashes in _slices(batch, 1):
                now, before = with_ends(held.value.slots(hashes), words.first, side - 1)
                total += np.bincount(before * side + now, minlength=side * side)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=schema.names)

    out = np.zeros(side * side, np.int64)
    found = train.mapInArrow(run, schema).groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out[found["pair"].to_numpy()] = found["n"].to_numpy()
    return out.reshape(side, side)


def common_words(counts: DataFrame) -> Vocabulary:
    """The most frequent words, ``COMMON_WORDS`` at most: those of the highest bins of a
    logarithmic histogram of counts (a few thousand bins at most), so no task sorts all words."""
    bins = counts.where(F.col("word") != END).withColumn("bin", F.floor(F.log2("n") * 64).cast("int"))
    cut, held = None, 0
    for r in sorted(bins.groupBy("bin").count().collect(), reverse=True):
        held += r["count"]
        if held > COMMON_WORDS:
            break
        cut = r["bin"]
    found = bins.where(F.lit(False) if cut is None else F.col("bin") >= cut).select("word", "n").toArrow()
    return Vocabulary(found["word"].to_numpy(), found["n"].to_numpy())


# ---------------------------------------------------------------- classes

def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange_clusters(pairs: np.ndarray, n_classes: int, sweeps: int = SWEEPS) -> np.ndarray:
    """The class of each slot. The last two slots (other words, the end) keep classes of their own."""
    size = len(pairs) - 2
    n_classes = max(1, min(n_classes, size))
    of = np.append(np.arange(size) % n_classes, [n_classes, n_classes + 1])
    table = class_pairs(pairs, of).astype(float)
    every = n_classes + 2
    for _ in range(sweeps):
        moved = 0
        for w in range(size):
            a, own = of[w], float(pairs[w, w])
            after = np.bincount(of, pairs[w], every)
            before = np.bincount(of, pairs[:, w], every)
            after[a] -= own
            before[a] -= own
            table[a] -= after
            table[:, a] -= before
            table[a, a] -= own
            # Tokens of each class without w, whose pairs with w stay.
            left, right = table.sum(1) + before, table.sum(0) + after
            base = _xlogx(table)
            diagonal = np.diagonal(table)
            gain = (_xlogx(table + after) - base).sum(1) + (_xlogx(table + before[:, None]) - base).sum(0)
            gain += _xlogx(diagonal + after + before + own) + _xlogx(diagonal) - _xlogx(diagonal + after) - _xlogx(diagonal + before)
            gain -= _xlogx(left + after.sum() + own) - _xlogx(left) + _xlogx(right + before.sum() + own) - _xlogx(right)
            best = int(np.argmax(gain[:n_classes]))
            if gain[best] <= gain[a] + 1e-6:
                best = a
            moved += best != a
            of[w] = best
            table[best] += after
            table[:, best] += before
            table[best, best] += own
        if not moved:
            break
    return of


def class_pairs(pairs: np.ndarray, of: np.ndarray) -> np.ndarray:
    n = of.max() + 1
    out = np.zeros((n, n), np.int64)
    np.add.at(out, (of[:, None], of[None, :]), pairs)
    return out


class ClassModel:
    """Log10 probabilities of transitions between slots' classes and of clustered words in their classes."""

    def __init__(self, pairs: np.ndarray, n_tokens: int, n_words: int):
        self.of = exchange_clusters(pairs, CLASSES)
        table = class_pairs(pairs, self.of).astype(float)
        n = len(table)
        share = (table.sum(0) + 0.5) / (table.sum() + 0.5 * n)
        row = table.sum(1, keepdims=True)
        follow = np.where(row > 0, table / np.maximum(row, 1), share)
        self.transition = np.log10(BIGRAM_WEIGHT * follow + (1 - BIGRAM_WEIGHT) * share)
        seen = pairs.sum(0).astype(float)  # every token follows one
        with np.errstate(divide="ignore", invalid="ignore"):
            self.emission = np.log10(seen / np.bincount(self.of, seen)[self.of])
        self.emission[-2:] = 0.0  # the others' emissions come from their counts; the end is alone
        self.other_total = np.log10(seen[-2] + 0.5 * (n_words - (len(pairs) - 2) - (1 if n_tokens else 0) + 1))


# ---------------------------------------------------------------- classes of all words

CONTEXTS = T.StructType([T.StructField(c, T.LongType()) for c in ("word", "code", "n")])
WORD_CLASSES = T.StructType([T.StructField(c, T.LongType()) for c in ("word", "n", "class")])
#: Words whose gains are computed at once.
GAIN_WORDS = 4096


def _combined(words: np.ndarray, codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts summed for equal words and codes, in the order of words."""
    if not len(words):
        return words, codes, counts
    ids, at = np.unique(words, return_inverse=True)
    span = int(codes.max()) + 1
    keys = at.ravel() * span + codes
    order = np.argsort(keys)
    keys = keys[order]
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return ids[keys[new] // span], keys[new] % span, np.add.reduceat(counts[order], new)


def contexts(train: DataFrame, vocabulary: Vocabulary, of: np.ndarray) -> DataFrame:
    """For each word out of the clusters, how often each class follows it (``code`` is the class)
    and precedes it (``code`` is the class and the number of classes); partial counts."""
    held = train.sparkSession.sparkContext.broadcast((vocabulary, of))

    def run(batches):
        vocabulary, of = held.value
        every = int(of.max()) + 1
        parts, size = [], 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array(c) for c in _combined(*map(np.concatenate, zip(*parts)))], names=CONTEXTS.names)

        for batch in batches:
            for _, words, hashes in _slices(batch, 1):
                slots = vocabulary.slots(hashes)
                now, before = with_ends(of[slots], words.first, every - 1)
                after = np.append(now[1:], every - 1)
                at = np.arange(len(hashes)) + words.doc()  # places among words and ends
                rare = np.flatnonzero(slots == vocabulary.size)
                if len(rare):
                    w = np.tile(hashes[rare], 2)
                    codes = np.concatenate([after[at[rare]], every + before[at[rare]]])
                    parts.append(_combined(w, codes, np.ones(len(w), np.int64)))
                    size += len(parts[-1][0])
                if size > HELD_WORDS:
                    yield out()
                    parts, size = [], 0
        if parts:
            yield out()

    return train.mapInArrow(run, CONTEXTS)


def best_classes(word: np.ndarray, code: np.ndarray, n: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The class that each word 0, 1, ... joins with the highest gain, given its counts by code and the table of class pairs."""
    every, size = len(table), int(word.max()) + 1
    n_classes = every - 2
    sides = np.zeros((size, 2 * every))
    np.add.at(sides, (word, code), n)
    after, before = sides[:, :n_classes], sides[:, every : every + n_classes]
    cells = np.concatenate([table[:n_classes].T, table[:, :n_classes]])  # a row for each code
    known = cells[code]
    gain = np.zeros((size, n_classes))
    steps = _xlogx(known + n[:, None]) - _xlogx(known)
    order = np.argsort(word, kind="stable")
    first = np.searchsorted(word[order], np.arange(size))
    gain += np.add.reduceat(steps[order], first)
    diagonal = np.diagonal(table)[:n_classes]
    gain += _xlogx(diagonal + after + before) + _xlogx(diagonal) - _xlogx(diagonal + after) - _xlogx(diagonal + before)
    left, right = table.sum(1)[:n_classes], table.sum(0)[:n_classes]
    follow, lead = sides[:, :every].sum(1)[:, None], sides[:, every:].sum(1)[:, None]
    gain -= _xlogx(left + follow) - _xlogx(left) + _xlogx(right + lead) - _xlogx(right)
    return np.argmax(np.round(gain, 9), axis=1)


def word_classes(found: DataFrame, table: np.ndarray) -> DataFrame:
    """``word``, ``n`` and ``class`` of each word out of the clusters."""
    held = found.sparkSession.sparkContext.broadcast(table.astype(float))

    def out(words, codes, counts):
        table = held.value
        words, codes, counts = _combined(words, codes, counts)
        ids, at = np.unique(words, return_index=True)
        cut = np.append(at, len(words))
        for lo in range(0, len(ids), GAIN_WORDS):
            hi = min(lo + GAIN_WORDS, len(ids))
            part = slice(cut[lo], cut[hi])
            word = np.repeat(np.arange(hi - lo), np.diff(cut[lo : hi + 1]))
            best = best_classes(word, codes[part], counts[part], table)
            n = np.bincount(word, np.where(codes[part] < len(table), counts[part], 0), hi - lo).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids[lo:hi]), pa.array(n), pa.array(best.astype(np.int64))], names=WORD_CLASSES.names)

    def run(batches):
        rest = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            rest = [np.concatenate([r, c.to_numpy(zero_copy_only=False)]) for r, c in zip(rest, batch.columns)]
            whole = int(np.searchsorted(rest[0], rest[0][-1])) if len(rest[0]) else 0  # the last word may go on
            if whole:
                yield from out(*[r[:whole] for r in rest])
                rest = [r[whole:] for r in rest]
        if len(rest[0]):
            yield from out(*rest)

    return found.repartition("word").sortWithinPartitions("word").mapInArrow(run, WORD_CLASSES)


SEQUENCES = T.StructType([
    T.StructField("row", T.LongType()),
    T.StructField("doc_id", T.LongType()),
    T.StructField("word", T.LongType()),
    T.StructField("places", T.BinaryType()),
    T.StructField("classes", T.BinaryType()),
    T.StructField("n_known", T.LongType()),
    T.StructField("log_counts", T.DoubleType()),
])
CLASSED = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("classes", T.BinaryType()),
    T.StructField("n_known", T.LongType()),
    T.StructField("log_counts", T.DoubleType()),
])


def _binary(data: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Binary values: value i is ``data`` from ``edges[i]`` to ``edges[i + 1]``."""
    buffers = [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, buffers)


def _class_rows(docs: DataFrame, vocabulary: Vocabulary, classes: np.ndarray, unseen: int, ends: int) -> DataFrame:
    """For each text one row with the classes of its common words and ends, a byte a token, and a row for each of its other words."""
    held = docs.sparkSession.sparkContext.broadcast((vocabulary, classes.astype(np.uint8)))

    def run(batches):
        vocabulary, classes = held.value
        logs = np.log10(vocabulary.counts + 0.5)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            keys = batch.column(0)
            for lo, words, hashes in _slices(batch, 1):
                n = len(words.first) - 1
                doc, per = words.doc(), words.counts()
                at, known = vocabulary.find(hashes)
                now, _ = with_ends(np.where(known, classes[at] if len(logs) else 0, unseen).astype(np.uint8), words.first, unseen + 1)
                edges = words.first + np.arange(n + 1)
                texts = _binary(now, edges)
                log = np.bincount(doc, np.where(known, logs[at] if len(logs) else 0.0, 0.0), n) + (np.log10(ends + 0.5) if ends else 0.0)
                rows = row + np.arange(n)
                here = keys.slice(lo, n)
                n_known = np.bincount(doc, known, n).astype(np.int64) + (ends > 0)
                # A text's own row goes where its number sends it, not to one place.
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows), here, pa.array(rows), pa.nulls(n, pa.binary()), texts, pa.array(n_known), pa.array(log)], names=SEQUENCES.names
                )
                rare = np.flatnonzero(~known)
                if len(rare):
                    order = rare[np.lexsort((rare, hashes[rare], doc[rare]))]
                    d, h = doc[order], hashes[order]
                    new = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (h[1:] != h[:-1])))
                    inner = (order - words.first[d]).astype(np.int32)
                    m = len(new)
                    places = _binary(inner.view(np.uint8), 4 * np.append(new, len(order)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows[d[new]]), here.take(pa.array(d[new])), pa.array(h[new]), places, pa.nulls(m, pa.binary()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.float64())],
                        names=SEQUENCES.names,
                    )
                row += n

    return doc_texts(docs).mapInArrow(run, SEQUENCES)


def classed_texts(docs: DataFrame, vocabulary: Vocabulary, classes: np.ndarray, others: DataFrame, unseen: int, ends: int) -> DataFrame:
    """Each text's classes, a byte a token (``unseen`` for a word without one, the next for the end), the
    number of its known tokens and the sum of their log10 (count + 0.5)."""
    rows = _class_rows(docs, vocabulary, classes, unseen, ends).join(others.select("word", F.col("n").alias("c"), "class"), "word", "left")
    own = F.col("classes").isNotNull()
    met = F.when(~own & F.col("class").isNotNull(), F.struct("places", "c", "class"))
    texts = rows.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("classes").alias("classes"), F.max("n_known").alias("n_known"), F.max("log_counts").alias("log_counts"), F.collect_list(met).alias("met")
    )

    def run(batches):
        for batch in batches:
            doc_id, classes, n_known, log_counts, met = batch.columns
            all_, at = column_bytes(classes)
            cut, fields = met.offsets.to_numpy(), met.values.flatten()
            for lo, hi in slices(at, TOKENS):
                n, data, edges = hi - lo, all_[at[lo] : at[hi]].copy(), at[lo : hi + 1] - at[lo]
                places, c, of = (a.slice(cut[lo], cut[hi] - cut[lo]) for a in fields)
                text = np.repeat(np.arange(n), np.diff(cut[lo : hi + 1]))  # of each word met
                inner, to = column_bytes(places)
                times = np.diff(to) // 4
                data[np.repeat(edges[text], times) + inner.view(np.int32)] = np.repeat(of.to_numpy().astype(np.uint8), times)
                known = n_known.slice(lo, n).to_numpy() + np.bincount(text, times, n).astype(np.int64)
                log = log_counts.slice(lo, n).to_numpy() + np.bincount(text, times * np.log10(c.to_numpy() + 0.5), n)
                yield pa.RecordBatch.from_arrays([doc_id.slice(lo, n), _binary(data, edges), pa.array(known), pa.array(log)], names=CLASSED.names)

    return texts.select("doc_id", "classes", "n_known", "log_counts", "met").mapInArrow(run, CLASSED)


def _class_steps(column: pa.Array, end: int):
    """Of bounded slices of texts the first text and, of all tokens, the class, the class before and the text in the slice."""
    data, edges = column_bytes(column)
    for lo, hi in slices(edges, TOKENS):
        now = data[edges[lo] : edges[hi]].astype(np.int64)
        # Every text ends with the end, which is also what its first token follows.
        yield lo, now, np.append(end, now[:-1])[: len(now)], np.repeat(np.arange(hi - lo), np.diff(edges[lo : hi + 1]))


def sequence_pairs(texts: DataFrame, side: int) -> np.ndarray:
    """How often each class follows each class."""
    schema = T.StructType([T.StructField("pair", T.LongType()), T.StructField("n", T.LongType())])

    def run(batches):
        total = np.zeros(side * side, np.int64)
        for batch in batches:
            for _, now, before, _ in _class_steps(batch.column(0), side - 1):
                total += np.bincount(before * side + now, minlength=side * side)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=schema.names)

    out = np.zeros(side * side, np.int64)
    found = texts.select("classes").mapInArrow(run, schema).groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out[found["pair"].to_numpy()] = found["n"].to_numpy()
    return out.reshape(side, side)


def class_steps(table: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Log10 of each class's probability after each class, over its emissions' denominator; in the
    column of unseen words (the last but one) the probability of one of them."""
    n = len(table)
    real = np.append(np.flatnonzero(kinds), n - 1)  # classes that have words, and the end
    seen = table.sum(0).astype(float)
    share = np.zeros(n)
    share[real] = (seen[real] + 0.5) / (seen[real].sum() + 0.5 * len(real))
    row = table.sum(1, keepdims=True)
    follow = np.where(row > 0, table / np.maximum(row, 1), share)
    chance = BIGRAM_WEIGHT * follow + (1 - BIGRAM_WEIGHT) * share
    over = seen[: n - 2] + 0.5 * (kinds + 1)
    steps = np.zeros((n, n))
    with np.errstate(divide="ignore"):
        steps[:, : n - 2] = np.log10(chance[:, : n - 2] / over)
        steps[:, n - 2] = np.log10((chance[:, : n - 2] * 0.5 / over).sum(1)) if kinds.any() else np.log10(0.5 * share[n - 1])
        steps[:, n - 1] = np.log10(chance[:, n - 1])
    return steps


def _sequence_scores(texts: DataFrame, steps: np.ndarray, ends: int) -> DataFrame:
    schema = T.StructType([*CLASSED.fields[:1], T.StructField("n_tokens", T.LongType()), *CLASSED.fields[2:], T.StructField("n_unknown", T.LongType()), T.StructField("steps", T.DoubleType())])
    held = texts.sparkSession.sparkContext.broadcast(steps)
    # An end's count is in log_counts for the unigrams; the classes have no emission for it.
    end_log = float(np.log10(ends + 0.5)) if ends else 0.0

    def run(batches):
        steps = held.value
        for batch in batches:
            doc_id, classes, known, log = batch.columns
            n = batch.num_rows
            tokens, total = np.zeros(n, np.int64), log.to_numpy(zero_copy_only=False) - end_log
            for lo, now, before, text in _class_steps(classes, len(steps) - 1):
                part = slice(lo, lo + int(text[-1]) + 1)  # every text has its end
                tokens[part] = np.bincount(text)
                total[part] += np.bincount(text, steps[before, now])
            unknown = tokens - known.to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([doc_id, pa.array(tokens), known, log, pa.array(unknown), pa.array(total)], names=schema.names)

    return texts.mapInArrow(run, schema)


def _score_every_word(docs: DataFrame, train: DataFrame, counts: DataFrame, total, folds: int, held_out: int) -> DataFrame:
    n_tokens, n_words, ends = total["n"], total["v"], total["e"]
    vocabulary = common_words(counts)
    pairs = pair_counts(train, vocabulary)
    of = exchange_clusters(pairs, CLASSES)
    table = class_pairs(pairs, of)
    side = len(table)
    others = written(word_classes(contexts(train, vocabulary, of), table), "word-classes")
    # The classes of common words: of the clustered ones here, of the others (all that are as frequent) from the table.
    classes = of[vocabulary.slot]
    least = int(vocabulary.counts.min()) if len(vocabulary.counts) else 0
    found = others.where(F.col("n") >= least).select("word", "class").toArrow() if least else None
    if found is not None:
        at, known = vocabulary.find(found["word"].to_numpy())
        classes[at[known]] = found["class"].to_numpy()[known]
    texts = written(classed_texts(docs, vocabulary, classes, others, side - 2, ends), "classed-texts")
    kinds = np.bincount(of[: vocabulary.size], minlength=side - 2)[: side - 2] if vocabulary.size else np.zeros(side - 2, np.int64)
    for r in others.groupBy("class").count().collect():
        kinds[r["class"]] += r["count"]
    in_train = texts.where(crc_remainder("doc_id", folds) != held_out)
    steps = class_steps(sequence_pairs(in_train, side), kinds)
    scored = _sequence_scores(texts, steps, ends)
    return scored.select(
        "doc_id",
        (crc_remainder("doc_id", folds) == held_out).alias("held_out"),
        "n_tokens", "n_known",
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") + F.col("n_unknown") * float(np.log10(0.5)) - F.col("n_tokens") * float(np.log10(n_tokens + 0.5 * (n_words + 1)))).alias("base_score"),
        F.col("steps").alias("score"),
    )


# ---------------------------------------------------------------- scores

PARTS = T.StructType([
    T.StructField("n_tokens", T.LongType()),
    T.StructField("n_known", T.LongType()),
    T.StructField("n_other", T.LongType()),
    T.StructField("log_counts", T.DoubleType()),
    T.StructField("log_other", T.DoubleType()),
    T.StructField("log_classes", T.DoubleType()),
])
ROWS = T.StructType([
    T.StructField("row", T.LongType()),
    T.StructField("doc_id", T.LongType()),
    T.StructField("word", T.LongType()),
    T.StructField("n", T.LongType()),
    T.StructField("parts", PARTS),
])


def _score_rows(docs: DataFrame, vocabulary: Vocabulary, model: ClassModel, ends: int) -> DataFrame:
    """For each text one row of ``parts`` from common words, and a row for each of its other words."""
    held = docs.sparkSession.sparkContext.broadcast((vocabulary, model))
    to_arrow = pa.struct([(f.name, pa.int64() if isinstance(f.dataType, T.LongType) else pa.float64()) for f in PARTS.fields])

    def run(batches):
        vocabulary, model = held.value
        logs = np.log10(vocabulary.counts + 0.5)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            keys = batch.column(0)
            for lo, words, hashes in _slices(batch, 1):
                n = len(words.first) - 1
                doc, per = words.doc(), words.counts()
                at, known = vocabulary.find(hashes)
                slot = np.where(known, vocabulary.slot[at] if len(logs) else 0, vocabulary.size)
                other = slot == vocabulary.size
                now, before = with_ends(slot, words.first, vocabulary.size + 1)
                steps = model.transition[model.of[before], model.of[now]] + model.emission[now]
                ends_at = np.repeat(np.arange(n), per + 1)
                log = np.where(known, logs[at] if len(logs) else 0.0, 0.0)
                parts = [
                    per + 1, np.bincount(doc, known, n) + (ends > 0), np.bincount(doc, other, n),
                    np.bincount(doc, log, n) + np.log10(ends + 0.5), np.bincount(doc, log * other, n), np.bincount(ends_at, steps, n),
                ]
                parts = pa.StructArray.from_arrays([pa.array(p.astype(np.int64 if k < 3 else np.float64)) for k, p in enumerate(parts)], fields=list(to_arrow))
                rows = row + np.arange(n)
                here = keys.slice(lo, n)
                # A text's own row goes where its number sends it, not to one place.
                yield pa.RecordBatch.from_arrays([pa.array(rows), here, pa.array(rows), pa.array(np.zeros(n, np.int64)), parts], names=ROWS.names)
                rare = np.flatnonzero(~known)
                if len(rare):
                    order = rare[np.lexsort((hashes[rare], doc[rare]))]
                    d, h = doc[order], hashes[order]
                    new = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (h[1:] != h[:-1])))
                    count = np.diff(np.append(new, len(order)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows[d[new]]), here.take(pa.array(d[new])), pa.array(h[new]), pa.array(count), pa.nulls(len(new), to_arrow)], names=ROWS.names
                    )
                row += n

    return doc_texts(docs).mapInArrow(run, ROWS)


def score(docs: DataFrame, folds: int = 5, held_out: int = 1, every_word: bool = False) -> DataFrame:
    """Learn from the rows whose fold is not ``held_out`` and score all rows. ``every_word`` gives
    all training words a class, not the ``CLASS_WORDS`` most frequent alone.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (unigrams) and
    score (the class model), both sums of log10 probabilities.
    """
    train = doc_texts(docs).where(crc_remainder("doc_id", folds) != held_out)
    counts = written(word_counts(train), "word-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v"), F.coalesce(F.max(F.when(F.col("word") == END, F.col("n"))), F.lit(0)).alias("e")).first()
    n_tokens, n_words, ends = total["n"], total["v"], total["e"]
    if every_word:
        return _score_every_word(docs, train, counts, total, folds, held_out)
    vocabulary = common_words(counts)
    model = ClassModel(pair_counts(train, vocabulary), n_tokens, n_words)

    rows = _score_rows(docs, vocabulary, model, ends)
    seen = rows.join(counts.withColumnRenamed("n", "c"), "word", "left")
    own = F.col("parts").isNotNull()
    log = F.when(own, F.lit(0.0)).otherwise(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5))
    part = lambda name: F.sum(F.col(f"parts.{name}"))
    sums = seen.groupBy("row", "doc_id").agg(
        part("n_tokens").alias("n_tokens"),
        (part("n_known") + F.sum(F.when(~own & (F.col("c") > 0), F.col("n")).otherwise(F.lit(0)))).alias("n_known"),
        (part("log_counts") + F.sum(log)).alias("log_counts"),
        (part("log_classes") + part("log_other") + F.sum(log) - part("n_other") * F.lit(float(model.other_total))).alias("score"),
    )
    return sums.select(
        "doc_id",
        (crc_remainder("doc_id", folds) == held_out).alias("held_out"),
        "n_tokens", "n_known",
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") - F.col("n_tokens") * float(np.log10(n_tokens + 0.5 * (n_words + 1)))).alias("base_score"),
        "score",
    )
