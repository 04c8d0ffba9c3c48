"""A sparse rule ensemble that scores quality.

Each text gets the ``STATISTICS``. A random forest of shallow trees is grown on
the labelled training rows; every path from a root to any node below it is a
conjunctive rule over statistics. A logistic regression with a lasso penalty
weighs the rules' truth values, and the rules that keep a weight are compiled
into one Spark column expression, the score.

Statistics are written once; forest and lasso run as Spark jobs over the
labelled part of that table, so nothing but trees and weights comes to the
driver. Their number is bounded by ``TREES`` and ``DEPTH``.

Cases: a null or empty text has zero statistics and is scored by them; rows
without a label are scored only; a null id counts as the empty text for the
split; repeated labels of one id count each; repeated documents are scored
each; extra columns are ignored; with no training rows, or rows of one label
only, every score is the training share of label 1 (one half without rows);
empty tables give an empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.brown_lm import crc_remainder
from strata.llm.tables import doc_texts, written
from strata.llm.text import column_bytes, slices, split_words, window_hashes, window_starts, word_hashes

TREES = 24
DEPTH = 3
PENALTY = 0.0005
SEED = 11
#: Bytes of each rate: counts over all bytes of the text.
BYTE_CLASSES = {
    "upper_rate": bytes(range(65, 91)),
    "digit_rate": b"0123456789",
    "symbol_rate": b"#*$%&|<>@=+_/\\^~{}[]",
    "mark_rate": b"!?;:",
    "stop_rate": b".,",
    "newline_rate": b"\n",
    "wide_rate": bytes(range(128, 256)),
}
STATISTICS = (
    "log_words", "word_bytes", "distinct_share", "top_share", "again_share", "short_share", "window_share", *BYTE_CLASSES,
)
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), *[T.StructField(s, T.DoubleType()) for s in STATISTICS]])


def _statistics(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """``STATISTICS`` of consecutive texts."""
    n = len(offsets) - 1
    words = split_words(data, offsets, lower=True)
    hashes, doc, per = word_hashes(words), words.doc(), words.counts()
    some = np.maximum(per, 1)
    size = words.end - words.start
    order = np.lexsort((hashes, doc))
    d, h = doc[order], hashes[order]
    new = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (h[1:] != h[:-1]))[: len(order)])
    counts = np.diff(np.append(new, len(order)))
    top = np.zeros(n, np.int64)
    np.maximum.at(top, d[new], counts)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    at = window_starts(words, 3)
    pairs = np.stack([doc[at].astype(np.uint64), window_hashes(hashes, (0, 1, 2))[at] if len(at) else np.zeros(0, np.uint64)], axis=1)
    order = np.lexsort((pairs[:, 1], pairs[:, 0]))
    pairs = pairs[order]
    fresh = np.append(True, (pairs[1:] != pairs[:-1]).any(1))[: len(pairs)]
    windows = np.maximum(np.bincount(doc[at], minlength=n), 1)
    out = [
        np.log1p(per), np.bincount(doc, size, n) / some, np.bincount(d[new], minlength=n) / some, top / some,
        np.bincount(doc, again, n) / some, np.bincount(doc, size <= 3, n) / some,
        np.bincount(pairs[:, 0].astype(np.int64), fresh, n) / windows,
    ]
    length = np.maximum(np.diff(offsets), 1)
    table = np.zeros(256, bool)
    for members in BYTE_CLASSES.values():
        table[:] = False
        table[list(members)] = True
        upto = np.append(0, np.cumsum(table[data], dtype=np.int64))
        out.append((upto[offsets[1:]] - upto[offsets[:-1]]) / length)
    return out


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the ``STATISTICS`` of every text."""

    def run(batches):
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            for lo, hi in slices(offsets):
                cols = _statistics(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *[pa.array(c, pa.float64()) for c in cols]], names=SCHEMA.names)

    return doc_texts(docs).mapInArrow(run, SCHEMA)


#: A rule: conditions (statistic, is it above, threshold) that must all hold.
Rule = tuple[tuple[str, bool, float], ...]


def tree_rules(forest) -> list[Rule]:
    """The path to every node below a root, as a rule; each rule once, in a fixed order."""
    rules: set[Rule] = set()

    def below(node, path: Rule) -> None:
        if path:
            rules.add(tuple(sorted(set(path))))
        if node.subtreeDepth() > 0:
            split = node.split()
            name, at = STATISTICS[split.featureIndex()], float(split.threshold())
            below(node.leftChild(), (*path, (name, False, at)))
            below(node.rightChild(), (*path, (name, True, at)))

    for tree in forest.trees:
        below(tree._call_java("rootNode"), ())
    return sorted(rules)


def rule_column(rule: Rule) -> Column:
    """1.0 where the rule holds, else 0.0."""
    held = [F.col(name) > at if above else F.col(name) <= at for name, above, at in rule]
    return reduce(lambda a, b: a & b, held).cast("double")


def fit(rows: DataFrame) -> tuple[float, list[tuple[Rule, float]]]:
    """Intercept and weighted rules, learnt from ``STATISTICS`` and ``label`` (0 or 1)."""
    counts = {int(r["label"]): r["count"] for r in rows.groupBy("label").count().collect()}
    if set(counts) != {0, 1}:
        share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
        return float(np.log(share / (1 - share))), []
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(rows.withColumn("label", F.col("label").cast("double")))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy="onethird", subsamplingRate=0.5, seed=SEED).fit(vectors.select("label", "features"))
    rules = tree_rules(forest)
    if not rules:
        return float(np.log(counts[1] / counts[0])), []
    truth = rows.select(F.col("label").cast("double").alias("label"), *[rule_column(r).alias(f"r{k}") for k, r in enumerate(rules)])
    truth = VectorAssembler(inputCols=[f"r{k}" for k in range(len(rules))], outputCol="features").transform(truth).select("label", "features")
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, maxIter=60, standardization=False).fit(truth)
    return float(lasso.intercept), [(r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray()) if w]


def score_column(intercept: float, rules: list[tuple[Rule, float]]) -> Column:
    """The ensemble as one expression over the statistics, from 0 to 1."""
    terms = [F.lit(intercept)] + [F.lit(w) * rule_column(r) for r, w in rules]
    return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, terms)))


def classify(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """Learn ``labels.quality`` from the rows whose fold is not ``held_out``; score every document.

    Returns doc_id, held_out, score (0 to 1) and predicted (1 from one half on).
    """
    table = written(statistics(docs), "statistics").withColumn("held_out", crc_remainder("doc_id", folds) == held_out)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("label")).where(F.col("label").isin(0, 1))
    intercept, rules = fit(table.where(~F.col("held_out")).join(known, "doc_id"))
    scored = table.withColumn("score", score_column(intercept, rules))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
