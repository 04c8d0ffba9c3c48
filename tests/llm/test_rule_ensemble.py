import math

import numpy as np
import pyarrow as pa
from conftest import SF_ORACLE, SF_SMALL
from llm_cases import documents, fold, lower, no_documents, words

from strata.llm import rule_ensemble as R
from strata.llm.text import column_bytes


def brute_force(text):
    text = text or ""
    w, raw = words(lower(text)), text.encode()
    sizes = [len(x.encode()) for x in w]
    n, some = len(w), max(len(w), 1)
    triples = [tuple(w[i : i + 3]) for i in range(n - 2)]
    out = [
        math.log1p(n), sum(sizes) / some, len(set(w)) / some, max((w.count(x) for x in set(w)), default=0) / some if n < 3000 else None,
        sum(a == b for a, b in zip(w, w[1:])) / some, sum(s <= 3 for s in sizes) / some, len(set(triples)) / max(len(triples), 1),
    ]
    return out + [sum(b in members for b in raw) / max(len(raw), 1) for members in R.BYTE_CLASSES.values()]


def test_statistics_equal_brute_force(spark):
    rows = [r["text"] for r in documents(spark, SF_SMALL).collect()]
    got = np.stack(R._statistics(*column_bytes(pa.array(rows, pa.string()))), axis=1)
    for t, g in zip(rows, got):
        for name, a, b in zip(R.STATISTICS, brute_force(t), g):
            assert a is None or math.isclose(a, b, abs_tol=1e-9), (name, a, b, t and t[:80])


def test_held_out_labels_are_predicted(spark):
    docs, labels = (spark.read.parquet(f"{SF_ORACLE}/{t}.parquet") for t in ("documents", "labels"))
    rows = R.classify(docs, labels).join(labels, "doc_id").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) and r["held_out"] == (fold(r["doc_id"], 3) == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert {r["quality"] for r in held} == {0, 1}
    assert sum(r["predicted"] == r["quality"] for r in held) >= 0.95 * len(held)


def test_rules_are_paths_and_the_score_is_their_weighted_sum(spark):
    rows = [(float(i % 10), float(i % 7), int(i % 10 > 6 and i % 7 > 2)) for i in range(400)]
    zero = {s: R.F.lit(0.0) for s in R.STATISTICS[2:]}
    table = spark.createDataFrame(rows, "log_words double, word_bytes double, label int").withColumns(zero)
    intercept, rules = R.fit(table)
    assert rules and all(1 <= len(r) <= R.DEPTH for r, _ in rules)
    hold = lambda rule, x: all((x[n] > at) == above for n, above, at in rule)
    right = 0
    for r in table.withColumn("score", R.score_column(intercept, rules)).collect():
        total = intercept + sum(w for rule, w in rules if hold(rule, r))
        assert math.isclose(r["score"], 1 / (1 + math.exp(-total)), rel_tol=1e-9)
        right += (r["score"] >= 0.5) == r["label"]
    assert right == len(rows)


def test_hard_cases_one_label_and_no_rows(spark):
    docs = documents(spark, SF_SMALL)
    one = spark.createDataFrame([(d, 1) for d in range(100)], "doc_id long, quality int")
    got = R.classify(docs, one).collect()
    assert len(got) == docs.count() and len({r["score"] for r in got}) == 1 and got[0]["score"] > 0.9
    none = R.classify(docs, one.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert R.classify(no_documents(spark), one).count() == 0
