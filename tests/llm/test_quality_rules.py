import json
import math
from collections import Counter

import numpy as np
from conftest import SF_SMALL
from llm_cases import WORD, documents, no_documents, words
from pyspark.sql import functions as F

from strata.llm import quality_rules as Q


def base(text):
    text = text or ""
    w, seen, dup = words(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    counts, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if counts[x] > 1:
            covered.update(range(i, i + 5))
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered), failed


def features(text):
    n, chars, symbols, dup, repeats, _ = base(text)
    upper = sum(c.isupper() for c in text)
    lines = sum(bool(WORD.search(x)) for x in text.split("\n"))
    rate = lambda a, b: a / (b + Q.PRIOR)
    return [math.log((chars + 5 * Q.PRIOR) / (n + Q.PRIOR)), math.sqrt(rate(symbols, chars)), math.sqrt(rate(upper, chars)), rate(dup, lines), rate(repeats, n)]


def estimate(x):
    """Mean and ridged covariance of the rows, as the operator has them."""
    return x.mean(0), np.cov(x.T, bias=True) + Q.RIDGE * np.eye(Q.P)


def distance(x, mean, cov):
    return np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)


def brute_force_mcd(x):
    grid = np.sort(np.floor(np.abs(x * 1000) + 0.5) * np.sign(x), axis=0)
    at = lambda share: grid[math.ceil(len(x) * share) - 1] / 1000
    starts = [(at(0.5), np.diag(((at(0.75) - at(0.25)) / 1.349) ** 2) + Q.RIDGE * np.eye(Q.P)), estimate(x)]
    for _ in range(Q.MAX_STEPS):
        for k, (mean, cov) in enumerate(starts):
            bins = np.floor(np.log(distance(x, mean, cov) + 1e-6) * Q.BINS_PER_E)
            cut = np.sort(bins)[math.ceil(len(x) * Q.CORE) - 1]
            starts[k] = estimate(x[bins <= cut])
    mean, cov = min(starts, key=lambda s: np.linalg.slogdet(s[1])[1])
    inner = distance(x, mean, cov * Q.consistency(Q.CORE)) <= Q.chi_square_quantile(1 - Q.REWEIGHT, Q.P)
    mean, cov = estimate(x[inner])
    return mean, cov * Q.consistency(Q.REWEIGHT)


def test_counts_and_verdicts_equal_brute_force(spark):
    docs = documents(spark, SF_SMALL)
    rows = docs.select("doc_id", "text", "lang", "source").collect()
    good = [r for r in rows if not base(r["text"])[-1]]
    x = np.array([features(r["text"]) for r in good])
    keys = lambda r: [("1", r["lang"], r["source"]), ("2", r["lang"]), ("3",)]
    groups = {}
    for k, r in enumerate(good):
        for key in keys(r):
            groups.setdefault(key, []).append(k)
    fits = {key: brute_force_mcd(x[which]) for key, which in groups.items() if len(which) >= Q.MIN_GROUP}
    assert len(fits) >= 2
    expected = []
    for r in rows:
        fit = next((fits[k] for k in keys(r) if k in fits), None)
        d2 = float(distance(np.array([features(r["text"] or "")]), *fit)[0])
        expected.append((r["doc_id"], *base(r["text"]), not base(r["text"])[-1] and d2 <= Q.chi_square_quantile(Q.REJECT, Q.P), d2))
    order = lambda r: (r[0] is not None, r[0] or 0)
    got = sorted((tuple(r) for r in Q.quality_verdicts(docs).collect()), key=order)
    assert len(got) == len(expected)
    for g, e in zip(got, sorted(expected, key=order)):
        assert g[:8] == e[:8]
        assert math.isclose(g[8], e[8], rel_tol=0.02, abs_tol=0.01), (g, e)


def test_labelled_clean_documents_stay_and_junk_goes(spark):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    got = Q.quality_verdicts(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).join(labels, "doc_id").where("n_words >= 10").collect()
    clean = [r for r in got if r["quality"] == 1 and not r["base_failed"]]
    junk = [r for r in got if r["quality"] == 0]
    assert all(r["kept"] for r in clean) and len(clean) > 50
    assert sum(not r["kept"] for r in junk) >= 0.9 * len(junk) > 0


def test_kept_rows_keep_their_columns(spark):
    docs = documents(spark, SF_SMALL)
    kept = Q.keep_good(docs)
    assert kept.schema.fieldNames() == docs.schema.fieldNames()
    verdicts = {r["doc_id"] for r in Q.quality_verdicts(docs).where("kept").collect()}
    want = [r for r in docs.collect() if r["doc_id"] in verdicts]
    show = lambda rows: sorted(json.dumps(r.asDict(), sort_keys=True) for r in rows)
    assert show(kept.collect()) == show(want)


def test_empty_table_and_no_estimate(spark):
    assert Q.quality_verdicts(no_documents(spark)).count() == 0
    few = spark.createDataFrame([(1, "ten words make a text that no group can be judged by"), (2, "#### " * 12)], "doc_id long, text string")
    assert sorted((r["doc_id"], r["base_failed"], r["kept"], r["distance2"]) for r in Q.quality_verdicts(few).collect()) == [(1, False, True, None), (2, True, False, None)]


def test_chi_square():
    assert math.isclose(Q.chi_square_quantile(0.05, 1), 3.841459, rel_tol=1e-6)
    assert math.isclose(Q.chi_square_quantile(0.025, 5), 12.832502, rel_tol=1e-6)


def test_plan_has_no_python(spark):
    plan = Q.with_counts(documents(spark, SF_SMALL).select("text").withColumn("source", F.lit("s")))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
