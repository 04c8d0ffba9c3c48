"""Quality rules: base counts, and robust multivariate outliers of their transforms.

Everything here is a DataFrame or SQL expression; no Python runs on executors.

Each text gets a vector of ``FEATURES``: the logarithm of its mean word length,
square roots of its rates of symbols and upper-case letters, and its rates of
repeated lines and repeated words (rates of short texts are shrunk by
``PRIOR``). For each language and source a minimum-covariance-determinant
estimate is fitted to the vectors of texts that pass the base rules: from two starts (median with
quartile scale, mean with covariance) concentration steps keep the share
``CORE`` of nearest vectors until the determinant stands still; the start with
the smaller determinant wins, its covariance is made consistent, and one
reweighting step follows. A text is rejected when its squared Mahalanobis
distance exceeds the chi-square quantile of ``1 - REJECT``.

A group's state is one row of sums, so a group of any size is pre-aggregated
before its rows meet. The nearest share is found from counts over logarithmic
bins of the distance; all vectors of the cutoff bin stay. Groups of fewer than
``MIN_GROUP`` vectors use the estimate of their language, or of all texts; a
text without any is kept. ``RIDGE`` is added to every variance, so features
that are constant in a group do no harm.

Cases: a null or empty text has no words and fails the base rules; null
languages and sources form groups of their own; repeated rows and repeated ids
are judged each; extra columns are carried where the caller asks and cannot clash; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.tables import written

SEPARATORS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

FEATURES = ("word_length", "symbols", "upper", "dup_lines", "repeats")
P = len(FEATURES)
PRIOR = 20.0
RIDGE = 0.03**2
CORE = 0.75
REJECT = 1e-9
REWEIGHT = 0.975
MIN_GROUP = 50
MAX_STEPS = 8
BINS_PER_E = 64
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


# ---------------------------------------------------------------- counts

def with_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper and n_lines."""
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SEPARATORS, -1))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.withColumn("_words", words).withColumn("_lines", lines)
    out = out.withColumn("_w", F.transform("_words", lambda w: F.xxhash64(w)))
    at = lambda k: F.element_at("_w", k)
    hashes = F.transform(F.sequence(F.lit(1), F.size("_w") - (WINDOW - 1)), lambda i: F.xxhash64(*[at(i + k) for k in range(WINDOW)]))
    out = out.withColumn("_h", F.when(F.size("_w") >= WINDOW, hashes))
    # Only a text with a window found twice goes on to look for the places.
    twice = F.size(F.array_distinct("_h")) < F.size("_h")
    out = out.withColumn("_s", F.when(twice, F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, j: F.get("_s", j)["h"] == x["h"]
    found = F.filter("_s", lambda x, j: ((j > 0) & F.coalesce(same(x, j - 1), F.lit(False))) | F.coalesce(same(x, j + 1), F.lit(False)))
    out = out.withColumn("_p", F.sort_array(F.transform(found, lambda x: x["i"])))
    covered = F.aggregate(
        F.transform("_p", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_p", k + 1) - p, F.lit(WINDOW)))), F.lit(0), lambda a, b: a + b
    )
    out = out.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
        "n_upper": F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
    })
    return out.drop("_words", "_lines", "_w", "_h", "_s", "_p")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def feature_columns() -> dict[str, Column]:
    rate = lambda n, total: F.col(n) / (F.col(total) + F.lit(PRIOR))
    return {
        "x0": F.log((F.col("word_chars") + 5 * PRIOR) / (F.col("n_words") + PRIOR)),
        "x1": F.sqrt(rate("n_symbols", "word_chars")),
        "x2": F.sqrt(rate("n_upper", "word_chars")),
        "x3": rate("n_dup_lines", "n_lines"),
        "x4": rate("n_repeat_words", "n_words"),
    }


def group_keys() -> list[Column]:
    """A text's groups, the most specific first."""
    return [
        F.concat(F.lit("1"), F.to_json(F.struct("lang", "source"))),
        F.concat(F.lit("2"), F.to_json(F.struct("lang"))),
        F.lit("3"),
    ]


# ---------------------------------------------------------------- linear algebra on columns

def chi_square_cdf(x: float, k: int) -> float:
    """P(X <= x) for k degrees of freedom, by the series of the incomplete gamma function."""
    a, z = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= z / n
        total += term
    return total * math.exp(-z + a * math.log(z) - math.lgamma(a)) if z > 0 else 0.0


def chi_square_quantile(upper: float, k: int) -> float:
    """The value that is exceeded with probability ``upper``."""
    lo, hi = 0.0, 200.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if 1 - chi_square_cdf(mid, k) > upper else (lo, mid)
    return hi


def with_cholesky(estimates: DataFrame) -> DataFrame:
    """Adds the lower factor ``l_ij`` of the covariance columns ``c_ij`` (ridge added) and ``log_det``."""
    out = estimates
    for i in range(P):
        for j in range(i + 1):
            rest = F.col(f"c_{i}_{j}") + F.lit(RIDGE if i == j else 0.0)
            for k in range(j):
                rest = rest - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            out = out.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(rest, F.lit(RIDGE * 1e-6))) if i == j else rest / F.col(f"l_{j}_{j}"))
    return out.withColumn("log_det", 2 * reduce(lambda a, b: a + b, [F.log(f"l_{i}_{i}") for i in range(P)]))


def with_distance(rows: DataFrame, name: str = "d2") -> DataFrame:
    """Adds the squared Mahalanobis distance of ``x*`` from ``m*`` under the factor ``l_ij``, by forward substitution."""
    out = rows
    for i in range(P):
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l_{i}_{k}") * F.col(f"_y{k}")
        out = out.withColumn(f"_y{i}", rest / F.col(f"l_{i}_{i}"))
    total = reduce(lambda a, b: a + b, [F.col(f"_y{i}") * F.col(f"_y{i}") for i in range(P)])
    return out.withColumn(name, total).drop(*[f"_y{i}" for i in range(P)])


ESTIMATE = [f"m{i}" for i in range(P)] + [f"l_{i}_{j}" for i, j in PAIRS]


def moments(rows: DataFrame, by: list[str]) -> DataFrame:
    """Mean, covariance, factor and log-determinant of each group, from one row of sums."""
    sums = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(f"x{i}").alias(f"s{i}") for i in range(P)],
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q_{i}_{j}") for i, j in PAIRS],
    )
    means = sums.select(*by, "n", *[(F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in range(P)], *[f"q_{i}_{j}" for i, j in PAIRS])
    covs = means.withColumns({f"c_{i}_{j}": F.col(f"q_{i}_{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}") for i, j in PAIRS})
    return with_cholesky(covs).select(*by, "n", "log_det", *ESTIMATE)


def _quartile_start(vectors: DataFrame) -> DataFrame:
    """Median and quartile scale of each feature, from counts of values rounded to 1/1000."""
    long = vectors.select("key", F.posexplode(F.array(*[F.round(F.col(f"x{i}") * 1000).cast("long") for i in range(P)])).alias("i", "v"))
    counts = long.groupBy("key", "i", "v").count()
    w = Window.partitionBy("key", "i").orderBy("v")
    ranked = counts.withColumn("upto", F.sum("count").over(w)).withColumn("all", F.sum("count").over(Window.partitionBy("key", "i")))
    at = lambda share: F.min(F.when(F.col("upto") >= F.col("all") * share, F.col("v"))) / 1000.0
    quartiles = ranked.groupBy("key", "i").agg(at(0.25).alias("a"), at(0.5).alias("m"), at(0.75).alias("b"))
    one = lambda i, c: F.max(F.when(F.col("i") == i, c))
    scale = (F.col("b") - F.col("a")) / 1.349
    zero = {f"c_{i}_{j}": F.lit(0.0) for i, j in PAIRS if i != j}
    wide = quartiles.groupBy("key").agg(*[one(i, F.col("m")).alias(f"m{i}") for i in range(P)], *[one(i, scale * scale).alias(f"c_{i}_{i}") for i in range(P)])
    return with_cholesky(wide.withColumns(zero)).select("key", F.lit(0).alias("start"), *ESTIMATE)


# ---------------------------------------------------------------- the estimate

def fit(statistics: DataFrame) -> DataFrame:
    """The estimates of all groups: ``key``, ``n`` and ``ESTIMATE``; ``statistics`` is a written table."""
    rows = statistics.where(~F.col("base_failed")).select(F.explode(F.array(*group_keys())).alias("key"), *[f"x{i}" for i in range(P)])
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("total")).where(F.col("total") >= MIN_GROUP)
    vectors = rows.join(written(sizes, "mcd-sizes"), "key")
    quartile = _quartile_start(vectors)
    classic = moments(vectors, ["key"]).select("key", F.lit(1).alias("start"), *ESTIMATE)
    current = written(quartile.unionByName(classic), "mcd-start")
    last = None
    for _ in range(MAX_STEPS):
        near = with_distance(vectors.join(current.select("key", "start", *ESTIMATE), "key"))
        near = near.withColumn("bin", F.floor(F.log(F.col("d2") + 1e-6) * BINS_PER_E).cast("int"))
        counts = near.groupBy("key", "start", "total", "bin").agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(Window.partitionBy("key", "start").orderBy("bin"))
        cut = counts.withColumn("upto", upto).where(F.col("upto") >= F.col("total") * CORE).groupBy("key", "start").agg(F.min("bin").alias("cut"))
        # Written, its size is known: a few groups are broadcast, many are joined by a shuffle that AQE can split.
        core = near.join(written(cut, "mcd-cut"), ["key", "start"]).where(F.col("bin") <= F.col("cut"))
        current = written(moments(core, ["key", "start"]), "mcd-step")
        now = current.agg(F.sum(F.round("log_det", 6))).first()[0]
        if last is not None and (now is None or abs(now - last) < 1e-4):
            break
        last = now
    best = current.groupBy("key").agg(F.min(F.struct("log_det", "start")).alias("b")).select("key", F.col("b.start").alias("start"))
    raw = current.join(best, ["key", "start"])
    factor = math.sqrt(consistency(CORE))
    raw = raw.select("key", *[f"m{i}" for i in range(P)], *[(F.col(f"l_{i}_{j}") * factor).alias(f"l_{i}_{j}") for i, j in PAIRS])
    inner = with_distance(vectors.join(written(raw, "mcd-raw"), "key")).where(F.col("d2") <= chi_square_quantile(1 - REWEIGHT, P))
    factor = math.sqrt(consistency(REWEIGHT))
    final = moments(inner, ["key"])
    return written(final.select("key", "n", *[f"m{i}" for i in range(P)], *[(F.col(f"l_{i}_{j}") * factor).alias(f"l_{i}_{j}") for i, j in PAIRS]), "mcd")


def consistency(share: float) -> float:
    """What the covariance of the nearest ``share`` of normal vectors must be multiplied by."""
    return share / chi_square_cdf(chi_square_quantile(1 - share, P), P + 2)


def judge(docs: DataFrame, keep: list[str | Column]) -> DataFrame:
    """``row`` (a struct of the ``keep`` columns), the counts, ``base_failed``, ``distance2`` (null
    where nothing was estimated) and ``kept``. ``docs`` is read once; the counts and ``row`` are
    written to the shared folder."""
    own = {c: F.col(c) if c in docs.columns else F.lit(None).cast("string") for c in ("text", "lang", "source")}
    # What is kept travels in one struct, so no column of the caller's can clash with ours.
    rows = docs.select(F.struct(*keep).alias("row"), *[c.alias(n) for n, c in own.items()])
    counted = with_counts(rows).drop("text")
    statistics = written(counted.withColumn("base_failed", base_failed()).withColumns(feature_columns()), "quality-counts")
    estimates = fit(statistics)
    out = statistics.withColumns({f"_k{n}": key for n, key in enumerate(group_keys())})
    for n in range(3):
        own = estimates.select(F.col("key").alias(f"_k{n}"), *ESTIMATE)
        out = with_distance(out.join(own, f"_k{n}", "left"), f"_d{n}").drop(*ESTIMATE)
    out = out.withColumn("distance2", F.coalesce(*[f"_d{n}" for n in range(3)]))
    return out.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance2") <= chi_square_quantile(REJECT, P), F.lit(True)))


def quality_verdicts(docs: DataFrame) -> DataFrame:
    return judge(docs, ["doc_id"]).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("distance2", 4).alias("distance2")
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns of ``docs``."""
    return judge(docs, [F.col(f"`{c}`") for c in docs.columns]).where("kept").select("row.*")
