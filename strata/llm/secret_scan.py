"""Secret scans: fixed patterns, and character Markov models of random strings.

Everything here is a DataFrame or SQL expression; no Python runs on executors.

Patterns (kinds ``assign``, ``access``, ``hex``) find leftmost non-overlapping
matches. Positions come from splitting the text by the pattern: the pieces
between the matches and the matches themselves alternate, so running sums of
their lengths are code-point offsets.

The method adds spans of kind ``markov``. Two first-order character models,
one of random strings and one of ordinary identifiers, are trained from
labelled samples. A token that overlaps no pattern's span is a secret when the
log-likelihood ratio of its transitions is at least ``MIN_LLR``. Both models
are one table of log-ratios over pairs of ``ALPHABET`` letters, so its size is
fixed whatever the training data.

Cases: a null or empty text has no spans; repeated rows are scanned alike;
with no samples of either label no ``markov`` span is found; columns beyond
``doc_id`` and ``text`` are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.tables import doc_texts

# The patterns of the base kinds, in the order of their rank.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"  # AKIA[A-Z0-9]+ of 20 characters or more: a run fails as a whole or not at all
HEX = r"[0-9a-f]{24,}"  # [0-9a-f]+ of 24 characters or more, likewise
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
#: An identifier worth learning from.
IDENTIFIER = r"[A-Za-z0-9+/_=-]{4,}"
#: Log-odds (natural) at which a token counts as random.
MIN_LLR = 12.0
SMOOTHING = 0.5
#: Documents that ordinary identifiers are learnt from, in the mean: those of the smallest hashes.
SAMPLE_DOCS = 2000
HASH_STEPS = 1 << 30


def _matches(text: Column, pattern: str, guard: Column) -> Column:
    """Every match as struct(gap, size, hit): the characters before it since the last, its length, itself."""
    none = F.array().cast("array<struct<gap:int,size:int,hit:string>>")
    zipped = F.zip_with(
        F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda piece, hit: F.struct(F.length(piece).alias("gap"), F.length(hit).alias("size"), hit.alias("hit")),
    )
    return F.when(guard, F.filter(zipped, lambda m: m["hit"].isNotNull())).otherwise(none)


def _spans(matches: Column, kind: str, keep) -> Column:
    """Spans struct(start, rank, end, hit) of the matches that ``keep`` accepts."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,rank:int,end:int,hit:string>>").alias("found"))

    def step(acc, m):
        a = acc["at"] + m["gap"]
        b = a + m["size"]
        span = F.struct(a.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), b.alias("end"), m["hit"].alias("hit"))
        return F.struct(b.alias("at"), F.when(keep(m["hit"]), F.concat(acc["found"], F.array(span))).otherwise(acc["found"]).alias("found"))

    return F.aggregate(matches, start, step, lambda acc: acc["found"])


def _value(hit: Column) -> Column:
    return F.regexp_extract(hit, ASSIGN, 2)


def base_spans(text: Column) -> Column:
    """Spans of the three patterns, by start and then by kind."""
    guards = {
        "assign": text.rlike(r"(?i)(?:passw|secret|token|api_?key)[a-z]*[\"']?\x20*[:=]"),
        "access": F.contains(text, F.lit("AKIA")),
        "hex": text.rlike(r"[0-9a-f]{24}"),
    }
    found = [
        _spans(_matches(text, ASSIGN, guards["assign"]), "assign", lambda hit: F.length(_value(hit)) >= ASSIGN_VALUE),
        _spans(_matches(text, ACCESS, guards["access"]), "access", lambda hit: F.lit(True)),
        _spans(_matches(text, HEX, guards["hex"]), "hex", lambda hit: F.lit(True)),
    ]
    return F.sort_array(F.concat(*found))


def labelled_samples(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``value`` and ``label``: 1 for the values that the patterns find in any document,
    0 for the other identifiers of about ``sample_docs`` documents, those whose hash falls under
    their share of all documents."""
    texts = doc_texts(docs).where("text is not null")
    hits = texts.select(F.explode(base_spans(F.col("text"))).alias("s")).select(
        F.when(F.col("s.rank") == 0, _value(F.col("s.hit"))).otherwise(F.col("s.hit")).alias("value"), F.lit(1).alias("label")
    )
    share = sample_docs / max(docs.count(), 1)
    sample = texts.where(F.pmod(F.xxhash64("doc_id"), F.lit(HASH_STEPS)) < F.lit(int(share * HASH_STEPS)))
    prose = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), HEX, " ")
    words = sample.select(F.explode(F.regexp_extract_all(prose, F.lit(IDENTIFIER), F.lit(0))).alias("value"), F.lit(0).alias("label"))
    return hits.unionByName(words)


def train(samples: DataFrame) -> list[float] | None:
    """Log-likelihood ratios of all pairs of letters, row by row; None without both labels.

    The counts of pairs are summed by Spark; at most two rows for each pair of
    ``ALPHABET`` come to the driver.
    """
    pairs = samples.where(F.length("value") >= 2).select(
        "label", F.explode(F.transform(F.sequence(F.lit(1), F.length("value") - 1), lambda i: F.substr("value", i, F.lit(2)))).alias("pair")
    )
    counts = {0: {}, 1: {}}
    inside = pairs.where(F.col("pair").rlike(r"^[A-Za-z0-9+/_=-]{2}$"))
    for r in inside.groupBy("label", "pair").count().collect():
        counts[r["label"]][r["pair"]] = r["count"]
    if not counts[0] or not counts[1]:
        return None
    size, table = len(ALPHABET), []
    for a in ALPHABET:
        total = {k: sum(counts[k].get(a + b, 0) for b in ALPHABET) + SMOOTHING * size for k in counts}
        for b in ALPHABET:
            p = {k: (counts[k].get(a + b, 0) + SMOOTHING) / total[k] for k in counts}
            table.append(round(math.log(p[1] / p[0]), 6))
    return table


def log_likelihood_ratio(token: Column, table: list[float]) -> Column:
    """The log-likelihood ratio of a token's transitions, random against ordinary."""
    ratios = F.split(F.lit(",".join(map(str, table))), ",").cast("array<double>")
    letter = lambda i: F.instr(F.lit(ALPHABET), F.substr(token, i, F.lit(1)))
    steps = F.sequence(F.lit(1), F.length(token) - 1)
    return F.aggregate(steps, F.lit(0.0), lambda acc, i: acc + F.element_at(ratios, (letter(i) - 1) * len(ALPHABET) + letter(i + 1)))


def scan(docs: DataFrame, table: list[float] | None, *keep: Column) -> DataFrame:
    """``doc_id``, the ``keep`` columns and ``found``: every span as struct(start, rank, end, hit), by start and rank."""
    base = doc_texts(docs, *keep).withColumn("base", base_spans(F.coalesce("text", F.lit(""))))
    if table is None:
        return base.withColumn("found", F.col("base"))
    text = F.coalesce("text", F.lit(""))
    tokens = _spans(_matches(text, TOKEN, text.rlike(r"[A-Za-z0-9+/_=-]{16}")), "markov", lambda hit: log_likelihood_ratio(hit, table) >= MIN_LLR)
    free = lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
    return base.withColumn("tokens", tokens).withColumn("found", F.sort_array(F.concat("base", F.filter("tokens", free)))).drop("tokens")


def _joined(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_digests(docs: DataFrame) -> DataFrame:
    """Train on the documents' own labelled samples, scan all and return counts and spans."""
    found = scan(docs, train(labelled_samples(docs)))
    count = lambda kind: F.size(F.filter("base", lambda s: s["rank"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("found").alias("spans"),
    )


def redact(docs: DataFrame, table: list[float] | None, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mark``; spans that overlap or touch inside one another get one mark.

    The other columns stay; ``n_chars`` follows the new text where there is one.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    # The caller's columns travel in one, so that none clashes with the names used here.
    found = scan(docs, table, F.struct(*[F.col(f"`{c}`") for c in rest], F.lit(0).alias("__none")).alias("rest"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc, s):
        new = F.array(F.substr("text", acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        parts = F.when(s["start"] >= acc["at"], F.concat(acc["parts"], new)).otherwise(acc["parts"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), parts.alias("parts"))

    cut = F.aggregate("found", start, step, lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substr("text", acc["at"] + 1)))
    text = F.when(F.size("found") > 0, cut).otherwise(F.col("text"))
    out = found.withColumn("text", text)
    columns = {c: F.col("rest")[c] for c in rest} | {c: F.col(c) for c in ("doc_id", "text")}
    if "n_chars" in rest:
        columns["n_chars"] = F.when(F.size("found") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(columns["n_chars"])
    return out.select(*[columns[c].alias(c) for c in docs.columns])
