"""A corpus pipeline of five stages, each an operator of ``strata.llm``.

Each stage works on all documents that the one before kept; results are
written to the shared folder between stages, so a stage never recomputes
another. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.decontaminate import drop_contaminated
from strata.llm.jaccard_join import jaccard_components
from strata.llm.quality_rules import keep_good
from strata.llm.secret_scan import labelled_samples, redact, train
from strata.llm.sentencepiece_codec import encode_offsets
from strata.llm.tables import read, written

#: Near copies share 80% of their shingles of five words; op6's own query has a contract of its own.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the robust distance reject go."""
    return keep_good(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one of the smallest id stays, with all texts that stand
    under this id; of rows alike in id and text one stays, the first by the other columns.
    Documents without an id are in no group and stay."""
    found = jaccard_components(docs, NEAR_WORDS, NEAR_PERCENT)
    first = found.where("doc_id = component_id").select("doc_id").distinct()
    place = next(n for n in ("place" + "_" * k for k in range(len(docs.columns) + 1)) if n not in docs.columns)
    others = [F.to_json(F.struct(F.col(f"`{c}`"))) for c in docs.columns if c not in ("doc_id", "text")]
    own = Window.partitionBy("doc_id", "text").orderBy(*(others or ["doc_id"]))
    kept = docs.join(first, "doc_id", "left_semi").withColumn(place, F.row_number().over(own)).where(F.col(place) == 1).drop(place)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(docs.where("doc_id is null"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret in a text is replaced by a mark; the document stays."""
    return redact(docs, train(labelled_samples(docs)))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the ids, and a digest of the text that they decode to."""
    return encode_offsets(docs, public_tokenizers.path("piece_bpe_32k.model"), ("n_tokens", "ids", "decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("decontaminate", decontaminate),
    ("secret_scan", secret_scan),
    ("sentencepiece", sentencepiece),
]

#: Robust estimates, components, seeds with substitutions and BPE are beyond SQL; tests/llm has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
