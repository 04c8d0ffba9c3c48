"""Registered queries of the operators: each runs over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strata.llm.brown_lm import score
from strata.llm.conversation_trie import prefix_trie
from strata.llm.decontaminate import find_contamination
from strata.llm.embedding_whitening import whiten
from strata.llm.jaccard_join import jaccard_components
from strata.llm.licenses import scan_licenses
from strata.llm.oracles import ORACLE_SQL
from strata.llm.quality_rules import quality_verdicts
from strata.llm.rule_ensemble import classify
from strata.llm.secret_scan import secret_digests
from strata.llm.sentencepiece_codec import DIGESTS, encode_offsets
from strata.llm.simhash_grid import simhash_components
from strata.llm.substring_dedup import remove_repeats
from strata.llm.tables import new_folder, read
from strata.llm.token_planes import token_file_digests


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(read(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_offsets(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), DIGESTS)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(read(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents"))


def op7_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read(spark, sf_dir, "documents"), every_word=True)


def op9_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_digests(spark, read(spark, sf_dir, "documents"), new_folder(spark, "token-files"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents"), texts=False).drop("kept")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read(spark, sf_dir, "conversations"))


def op13_simhash_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_license_scan": op2_license_scan,
    "op3_quality_rules": op3_quality_rules,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_secret_scan": op5_secret_scan,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_rule_ensemble": op7_rule_ensemble,
    "op8_brown_lm": op8_brown_lm,
    "op9_token_planes": op9_token_planes,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_simhash_grid": op13_simhash_grid,
}
#: DuckDB SQL of the queries that SQL can express.
ORACLES: dict[str, str] = dict(ORACLE_SQL)
