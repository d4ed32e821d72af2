"""The operators applied to the given tables, one query each."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riverbed.llm import bpe, editprint, hardneg, langid, maintext, neardup, packing, pii, prefixtrie, quality, secretscan, tokenfiles, toxicity
from riverbed.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintext.main_text(table(spark, sf_dir, "pages"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.find(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.find(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op9_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return editprint.edited_prints(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.trie(table(spark, sf_dir, "conversations"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hardneg.mine(table(spark, sf_dir, "embeddings"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_main_text": op3_main_text,
    "op4_minhash_near_dedup": op4_minhash_near_dedup,
    "op5_secret_scan": op5_secret_scan,
    "op6_pii": op6_pii,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_quality_rules": op8_quality_rules,
    "op9_edit_fingerprints": op9_edit_fingerprints,
    "op10_language_id": op10_language_id,
    "op11_token_files": op11_token_files,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_hard_negatives": op13_hard_negatives,
}

#: The others can't be written as one SQL statement with the same rows (label model, compression, tokenizers);
#: tests/llm holds them against plain versions instead.
ORACLE: dict[str, str] = {
    "op12_prefix_trie": prefixtrie.TRIE_SQL,
    "op13_hard_negatives": hardneg.MINE_SQL,
}
