"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it as Parquet and reads
it again as the next stage's documents. All stages but the last return the columns of
``documents``: the first three drop rows, the fourth changes texts. The stages share executors, so each
reads in small batches."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riverbed.llm import langid, neardup, packing, quality, secretscan
from riverbed.llm.common import lean_batches, table
from riverbed.session import cut_lineage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the label model takes for good."""
    lean_batches(spark)
    return quality.keep_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told clearly."""
    lean_batches(spark)
    return langid.keep_known(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    lean_batches(spark)
    return neardup.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their secrets replaced."""
    lean_batches(spark)
    return secretscan.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences."""
    lean_batches(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("language id", language_id),
    ("near dedup", near_dedup),
    ("secret scan", secret_scan),
    ("packing", best_fit_packing),
]

#: The stages estimate models, compress and tokenize: no SQL gives their rows. tests/llm holds the
#: pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
