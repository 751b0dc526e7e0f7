"""The corpus pipeline: documents to packed training sequences, in five stages.

Each stage takes what the one before kept, written as Parquet and read again. All but the last return
the columns of documents. Rows of documents with a null text fail the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from annoloom.llm import decontaminate, ngram_join, packing, quality_rules, secret_scan
from annoloom.llm.queries import tokenizer_path
from annoloom.llm.rows import table
from annoloom.sources import tables


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of similar ones."""
    return ngram_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a test item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked; ``n_chars`` follows the new text."""
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", decontamination), ("secret scans", secrets), ("packing", packed)]

#: The stages are hashing, components and tokenizers, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = tables.stage(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
