"""From raw documents to packed training sequences, in five stages.

Each stage takes (session, documents, data folder) and returns a DataFrame; all but the last return
the columns of documents, with the stage's decisions in effect. Between stages the rows are
written to the shared folder and read again, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dwellgrid.llm import neardup, packing, pii, quality, toxicity
from dwellgrid.llm.queries import table, tokenizer_file
from dwellgrid.sources.storage import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed rules and are no outliers of their language and source."""
    return quality.filtered(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic; the model is learnt from the labels of these documents."""
    return toxicity.filtered(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group of near copies."""
    return neardup.deduplicated(docs)


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each span of personal data replaced by its kind in brackets."""
    return pii.redacted(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, placed into sequences."""
    return packing.packed(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("near_dedup", near_dedup),
    ("pii", pii_redaction),
    ("best_fit_packing", best_fit_packing),
]

# Robust estimates, minhash, a trained field and a packing are not SQL: tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
