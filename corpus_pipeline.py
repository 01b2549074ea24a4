"""The corpus pipeline: five stages over ``documents``, each one operator.

Every stage works on all rows that the stage before kept, is written as Parquet
and read back.  Language ID learns from the rows it is given.  The last stage
returns the packed pieces of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eddyflow.llm.common import table, written
from eddyflow.llm.decontam import drop_contaminated
from eddyflow.llm.langid import keep_known
from eddyflow.llm.packing import pack_documents
from eddyflow.llm.quality import clean_good
from eddyflow.llm.simhash import keep_first


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the line frequencies reject go; lines
    over the limit are cut from the texts of the others."""
    return clean_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no known language go."""
    return keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, tokenised and packed into windows."""
    return pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

# SQL has neither the fingerprints' hash nor the tokenizer: tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline")
    return docs
