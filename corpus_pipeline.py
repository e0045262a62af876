"""The corpus pipeline: documents to a training mix, in stages that each work on all the one
before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. `run` writes what a stage keeps to the shared folder and reads it back.
Nulls, empty texts, repeated rows and empty tables are handled as the operators' docstrings
say: a null or empty text fails the quality rules and goes first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tertulia.llm import decontaminate, line_dedup, mixing, near_dup, quality
from tertulia.sources.shared import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.passing(docs)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that are boilerplate of their source."""
    return line_dedup.without_boilerplate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each group of near duplicates."""
    return near_dup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.without_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, in training order, with what it takes of each."""
    return mixing.mixed(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", drop_boilerplate),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing to target weights", mix),
]

#: Components of near duplicates and hash order are not for SQL; tests hold every stage
#: against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
