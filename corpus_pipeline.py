"""From raw documents to packed training sequences, in five stages, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from retailloom.llm import decontaminate, near_duplicates, packing, pii, toxicity
from retailloom.llm.common import table
from retailloom.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels of other documents, takes for toxic go."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by five-word shingles at 0.8, the one of the smallest id stays."""
    return near_duplicates.without_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; every document stays."""
    return pii.redacted(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 4,096."""
    return packing.pack(docs).drop("row")


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_contaminated),
          ("personal_data", redact_personal_data), ("packing", pack_sequences)]

# Trained models and the packing plan have no SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
