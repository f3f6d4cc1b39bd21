"""What the operators of this subpackage share: reading tables, row numbers, word splitting, fold rule."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailloom.session import materialize

# Rows of a labelled sample that a classifier is fitted on, and so the size bound of its broadcast.
SAMPLE_ROWS = 20_000


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    return rows.select(*columns) if columns else rows


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def in_test_fold(column: str = "doc_id") -> Column:
    """The rows whose labels are never learnt: crc32 of the id as text divisible by 5."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 5 == 0, F.lit(True))


def numbered(df: DataFrame, name: str, label: str) -> DataFrame:
    """The rows with a unique number each, written so that the numbers stay the same on every later read."""
    return materialize(df.withColumn(name, F.monotonically_increasing_id()), label)


def training_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Texts and labels to learn from: outside the test fold, at most ``rows``, taken in the order of a hash of
    the id, so that the sample is the same in every run and any sample is a fair one.

    The sampled ids and labels (16 bytes a row, so at most 16 x ``rows`` bytes) are broadcast: the documents are
    not shuffled for them.
    """
    chosen = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~in_test_fold())
              .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    return (docs.select("doc_id", text_or_empty().alias("text"))
            .join(F.broadcast(materialize(chosen, f"sample-{label}")), "doc_id"))


def as_text(column: str) -> Column:
    """A whole-number id as text, the form in which it goes through Python: a pandas column with a null turns whole
    numbers into floats, which hold no more than 53 bits."""
    return F.col(column).cast("long").cast("string").alias(column)


def as_numbers(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({column: F.col(column).cast("long") for column in columns})


def per_process(key, make: Callable):
    """What ``make`` returns, made once in this process. As functions travel to the workers by value, the globals of
    this package live for one task there; this outlives it."""
    kept = sys.modules.setdefault("_retailloom_worker", types.ModuleType("_retailloom_worker")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]
