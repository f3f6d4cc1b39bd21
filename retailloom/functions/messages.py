"""JSON text to columns and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType


def to_messages(df: DataFrame, topic: str | None = None, key: str | None = None) -> DataFrame:
    """One JSON ``value`` per row, dates as ISO text, with the topic and key a Kafka writer understands."""
    columns = [F.to_json(F.struct("*")).alias("value")]
    if key:
        columns.insert(0, F.col(key).cast("string").alias("key"))
    if topic:
        columns.append(F.lit(topic).alias("topic"))
    return df.select(*columns)


def from_messages(messages: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """Columns of the JSON object in ``value``; a malformed message becomes a row of nulls.

    The object is unpacked by ``inline``: a filter on its fields stays above it, while one on
    ``select("m.*")`` would be pushed down together with a second parse of every message.
    """
    parsed = F.from_json(F.col(value).cast("string"), schema)
    return messages.select(F.inline(F.array(parsed)))


def split_array(messages: DataFrame, element: StructType, value: str = "value") -> DataFrame:
    """One row per element of the JSON array in ``value``."""
    parsed = F.from_json(F.col(value).cast("string"), ArrayType(element))
    return messages.select(F.inline(parsed))
