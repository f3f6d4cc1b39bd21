"""Kafka topics. Thin, because the connector is a separate Spark package (spark-sql-kafka-0-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from retailloom.schemas import SALES_TOPIC


def topic_stream(spark: SparkSession, servers: str, topic: str = SALES_TOPIC,
                 starting: str = "latest") -> DataFrame:
    """The messages of a topic; the text is in ``value``."""
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting)
            .load())
