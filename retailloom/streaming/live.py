"""Live statistics and loss alerts."""

from __future__ import annotations

import statistics
from collections import deque
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from retailloom.functions.columns import profit, whole, whole_number
from retailloom.functions.messages import from_messages, to_messages
from retailloom.schemas import ERP, EVENT
from retailloom.streaming.ingest import query_id

# The alert bound, the label, and the seconds between live points.
LOSS_THRESHOLD = -100
LOSS_LABEL = "LO NANG"
TRIGGER = "5 seconds"


def parse_events(messages: DataFrame) -> DataFrame:
    """Message text to typed sale columns."""
    return (from_messages(messages, EVENT)
            .withColumn("promotion", whole_number(F.col("promotion"), "bigint"))
            .withColumn("qty", whole_number(F.col("qty"), "bigint")))


def with_profit(sales: DataFrame, source: str | None = None) -> DataFrame:
    """Costed sales, of one source if given, with their profit."""
    costed = sales.where(F.col("cost").isNotNull())
    if source is not None:
        costed = costed.where(F.col("source") == source)
    return costed.withColumn("profit", profit())


def batch_stats(sales: DataFrame) -> DataFrame:
    """Rounded totals of one micro-batch; no row for an empty one."""
    return sales.agg(
        whole(F.sum("revenue")).alias("revenue"), whole(F.sum("profit")).alias("profit"),
        F.count(F.lit(1)).alias("txn_count")).where(F.col("txn_count") > 0)


def loss_alerts(sales: DataFrame, threshold: float = LOSS_THRESHOLD) -> DataFrame:
    """Sales that lose more than the threshold (strictly)."""
    return (sales.where(F.col("profit") < F.lit(threshold))
            .select("txn_id", "store_id", "region", "revenue", "cost", "profit"))


def write_batch(sales: DataFrame, target, query: str, batch_id: int,
                threshold: float = LOSS_THRESHOLD) -> None:
    """Statistics and alerts of one micro-batch, both from one read of it, stamped with the batch so that
    a repeated batch does not count twice. An empty batch writes no rows."""
    sales = sales.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        now = F.current_timestamp().alias("processed_at")
        target.append_batch(batch_stats(sales).select("*", now), "rt_stats", query, batch_id)
        target.append_batch(loss_alerts(sales, threshold).select(now, "*"), "rt_alerts", query, batch_id,
                            keys=["txn_id"])
    finally:
        sales.unpersist()


def start_dashboard(messages: DataFrame, target, checkpoint: str, threshold: float = LOSS_THRESHOLD,
                    **trigger) -> StreamingQuery:
    """Keep ``rt_stats`` and ``rt_alerts`` in ``target`` (a Lake or Jdbc) up to date."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, target, query_id(batch), batch_id, threshold)

    return (with_profit(parse_events(messages)).writeStream.foreachBatch(handle)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(**(trigger or {"processingTime": TRIGGER})).start())


class Pace(StreamingQueryListener):
    """Seconds that batches with rows took, from the trigger to the commit: the latest ``kept`` of them."""

    def __init__(self, kept: int = 1000):
        super().__init__()
        self.seconds: deque[float] = deque(maxlen=kept)
        self.rows = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if event.progress.numInputRows:
            self.seconds.append(event.progress.batchDuration / 1000)
            self.rows += event.progress.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def summary(self, within: float = 5.0) -> dict[str, float]:
        """Batches, all rows seen, the median and longest time, and how many batches took longer than ``within``."""
        taken = list(self.seconds)
        return {"batches": len(taken), "rows": self.rows, "median_s": statistics.median(taken) if taken else 0.0,
                "longest_s": max(taken, default=0.0), "late": sum(s > within for s in taken)}


@contextmanager
def watched(spark: SparkSession) -> Iterator[Pace]:
    """The pace of the session's streams while in the block. Spark reports in the background, so the last batch may be
    noted a moment after its commit."""
    pace = Pace()
    spark.streams.addListener(pace)
    try:
        yield pace
    finally:
        spark.streams.removeListener(pace)


def labelled_alerts(messages: DataFrame, threshold: float = LOSS_THRESHOLD) -> DataFrame:
    """Finance sales with a heavy loss, under a warning label."""
    alerts = loss_alerts(with_profit(parse_events(messages), source=ERP), threshold)
    return alerts.select(F.lit(LOSS_LABEL).alias("warning"), "*")


def start_alerts(messages: DataFrame, checkpoint: str, threshold: float = LOSS_THRESHOLD,
                 sink: str = "console", options: dict[str, str] | None = None, **trigger) -> StreamingQuery:
    """Print (or write to another sink) each heavy loss as it arrives."""
    writer = (labelled_alerts(messages, threshold).writeStream.outputMode("append").format(sink)
              .option("checkpointLocation", checkpoint).options(**(options or {"truncate": "false"})))
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def start_topic(rows: DataFrame, servers: str, topic: str, checkpoint: str, key: str | None = None,
                **trigger) -> StreamingQuery:
    """Publish rows as JSON messages to a Kafka topic."""
    return (to_messages(rows, topic, key).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": TRIGGER})).start())
