"""From the operational systems to landing files: invoices by file stream, tables by high-water mark."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from retailloom.operators.normalize import (
    flatten_invoices, normalize_ecommerce, normalize_erp, normalize_pos, parse_invoices)
from retailloom.schemas import INVENTORY_TOPIC, SALES_TOPIC, SENT_KIND
from retailloom.sinks.stores import Lake
from retailloom.sources.files import exists, json_lines_stream, land as land_rows
from retailloom.sources.tables import islands, jdbc_rows_after, jdbc_rows_between, rows_after, rows_between
from retailloom.streaming.live import start_topic

MARK = "name string, rows_read bigint, last_id bigint, turn bigint, gaps array<struct<low: bigint, high: bigint, turn: bigint>>"
PATIENCE = 96  # turns that a missing id is looked for: a day of quarter hours


def take_invoices(spark: SparkSession, folder: str, landing: str, checkpoint: str, files_per_batch: int = 1000) -> None:
    """Invoice messages, one to a line of text, to landing rows; each file once. A batch repeated after a crash lands
    again, and the ingest leaves out what it has.

    Batches are appended, as a file stream's own sink would keep a list of its files in the folder, and readers would
    then see no others there.
    """
    def land(batch: DataFrame, _: int) -> None:
        land_rows(normalize_pos(flatten_invoices(parse_invoices(batch))), landing)

    messages = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    (messages.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


@dataclass
class Feed:
    """One operational table: how the rows after an id and those in ranges of ids are read, and what they are called on
    landing."""

    name: str
    read: Callable[[int], DataFrame]
    between: Callable[[list[tuple[int, int]]], DataFrame]
    normalise: Callable[[DataFrame], DataFrame]
    column: str = "id"


def stored_table(name: str, table: Callable[[], DataFrame], normalise: Callable[[DataFrame], DataFrame]) -> Feed:
    return Feed(name, lambda last: rows_after(table(), last), lambda ranges: rows_between(table(), ranges), normalise)


def database_table(spark: SparkSession, name: str, url: str, properties: dict[str, str],
                   normalise: Callable[[DataFrame], DataFrame]) -> Feed:
    return Feed(name, lambda last: jdbc_rows_after(spark, url, name, last, properties),
                lambda ranges: jdbc_rows_between(spark, url, name, ranges, properties), normalise)


# The operational tables and what becomes of their rows.
NORMALISED: dict[str, Callable[[DataFrame], DataFrame]] = {
    "sales": normalize_erp, "ecommerce_orders": normalize_ecommerce, "kho_chuyendong": lambda rows: rows,
}


@dataclass
class Taken:
    """What of a table has landed: all ids up to ``last`` but for the gaps, each with the turn that found it."""

    last: int = 0
    turn: int = 0
    gaps: tuple[tuple[int, int, int], ...] = ()

    def after(self, found: list[tuple[int, int]], patience: int) -> Taken:
        """After one more turn that landed the ids ``found``, as runs in order; gaps older than ``patience`` are closed."""
        turn, last, gaps = self.turn + 1, self.last, []
        at = 0  # of ``found``; gaps are in order too, so each run is met once, or at the ends of the gaps it spans
        for low, high, since in self.gaps:
            start = low
            while at < len(found) and found[at][1] < low:
                at += 1
            while at < len(found) and found[at][0] <= high:
                first, end = found[at]
                if first > start:
                    gaps.append((start, first - 1, since))
                start = end + 1
                if end > high:
                    break
                at += 1
            if start <= high:
                gaps.append((start, high, since))
        for first, end in found:
            if end > last:
                if first > last + 1 and last:
                    gaps.append((last + 1, first - 1, turn))
                last = end
        return Taken(last, turn, tuple(gap for gap in gaps if turn - gap[2] < patience))


def taken(spark: SparkSession, marks: Lake, name: str) -> Taken:
    path = marks.path(f"marks/{name}")
    rows = spark.read.schema(MARK).json(path).orderBy(F.desc_nulls_last("turn"), F.desc("last_id")).limit(1).collect() if exists(
        spark, path) else []
    if not rows:
        return Taken()
    return Taken(rows[0]["last_id"], rows[0]["turn"] or 0, tuple(tuple(gap) for gap in rows[0]["gaps"] or ()))


def last_mark(spark: SparkSession, marks: Lake, name: str) -> int:
    """The highest id that was landed; 0 before the first time."""
    return taken(spark, marks, name).last


def take_table(spark: SparkSession, feed: Feed, landing: str, marks: Lake, patience: int = PATIENCE) -> int:
    """The rows after the highest landed id, and those that have come since in gaps below it, to landing files; then the
    new mark. Returns the highest id.

    A row that is committed after one with a higher id was read is found in its gap: each turn looks at the gaps of the
    last ``patience`` turns (ids that were never given stay gaps; the first turn takes a table's first id as its start).
    The ids are read alone first, then the rows up to the highest of them. After a crash before the mark the rows come
    again, and the ingest leaves out what it has: nothing is lost, nothing counts twice.
    """
    before = taken(spark, marks, feed.name)
    rows = feed.read(before.last)
    if before.gaps:
        rows = rows.unionByName(feed.between([(low, high) for low, high, _ in before.gaps]))
    found = islands(rows, feed.column)
    if not found and not before.gaps:
        return before.last
    after = before.after(found, patience)
    if found:
        land_rows(feed.normalise(rows.where(F.col(feed.column) <= F.lit(after.last))), landing)
    read = sum(high - low + 1 for low, high in found)
    spark.createDataFrame([(feed.name, read, after.last, after.turn, list(after.gaps))], MARK).coalesce(1).write.mode(
        "append").json(marks.path(f"marks/{feed.name}"))
    return after.last


def topic_of(rows: DataFrame) -> str:
    """Stock movements have a topic of their own; all sales share one."""
    return INVENTORY_TOPIC if {"kind", SENT_KIND} & set(rows.columns) else SALES_TOPIC


def publish(rows: DataFrame, servers: str, checkpoint: str, key: str | None = None, **trigger):
    """Rows as messages to the topic of their kind."""
    return start_topic(rows, servers, topic_of(rows), checkpoint, key, **trigger)


def publish_folder(spark: SparkSession, folder: str, schema: StructType, servers: str, checkpoint: str,
                   files_per_batch: int = 1000) -> None:
    """The JSON Lines files of a folder to the topic of their kind, each file once; fields that a row lacks are left out."""
    rows = json_lines_stream(spark, folder, None, files_per_batch, schema)
    publish(rows, servers, checkpoint, "txn_id" if "txn_id" in rows.columns else "id", availableNow=True).awaitTermination()
