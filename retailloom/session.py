"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import AbstractContextManager, contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Only settings that differ from Spark's defaults. Join sides are broadcast by Spark's own size check
# (autoBroadcastJoinThreshold and AQE run-time sizes); larger sides fall back to a sort-merge join whose
# hot partitions AQE splits.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    STATE_STORE: ROCKSDB,
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"
RELEASE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
CELL, CELLS, SLICE_BYTES = "_cell", 8, 16 << 20


def session(app: str = "retailloom", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the engine's settings; ``settings`` uses ``_`` for ``.`` and wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    merged = {**SETTINGS, **{key.replace("_", "."): value for key, value in settings.items()}}
    for key, value in merged.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _local_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"retailloom-{application}-")


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; a temporary one only in local mode."""
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    return _local_dir(spark.sparkContext.applicationId)


@contextmanager
def with_setting(spark: SparkSession, name: str, value: str | bool | int) -> Iterator[None]:
    """A setting of the session for a while."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffles_released(spark: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files go when the query that made them ends, not when the driver's next collection finds them unused.
    What is read more than once inside must be persisted, or is shuffled anew."""
    return with_setting(spark, RELEASE_SHUFFLES, True)


def state_on_disk(spark: SparkSession) -> AbstractContextManager[None]:
    """Streams that are started inside keep their state in RocksDB, whatever the session is set to: Spark's own default holds every
    key in the executors' heaps, in two versions. A stream with a checkpoint goes on with the store that it has."""
    return with_setting(spark, STATE_STORE, ROCKSDB)


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Cut the lineage by a written table: later passes read it and survive lost executors."""
    path = scratch(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@dataclass(frozen=True)
class Dealt:
    """A table in ``CELLS`` folders, each row's by the hash of the columns ``by``: written in one or more parts, read whole
    or slice by slice, each slice removed once it is done with. So what a step needs besides its input does not add up.
    Rows carry their cell as ``CELL``."""

    spark: SparkSession
    path: str
    by: tuple[str, ...]
    schema: StructType

    def cell(self) -> Column:
        return F.pmod(F.xxhash64(*self.by), F.lit(CELLS)).cast("int")

    def add(self, rows: DataFrame) -> None:
        # A writer for each cell: else every task sorts its rows by cell, and spills them.
        with with_setting(self.spark, OPEN_WRITERS, CELLS + 1):
            (rows.select(*self.schema.fieldNames()).withColumn(CELL, self.cell()).write.mode("append")
             .option("compression", "zstd").partitionBy(CELL).parquet(self.path))

    def rows(self, cells: Sequence[int] | None = None) -> DataFrame:
        every = self.spark.read.schema(StructType([*self.schema, StructField(CELL, IntegerType())])).parquet(self.path)
        return every if cells is None else every.where(F.col(CELL).isin(*cells))

    def slices(self) -> list[list[int]]:
        """The cells that hold rows, in groups of at least ``SLICE_BYTES``."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        system = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        groups: list[list[int]] = []
        size = SLICE_BYTES
        for number in range(CELLS):
            cell = self.spark._jvm.org.apache.hadoop.fs.Path(place, f"{CELL}={number}")
            if not system.exists(cell):
                continue
            if size >= SLICE_BYTES:
                groups.append([])
                size = 0
            groups[-1].append(number)
            size += system.getContentSummary(cell).getLength()
        return groups

    def drop(self, cells: Sequence[int]) -> None:
        for number in cells:
            _remove(self.spark, f"{self.path}/{CELL}={number}")


@dataclass(frozen=True)
class Passing:
    """Tables that are read inside a block only: ``passing`` removes their folders at its end."""

    spark: SparkSession
    written: list[str] = field(default_factory=list)

    def _new(self, label: str) -> str:
        self.written.append(scratch(self.spark, label))
        return self.written[-1]

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        """``materialize`` inside the block."""
        path = self._new(label)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def dealt(self, rows: DataFrame, label: str, by: Sequence[str]) -> Dealt:
        """``rows``, written by the cells of ``by``; more may be added."""
        table = Dealt(self.spark, self._new(label), tuple(by), rows.schema)
        table.add(rows)
        return table


@contextmanager
def passing(spark: SparkSession) -> Iterator[Passing]:
    place = Passing(spark)
    try:
        yield place
    finally:
        for path in place.written:
            _remove(spark, path)


def unused_shuffles_go(spark: SparkSession) -> None:
    """A collection on the driver: Spark removes the shuffle files of queries that nothing refers to any more, such as those of
    a stream that has ended, and its heap shrinks to what is in use. Left alone it collects every half hour, while disks fill,
    and lets the heap grow to its limit with the remains of planned queries."""
    spark._jvm.System.gc()
