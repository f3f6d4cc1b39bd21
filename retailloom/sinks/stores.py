"""Where results go: a lake folder or a serving database."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from retailloom.sinks.tables import counted
from retailloom.sources.files import names, put_if_absent, read_text, remove

BATCH = ("query_id", "batch_id")
FOLDED, REBUILT = "folded", "rebuilt"


def _stamped(df: DataFrame, query_id: str, batch_id: int) -> DataFrame:
    return (df.withColumn("query_id", F.lit(query_id))
            .withColumn("batch_id", F.lit(batch_id).cast("bigint")))


@dataclass(frozen=True)
class Part:
    """One written folder of a batch table: the rows of a batch, or those that a fold put together."""

    query_id: str
    batch_id: int
    attempt: str
    rows: int

    @property
    def batch(self) -> tuple[str, int]:
        return self.query_id, self.batch_id

    @property
    def batch_folder(self) -> str:
        return f"query_id={self.query_id}/batch_id={self.batch_id}"

    @property
    def folder(self) -> str:
        return f"{self.batch_folder}/attempt={self.attempt}"


@dataclass(frozen=True)
class Manifest:
    """What a batch table consists of. ``through`` names each query's last batch that a fold has taken in;
    ``retired`` lists folders that no longer belong to the table, with the version that let go of them."""

    version: int = 0
    parts: tuple[Part, ...] = ()
    through: dict[str, int] = field(default_factory=dict)
    retired: tuple[tuple[str, int], ...] = ()

    def holds(self, query_id: str, batch_id: int) -> bool:
        return batch_id <= self.through.get(query_id, -1) or any(p.batch == (query_id, batch_id) for p in self.parts)

    def text(self) -> str:
        return json.dumps({"version": self.version, "through": self.through, "retired": self.retired,
                           "parts": [[p.query_id, p.batch_id, p.attempt, p.rows] for p in self.parts]})

    @staticmethod
    def parse(text: str) -> Manifest:
        known = json.loads(text)
        return Manifest(known["version"], tuple(Part(*p) for p in known["parts"]), known["through"],
                        tuple((folder, version) for folder, version in known["retired"]))


def like_sized(parts: Sequence[Part], small: int) -> list[list[Part]]:
    """Which parts to write as one. Parts of a size class (rows by powers of two, all up to ``small`` in the lowest)
    go together as soon as there are two, and so do what comes of them and the next class. So a row is written again
    only when its part at least doubles."""
    classes: dict[int, list[list[Part]]] = {}
    for part in parts:
        classes.setdefault(max(1, part.rows // small).bit_length(), []).append([part])
    level = 0
    while level <= max(classes, default=0):
        together = classes.get(level, [])
        if len(together) > 1:
            group = [part for own in together for part in own]
            rows = sum(part.rows for part in group)
            classes[level] = []
            classes.setdefault(max(level + 1, max(1, rows // small).bit_length()), []).append(group)
        level += 1
    return [group for groups in classes.values() for group in groups if len(group) > 1]


@dataclass
class Lake:
    """Parquet tables below one folder.

    A batch table is what its newest manifest lists, ``<table>/_versions/<number>.json``. Every writer writes a folder
    of its own first and then puts the next manifest, which succeeds for one of those who try the same number; the
    others look again. So readers see a table before or after a batch or a fold, never between, wherever a writer
    breaks off. Parts of up to ``small`` rows are put together at every fold.
    """

    root: str
    small: int = 1 << 16

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def replace(self, df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").parquet(self.path(name))

    def drop(self, spark: SparkSession, name: str) -> None:
        """Remove a table: its manifests first, so that no reader finds one without its folders."""
        remove(spark, self.path(f"{name}/_versions"))
        remove(spark, self.path(name))

    def manifest(self, spark: SparkSession, name: str) -> Manifest:
        folder = self.path(f"{name}/_versions")
        numbers = [int(found.removesuffix(".json")) for found in names(spark, folder) if found.endswith(".json")]
        return Manifest.parse(read_text(spark, f"{folder}/{max(numbers)}.json")) if numbers else Manifest()

    def _commit(self, spark: SparkSession, name: str, change: Callable[[Manifest], Manifest | None]) -> Manifest:
        """Put the manifest that ``change`` makes of the newest one; again from the start if another came first."""
        while True:
            old = self.manifest(spark, name)
            new = change(old)
            if new is None:
                return old
            new = replace(new, version=old.version + 1)
            if put_if_absent(spark, self.path(f"{name}/_versions/{new.version}.json"), new.text()):
                return new

    def _written(self, df: DataFrame, name: str, query_id: str, batch_id: int) -> Part:
        part = Part(query_id, batch_id, f"a{uuid.uuid4().hex}", 0)
        rows = counted(df, lambda seen: seen.write.parquet(self.path(f"{name}/{part.folder}")))
        return replace(part, rows=rows)

    def _clean(self, spark: SparkSession, name: str, part: Part) -> None:
        """Remove what broken attempts at the same batch have left."""
        folder = self.path(f"{name}/{part.batch_folder}")
        for found in names(spark, folder):
            if f"{part.batch_folder}/{found}" != part.folder:
                remove(spark, f"{folder}/{found}")

    def append_batch(self, df: DataFrame, name: str, query_id: str, batch_id: int,
                     keys: Sequence[str] = ()) -> None:
        """Write one micro-batch: a repeated batch replaces itself, one that a fold has taken in adds nothing."""
        spark = df.sparkSession
        if self.folded_in(spark, name, query_id, batch_id):
            return
        part = self._written(df.drop(*BATCH), name, query_id, batch_id)
        self._commit(spark, name, lambda old: replace(
            old, parts=(*[p for p in old.parts if p.batch != part.batch], part)))
        self._clean(spark, name, part)

    def has_batch(self, spark: SparkSession, name: str, query_id: str, batch_id: int) -> bool:
        return self.manifest(spark, name).holds(query_id, batch_id)

    def folded_in(self, spark: SparkSession, name: str, query_id: str, batch_id: int) -> bool:
        """Whether a fold has taken the batch in. Folds leave each query's last batch, so later ones have come."""
        return batch_id <= self.manifest(spark, name).through.get(query_id, -1)

    def replace_batches(self, df: DataFrame, name: str) -> None:
        """One part in place of all."""
        spark = df.sparkSession
        number = max((p.batch_id for p in self.manifest(spark, name).parts if p.query_id == REBUILT), default=-1) + 1
        part = self._written(df.drop(*BATCH), name, REBUILT, number)
        self._retire(spark, name, lambda old: replace(old, parts=(part,)), 0)

    def fold(self, spark: SparkSession, name: str, schema: StructType,
             sums: Callable[[DataFrame], DataFrame] | None = None, keep: int = 0) -> int:
        """Put parts of like size together, but for each query's last batch, which may still be repeated; returns the
        rows written.

        ``sums`` adds up what the parts hold. Folders that a fold lets go of are removed once ``keep`` more versions
        have come, so that readers under way can finish.
        """
        old = self.manifest(spark, name)
        last = {p.query_id: max(q.batch_id for q in old.parts if q.query_id == p.query_id) for p in old.parts}
        ready = [p for p in old.parts if p.query_id in (FOLDED, REBUILT) or p.batch_id < last[p.query_id]]
        number = max((p.batch_id for p in old.parts if p.query_id == FOLDED), default=-1)
        groups, written = like_sized(ready, self.small), []
        for group in groups:
            number += 1
            rows = self._read(spark, name, schema, group).drop(*BATCH)
            written.append(self._written(sums(rows) if sums else rows, name, FOLDED, number))
        gone = {part for group in groups for part in group}
        through = {}
        for part in gone:
            if part.query_id not in (FOLDED, REBUILT):
                through[part.query_id] = max(part.batch_id, through.get(part.query_id, -1))

        def folded(now: Manifest) -> Manifest | None:
            if not gone <= set(now.parts):  # another fold or a rebuild was first
                return None
            ahead = {q: max(n, now.through.get(q, -1)) for q, n in through.items()}
            return replace(now, parts=(*[p for p in now.parts if p not in gone], *written), through=now.through | ahead)

        self._retire(spark, name, folded if gone else lambda now: None, keep)
        for part in written:
            self._clean(spark, name, part)
        return sum(part.rows for part in written)

    def _retire(self, spark: SparkSession, name: str, change: Callable[[Manifest], Manifest | None], keep: int) -> None:
        """Commit a change, then remove the folders that the table let go of ``keep`` versions ago or earlier."""
        def purge(known: Manifest) -> None:
            live = {p.batch_folder for p in known.parts}
            for folder, version in known.retired:
                if version <= known.version - keep and folder not in live:
                    remove(spark, self.path(f"{name}/{folder}"))
            for number in range(known.version - keep - 1, 0, -1):
                found = f"{number}.json"
                if found not in present:
                    break
                remove(spark, self.path(f"{name}/_versions/{found}"))

        def retired(now: Manifest) -> Manifest | None:
            new = change(now)
            if new is None:
                return None
            gone = [p.batch_folder for p in now.parts if p not in new.parts]
            waiting = [(folder, version) for folder, version in now.retired if version > now.version - keep]
            return replace(new, retired=(*waiting, *[(folder, now.version + 1) for folder in gone]))

        present = set(names(spark, self.path(f"{name}/_versions")))
        purge(self.manifest(spark, name))
        done = self._commit(spark, name, retired)
        purge(done)

    def _read(self, spark: SparkSession, name: str, schema: StructType, parts: Sequence[Part]) -> DataFrame:
        stamped = StructType([f for f in schema if f.name not in BATCH]
                             + [StructField("query_id", StringType()), StructField("batch_id", LongType())])
        if not parts:
            return spark.createDataFrame([], stamped)
        folders = [self.path(f"{name}/{part.folder}") for part in parts]
        return (spark.read.schema(stamped).option("basePath", self.path(name)).parquet(*folders)
                .select(*stamped.fieldNames()))

    def read_batches(self, spark: SparkSession, name: str, schema: StructType) -> DataFrame:
        """All batches of a table as its newest manifest has them; no rows while nothing is written."""
        return self._read(spark, name, schema, self.manifest(spark, name).parts)


@dataclass
class Jdbc:
    """Tables of a serving database. ``connections`` bounds the parallel writers."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    connections: int = 8

    def replace(self, df: DataFrame, name: str) -> None:
        """Refill a table in place, keeping its indexes and grants."""
        (df.write.mode("overwrite").option("truncate", True).option("numPartitions", self.connections)
         .jdbc(self.url, name, properties=self.properties))

    def append_batch(self, df: DataFrame, name: str, query_id: str, batch_id: int,
                     keys: Sequence[str] = ()) -> None:
        """Append the rows of one micro-batch that an earlier, interrupted try has not written yet."""
        rows = _stamped(df, query_id, batch_id)
        on = [*BATCH, *keys]
        # Appending no rows creates the table where it is missing, and changes nothing where it is there.
        rows.limit(0).write.mode("append").jdbc(self.url, name, properties=self.properties)
        written = df.sparkSession.read.jdbc(
            self.url, f"(select {', '.join(on)} from {name} "
                      f"where batch_id = {int(batch_id)} and query_id = '{query_id}') q",
            properties=self.properties)
        found = written.toDF(*[f"_{column}" for column in on])
        same = [rows[column].eqNullSafe(found[f"_{column}"]) for column in on]
        (rows.join(found, same, "left_anti").select(rows.columns)
         .write.mode("append").option("numPartitions", self.connections)
         .jdbc(self.url, name, properties=self.properties))
