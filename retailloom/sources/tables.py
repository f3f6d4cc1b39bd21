"""Operational tables by high-water mark, and the catalog."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retailloom.functions.columns import id_number

MOST_RANGES = 32  # ranges of ids that a scan is given as they are


def rows_after(table: DataFrame, last_id: int | Column, column: str = "id") -> DataFrame:
    """Rows added since ``last_id``; the bound is pushed to the scan."""
    return table.where(F.col(column) > F.lit(last_id))


def _apart(ranges: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same ids as ranges in order that neither overlap nor touch."""
    out: list[tuple[int, int]] = []
    for low, high in sorted((int(low), int(high)) for low, high in ranges if low <= high):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _grouped(ranges: list[tuple[int, int]], most: int = MOST_RANGES) -> list[list[tuple[int, int]]]:
    """At most ``most`` groups of neighbouring ranges."""
    size = max(1, -(-len(ranges) // most))
    return [ranges[i:i + size] for i in range(0, len(ranges), size)]


def rows_between(table: DataFrame, ranges: Sequence[tuple[int, int]], column: str = "id") -> DataFrame:
    """Rows whose id lies in one of the ranges, ends included; the ranges are pushed to the scan.

    More than ``MOST_RANGES`` are pushed in groups and then joined: a range of up to 2^k ids touches at most two
    of the blocks of 2^k ids, and a row is looked up in its own block of each size that occurs. A block holds at most three of
    them, so the look-up stays small however many ranges there are. They come from the driver, and go back by broadcast.
    """
    known = _apart(ranges)
    groups = _grouped(known)
    near = [F.col(column).between(group[0][0], group[-1][1]) for group in groups]
    rows = table.where(reduce(Column.__or__, near, F.lit(False)))
    if len(groups) == len(known):
        return rows
    placed = {(k, low, high, block) for low, high in known for k in [(high - low).bit_length()]
              for block in (low >> k, high >> k)}
    blocks = F.broadcast(table.sparkSession.createDataFrame(
        sorted(placed), "_size int, _low long, _high long, _block long"))
    sizes = F.array(*[F.lit(k) for k in sorted({k for k, *_ in placed})])
    looked_up = rows.withColumn("_size", F.explode(sizes)).withColumn("_block", F.expr(f"shiftright(CAST(`{column}` AS BIGINT), _size)"))
    found = looked_up.join(blocks, ["_size", "_block"]).where(F.col(column).between(F.col("_low"), F.col("_high")))
    return found.select(*table.columns)


def jdbc_rows_between(spark: SparkSession, url: str, table: str, ranges: Sequence[tuple[int, int]], properties: dict[str, str],
                      column: str = "id") -> DataFrame:
    """The same over JDBC, one task per range, or per group of neighbouring ones if there are more than ``MOST_RANGES``."""
    tests = [" or ".join(f"{column} between {low} and {high}" for low, high in group) for group in _grouped(_apart(ranges))]
    return spark.read.jdbc(url, table, predicates=tests, properties=properties)


def islands(rows: DataFrame, column: str = "id", block: int = 1 << 16) -> list[tuple[int, int]]:
    """The ids of ``rows`` as runs without gaps, in order. Found per block of ids and joined at the blocks' ends, so what
    is collected is a pair per gap and block."""
    ids = rows.select(F.col(column).cast("bigint").alias("id")).where(F.col("id").isNotNull()).distinct()
    placed = ids.withColumn("block", F.floor(F.col("id") / block))
    number = F.row_number().over(Window.partitionBy("block").orderBy("id"))
    found = placed.withColumn("run", F.col("id") - number).groupBy("block", "run").agg(
        F.min("id").alias("low"), F.max("id").alias("high"))
    out: list[tuple[int, int]] = []
    for low, high in sorted((r["low"], r["high"]) for r in found.collect()):
        if out and out[-1][1] == low - 1:
            out[-1] = (out[-1][0], high)
        else:
            out.append((low, high))
    return out


def high_water_mark(rows: DataFrame, last_id: int | Column, column: str = "id") -> DataFrame:
    """Rows read and the mark for the next read; the old mark when nothing came."""
    return rows.agg(F.count(F.lit(1)).alias("rows_read"),
                    F.coalesce(F.max(column), F.lit(last_id)).cast("bigint").alias("last_id"))


def jdbc_rows_after(spark: SparkSession, url: str, table: str, last_id: int, properties: dict[str, str],
                    column: str = "id", partitions: int = 8) -> DataFrame:
    """The same over JDBC. The new mark is read first and bounds the scan on both sides, so rows that
    arrive meanwhile are left for the next read; the range is split over ``partitions`` tasks."""
    last_id = int(last_id)
    bounds = f"(select max({column}) as high from {table} where {column} > {last_id}) bounds"
    high = spark.read.jdbc(url, bounds, properties=properties).first()["high"]
    high = last_id if high is None else int(high)
    rows = f"(select * from {table} where {column} > {last_id} and {column} <= {high}) q"
    return spark.read.jdbc(url, rows, column=column, lowerBound=last_id + 1, upperBound=high + 1,
                           numPartitions=max(1, min(partitions, high - last_id)), properties=properties)


def next_id(table: DataFrame, column: str, prefix: str) -> DataFrame:
    """The highest running number among ids of the given prefix and the next free one (0 when none)."""
    return table.agg(F.max(id_number(F.col(column), prefix)).alias("last_id")).select(
        "last_id", F.coalesce(F.col("last_id") + 1, F.lit(0)).cast("bigint").alias("next_id"))


def table_names(spark: SparkSession, database: str, prefixes: Sequence[str] = (),
                names: Sequence[str] = ()) -> list[str]:
    """Tables of a database by prefix or by name, sorted."""
    found = (t.name for t in spark.catalog.listTables(database) if not t.isTemporary)
    return sorted(name for name in found if name.startswith(tuple(prefixes)) or name in names)


def partitions(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {table}")


def has_table(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def matching(tables: DataFrame, column: str, patterns: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Rows whose name is LIKE one of the patterns or in the list."""
    test: Column = F.col(column).isin(*names)
    for pattern in patterns:
        test = test | F.col(column).like(pattern)
    return tables.where(test)
