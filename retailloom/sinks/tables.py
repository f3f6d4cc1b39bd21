"""Warehouse tables. ``table`` is ``database.name``; all writes are Parquet."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from retailloom.operators.dedup import absent
from retailloom.session import with_setting

CODEC = "spark.sql.parquet.compression.codec"


def ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def ensure_table(spark: SparkSession, table: str, schema: StructType, partitioned_by: Sequence[str] = ()) -> None:
    """Create an empty table once."""
    parts = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl(schema)}) USING parquet{parts}")


def replace_table(df: DataFrame, table: str) -> None:
    df.write.mode("overwrite").format("parquet").saveAsTable(table)


def append_partitioned(df: DataFrame, table: str, partitioned_by: Sequence[str], sort: Sequence[str] = ()) -> None:
    """Append to a partitioned table.

    The REBALANCE hint gathers each partition's rows into well-sized files and lets AQE split a partition
    that holds most of the rows over many tasks. Files are written with zstd: the fact takes three fifths of what it takes by default.
    """
    writer = rebalanced(df, partitioned_by).sortWithinPartitions(*partitioned_by, *sort).write.mode("append")
    with with_setting(df.sparkSession, CODEC, "zstd"):  # an option of the writer does not reach a table that is there
        writer.format("parquet").partitionBy(*partitioned_by).saveAsTable(table)


def rebalanced(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *[F.col(name) for name in columns])


def overwrite_day(df: DataFrame, table: str, column: str, day: date) -> None:
    """Replace the partition of one day; the other days stay. Columns are matched by name."""
    spark = df.sparkSession
    rest = ", ".join(f"`{name}`" for name in spark.table(table).columns if name != column)
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({column} = DATE'{day.isoformat()}') "
              f"SELECT {rest} FROM {{rows}}", rows=df)


def counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write, and return the number of rows as counted by the write itself."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def overwrite_partitions(df: DataFrame, table: str, partitioned_by: Sequence[str]) -> None:
    """Replace the partitions that ``df`` has rows of; the others' files stay. ``df`` may read the table itself: the new
    files are staged and put in place when all are written. An unpartitioned table is refused, as all of it would go."""
    spark = df.sparkSession
    partitions = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if partitions != list(partitioned_by):
        raise ValueError(f"{table} is partitioned by {partitions}, not by {list(partitioned_by)}")
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        df.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(setting, before)


def append_counted(df: DataFrame, table: str, partitioned_by: Sequence[str] = ()) -> int:
    return counted(df, lambda rows: rows.write.mode("append").format("parquet").partitionBy(
        *partitioned_by).saveAsTable(table))


def insert_absent(df: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Add rows with new keys; rows already stored keep their values."""
    spark = df.sparkSession
    ensure_table(spark, table, df.schema)
    absent(df, spark.table(table), keys).write.mode("append").format("parquet").saveAsTable(table)
