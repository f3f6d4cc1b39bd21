"""The stored periods, one table a level: appended when they close, repaired when sales of closed days arrive.

The tables are partitioned by the year in which a period starts, so that a repair rewrites the years it touches and
leaves the files of all others as they are.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from retailloom.operators.rollup import PARENT, closed, late_rows, roll_up, touched, unseen, within
from retailloom.schemas import PERIOD
from retailloom.session import materialize
from retailloom.sinks.tables import append_counted, ensure_table, overwrite_partitions

YEAR = "period_year"


def create(spark: SparkSession, table: str) -> None:
    ensure_table(spark, table, StructType([*PERIOD.fields, StructField(YEAR, IntegerType())]), [YEAR])


def stored(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).select(*PERIOD.names)


def with_year(periods: DataFrame) -> DataFrame:
    return periods.select(*PERIOD.names, F.year("period").alias(YEAR))


def replace(periods: DataFrame, table: str) -> None:
    with_year(periods).write.mode("overwrite").format("parquet").partitionBy(YEAR).saveAsTable(table)


def level_rows(days: DataFrame, tables: dict[str, str], level: str) -> DataFrame:
    """All periods of a level: days as given, larger ones from the stored smaller ones."""
    return days if level == "day" else roll_up(stored(days.sparkSession, tables[PARENT[level]]), level)


def append_closed(days: DataFrame, tables: dict[str, str], current: date) -> dict[str, int]:
    """Add the newly closed periods of every level; returns how many each got."""
    added = {}
    for level, table in tables.items():
        last = stored(days.sparkSession, table).agg(F.max("period").alias("last")).first()["last"]
        rows = unseen(closed(level_rows(days, tables, level), level, current), last)
        added[level] = append_counted(with_year(rows), table, [YEAR])
    return added


def repair(days: DataFrame, tables: dict[str, str]) -> dict[str, int]:
    """Bring stored periods in line with ``days`` by way of the changed days alone; returns the periods repaired.

    A changed day (also one that was not stored at all) makes anew itself and the week, month, quarter and year that
    hold it, each from the stored smaller periods. Periods after a level's last stored one are left to
    ``append_closed``, so none is skipped there. Breaking off between two levels leaves the upper ones as they were
    while the days are already right; ``rebuild`` mends that.
    """
    spark = days.sparkSession
    changed = materialize(late_rows(days, stored(spark, tables["day"])).select(*PERIOD.names), "changed_days")
    repaired = {}
    for level, table in tables.items():
        present = spark.table(table)
        made = changed if level == "day" else roll_up(
            within(stored(spark, tables[PARENT[level]]), touched(changed, level), level), level)
        last = present.agg(F.max("period")).scalar()
        made = materialize(with_year(made.where(F.col("period") <= last)), f"repaired_{level}")
        repaired[level] = made.count()
        if repaired[level]:
            others = present.join(made.select(YEAR).distinct(), YEAR, "left_semi").join(
                made.select("period"), "period", "left_anti")
            overwrite_partitions(others.select(*made.columns).unionByName(made), table, [YEAR])
    return repaired
