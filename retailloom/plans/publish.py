"""Copy the marts to the serving store."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from retailloom.functions.names import vietnamese
from retailloom.plans.periods import YEAR
from retailloom.sinks.tables import counted
from retailloom.sources.tables import table_names

PREFIXES = ("report_", "agg_")
ALSO = ("inventory", "dim_customer")


def marts(spark: SparkSession, database: str) -> list[str]:
    return table_names(spark, database, PREFIXES, ALSO)


@dataclass
class InVietnamese:
    """A store whose live tables go by the names that existing dashboards query."""

    target: object

    def append_batch(self, df: DataFrame, name: str, query_id: str, batch_id: int, keys: Sequence[str] = ()) -> None:
        shown, table = vietnamese(df, name)
        self.target.append_batch(shown, table, query_id, batch_id, keys)


def publish(spark: SparkSession, database: str, target, in_vietnamese: bool = False) -> dict[str, int]:
    """Refill every mart in ``target`` and return the rows of each."""
    rows = {}
    for table in marts(spark, database):
        df: DataFrame = spark.table(f"{database}.{table}").drop(YEAR)
        shown, name = vietnamese(df, table) if in_vietnamese else (df, table)
        rows[name] = counted(shown, lambda written, name=name: target.replace(written, name))
    return rows
