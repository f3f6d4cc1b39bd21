"""Repair of closed periods by the days that changed."""

import glob
from datetime import date

import pytest
from pyspark.sql import functions as F

from retailloom.operators.rollup import LEVELS, closed
from retailloom.plans import periods
from retailloom.sinks.tables import ensure_table, overwrite_partitions
from tests.conftest import tuples

CURRENT = date(2027, 2, 3)
EARLY = [(date(2025, 12, 30), 10.0, 1.0, 1), (date(2026, 1, 2), 20.0, 2.0, 2), (date(2026, 12, 31), 5.0, -1.0, 1),
         (date(2027, 1, 1), 40.0, 4.0, 1), (date(2027, 1, 31), 50.0, 5.0, 5)]


def days(spark, rows):
    return spark.createDataFrame(rows, "period date, revenue double, profit double, row_count bigint")


@pytest.fixture
def tables(spark, tmp_path):
    name = f"repair_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}'")
    found = {level: f"{name}.agg_{level}" for level in LEVELS}
    for table in found.values():
        periods.create(spark, table)
    yield found
    spark.sql(f"DROP DATABASE {name} CASCADE")


def contents(spark, tables):
    return {level: tuples(periods.stored(spark, table)) for level, table in tables.items()}


def rebuilt(spark, rows, tables):
    for level, table in tables.items():
        periods.replace(closed(periods.level_rows(days(spark, rows), tables, level), level, CURRENT), table)
    return contents(spark, tables)


@pytest.mark.parametrize("late", [
    [(date(2027, 1, 1), 41.0, 5.0, 2)],  # its week began in the year before
    [(date(2026, 7, 3), 7.0, 0.5, 1)],  # a day, week, month and quarter that were not stored at all
    [(date(2025, 12, 31), 1.0, 1.0, 1), (date(2027, 1, 31), 51.0, 6.0, 6)],
    [(date(2024, 2, 29), 3.0, None, 1)],  # before all that is stored
])
def test_repair_equals_a_rebuild(spark, tables, late):
    periods.append_closed(days(spark, EARLY), tables, CURRENT)
    rows = [*[r for r in EARLY if r[0] not in {x[0] for x in late}], *late]
    assert periods.repair(days(spark, rows), tables)["day"] == len(late)
    assert contents(spark, tables) == rebuilt(spark, rows, tables)


def test_files_of_other_years_stay(spark, tables, tmp_path):
    periods.append_closed(days(spark, EARLY), tables, CURRENT)
    before = set(glob.glob(f"{tmp_path}/agg_*/*/*.parquet"))
    periods.repair(days(spark, [*EARLY, (date(2026, 7, 3), 7.0, 0.5, 1)]), tables)
    gone = before - set(glob.glob(f"{tmp_path}/agg_*/*/*.parquet"))
    assert gone and all("period_year=2026/" in path for path in gone)


def test_nothing_late_and_nothing_stored(spark, tables, tmp_path):
    assert set(periods.repair(days(spark, EARLY), tables).values()) == {0}
    periods.append_closed(days(spark, EARLY), tables, CURRENT)
    before = set(glob.glob(f"{tmp_path}/agg_*/*/*.parquet"))
    assert set(periods.repair(days(spark, EARLY), tables).values()) == {0}
    assert set(glob.glob(f"{tmp_path}/agg_*/*/*.parquet")) == before


def test_open_periods_are_left_to_the_rollup(spark, tables):
    periods.append_closed(days(spark, EARLY), tables, CURRENT)
    rows = [*EARLY, (date(2027, 1, 15), 1.0, 1.0, 1), (date(2027, 2, 3), 9.0, 9.0, 9)]
    periods.repair(days(spark, rows), tables)
    assert date(2027, 2, 3) not in {r[0] for r in contents(spark, tables)["day"]}
    later = date(2028, 1, 1)
    periods.append_closed(days(spark, rows), tables, later)
    assert (date(2027, 1, 1), 100.0, 19.0, 16) in contents(spark, tables)["year"]


def test_a_table_without_years_is_refused(spark, tables):
    plain = tables["day"].replace("agg_day", "plain")
    ensure_table(spark, plain, days(spark, EARLY).schema)
    with pytest.raises(ValueError):
        overwrite_partitions(periods.with_year(days(spark, EARLY)), plain, [periods.YEAR])
