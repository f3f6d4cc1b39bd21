"""Days to weeks, months, quarters and years; each period is stored once, when it has closed."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailloom.functions.columns import period_start, whole

# What each level is summed from.
PARENT = {"week": "day", "month": "day", "quarter": "month", "year": "month"}
LEVELS = ("day", "week", "month", "quarter", "year")


def business_date(sales: DataFrame) -> DataFrame:
    """The latest sales day, one row. Reads a single column; null when there are no sales."""
    return sales.agg(F.max("txn_date").alias("business_date"))


def daily(sales: DataFrame) -> DataFrame:
    """Rounded revenue, rounded profit and rows per day."""
    return (sales.where(F.col("txn_date").isNotNull())
            .groupBy(F.col("txn_date").alias("period"))
            .agg(whole(F.sum("revenue")).alias("revenue"), whole(F.sum("profit")).alias("profit"),
                 F.sum("row_count").alias("row_count")))


def roll_up(periods: DataFrame, unit: str) -> DataFrame:
    """Sums of the smaller periods' stored (already rounded) values."""
    return (periods.groupBy(period_start(F.col("period"), unit).alias("period"))
            .agg(F.sum("revenue").alias("revenue"), F.sum("profit").alias("profit"),
                 F.sum("row_count").alias("row_count")))


def _day(value: date | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def closed(periods: DataFrame, unit: str, current: date | Column) -> DataFrame:
    """Periods that ended before the ``unit`` that holds ``current``.

    Works on smaller periods too: a day lies in a closed month exactly when it is before the current
    month's first day, so the bound can be put on the days, where it reaches the scan.
    """
    return periods.where(F.col("period") < period_start(_day(current), unit))


def unseen(periods: DataFrame, high_water_mark: date | Column | None) -> DataFrame:
    """Periods after the last stored one; all of them when nothing is stored."""
    if high_water_mark is None:
        return periods
    return periods.where(F.col("period") > _day(high_water_mark))


def closed_periods(sales: DataFrame, unit: str, current: date | Column) -> DataFrame:
    """The closed periods of one level straight from the sales, through the same chain of levels."""
    chain = [unit]
    while chain[0] != "day":
        chain.insert(0, PARENT[chain[0]])
    periods = closed(daily(sales), unit, current)
    for level in chain[1:]:
        periods = roll_up(periods, level)
    return periods


def touched(days: DataFrame, unit: str) -> DataFrame:
    """The periods that hold any of the days."""
    return days.select(period_start(F.col("period"), unit).alias("period")).distinct()


def within(periods: DataFrame, larger: DataFrame, unit: str) -> DataFrame:
    """The periods that lie in one of the larger ones."""
    return (periods.withColumn("larger", period_start(F.col("period"), unit))
            .join(larger.select(F.col("period").alias("larger")), "larger", "left_semi").select(*periods.columns))


def late_rows(days: DataFrame, stored_days: DataFrame) -> DataFrame:
    """Days up to the last stored one whose sales differ from what was stored (null when the day was not
    stored at all): stored and present values side by side."""
    measures = ("revenue", "profit", "row_count")
    stored = stored_days.select("period", *[F.col(name).alias(f"stored_{name}") for name in measures])
    last = stored_days.agg(F.max("period")).scalar()
    both = days.where(F.col("period") <= last).join(stored, "period", "left")
    return both.where(~(F.col("row_count").eqNullSafe(F.col("stored_row_count"))
                        & F.col("revenue").eqNullSafe(F.col("stored_revenue"))
                        & F.col("profit").eqNullSafe(F.col("stored_profit"))))
