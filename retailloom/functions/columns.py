"""Column expressions shared by the operators. All of them stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from retailloom.schemas import ECOMMERCE, OFFLINE, ONLINE, POS

UNITS = ("day", "week", "month", "quarter", "year")


def whole(amount: Column) -> Column:
    """Money rounded to whole units, halves away from zero."""
    return F.round(amount.cast("double"), 0)


def profit() -> Column:
    """Revenue less cost; null when either is missing."""
    return F.col("revenue") - F.col("cost")


def stock_value() -> Column:
    return whole(F.col("stock_qty") * F.col("unit_cost"))


def line_cost(qty: Column) -> Column:
    return whole(qty * F.col("unit_cost"))


def low_stock() -> Column:
    return F.col("stock_qty") < F.col("reorder_level")


def channel(given: Column) -> Column:
    """The given channel, else the one implied by the source, else null."""
    implied = F.when(F.col("source") == ECOMMERCE, ONLINE).when(F.col("source") == POS, OFFLINE)
    return F.coalesce(given, implied)


def whole_number(value: Column, to: str) -> Column:
    """Text or number to an integer type: whole numbers as they are, however long, a fraction such as "1.9" without
    what follows the point; anything else, and what the type cannot hold, is null."""
    return F.coalesce(value.try_cast(to), value.try_cast("double").try_cast(to))


def period_start(day: Column, unit: str) -> Column:
    """First day of the period that holds ``day``; weeks start on Monday."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}, not {unit!r}")
    return day if unit == "day" else F.to_date(F.date_trunc(unit, day))


def id_number(column: Column, prefix: str) -> Column:
    """The running number of ids such as INV000000042; null for ids of another shape."""
    return F.when(column.rlike(f"^{prefix}[0-9]+$"),
                  F.substr(column, F.lit(len(prefix) + 1)).try_cast("bigint"))
