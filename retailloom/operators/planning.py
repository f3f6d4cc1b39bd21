"""Monthly demand and the replenishment plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailloom.functions.columns import whole


def monthly_demand(sales: DataFrame, by_year: bool = False) -> DataFrame:
    """Average units per month and product, one decimal. Months are 1 to 12 across years unless
    ``by_year``.

    With month numbers the average is total units over the number of months that hold any; the months are
    kept as bits of one integer, so a single aggregation (one shuffle) is enough.
    """
    if by_year:
        per_month = sales.groupBy("product_id", "txn_month").agg(F.sum("units").alias("units"))
        return per_month.groupBy("product_id").agg(F.round(F.avg("units"), 1).alias("monthly_demand"))
    month_bit = F.call_function("shiftleft", F.lit(1), F.coalesce("month", F.lit(0)))
    totals = sales.groupBy("product_id").agg(
        F.sum("units").alias("units"),
        F.bit_or(F.when(F.col("units").isNotNull(), month_bit)).alias("months"))
    average = F.try_divide(F.col("units").cast("double"), F.bit_count("months").cast("double"))
    return totals.select("product_id", F.round(average, 1).alias("monthly_demand"))


def replenishment_plan(demand: DataFrame, product: DataFrame, current: DataFrame,
                       cover: float = 1.5) -> DataFrame:
    """What to order to hold ``cover`` months of demand. The cost is of the exact shortage, before it is
    rounded up to whole units. All three sides hold one row per product."""
    shortage = F.col("monthly_demand") * F.lit(cover) - F.col("stock_qty")
    planned = (demand.join(product, "product_id")
               .join(current.select("product_id", "stock_qty"), "product_id"))
    return planned.select(
        "product_id", "product_name", "monthly_demand", "stock_qty", "reorder_level",
        F.greatest(F.lit(0).cast("bigint"), F.ceil(shortage)).alias("suggested_qty"),
        whole(F.greatest(F.lit(0.0), shortage) * F.col("unit_cost")).alias("expected_cost"))
