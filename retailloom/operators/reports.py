"""The business reports.

Reports read *measures*: rows of the finance source with ``revenue, cost, profit, units, row_count`` and
``priced_rows``, or of the online source with ``revenue`` and ``order_count``. A measure row stands for
``row_count`` (``order_count``) sales, so every report gives the same result on the raw fact
(``sales_measures``, ``order_measures``) and on the cubes, which the ingest keeps up to date by adding each
batch's sums. A cube is smaller than the fact where many sales share its dimensions: region x day and
device x payment always are, store x day and product x month in a shop that sells most things every day.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailloom.functions.columns import low_stock, profit, whole
from retailloom.operators.normalize import union_sources
from retailloom.schemas import ECOMMERCE, ERP, OFFLINE, fields

MEASURES = ("revenue", "cost", "profit", "units", "row_count", "priced_rows")
STORE_DAY = ("txn_date", "month", "store_id", "region", "channel", "costed")
REGION_DAY = ("txn_date", "region", "channel", "costed")
DEVICES = ("device", "payment_method")
PRODUCT_MONTH = ("product_id", "txn_month", "month", "costed")
ORDERS = ("customer_id", "device", "payment_method")


def sales_measures(fact: DataFrame) -> DataFrame:
    """Finance rows of the fact as measures. A narrow projection: unused columns are pruned away."""
    return fact.where(F.col("source") == ERP).select(
        "txn_id", "store_id", "product_id", "region", "channel", "txn_date", "month",
        F.to_date(F.date_trunc("month", "txn_date")).alias("txn_month"),
        F.col("cost").isNotNull().alias("costed"),
        "revenue", "cost", profit().alias("profit"), F.col("qty").cast("bigint").alias("units"),
        F.lit(1).cast("bigint").alias("row_count"),
        F.col("revenue").isNotNull().cast("bigint").alias("priced_rows"),
    )


def order_measures(fact: DataFrame) -> DataFrame:
    """Online orders of the fact as measures."""
    return fact.where(F.col("source") == ECOMMERCE).select(
        *ORDERS, "revenue", F.lit(1).cast("bigint").alias("order_count"))


def _cube(rows: DataFrame, dimensions: tuple[str, ...], measures: tuple[str, ...] = MEASURES) -> DataFrame:
    return rows.groupBy(*dimensions).agg(*[F.sum(name).alias(name) for name in measures])


def store_day_cube(sales: DataFrame) -> DataFrame:
    return _cube(sales, STORE_DAY)


def region_day_cube(sales: DataFrame) -> DataFrame:
    return _cube(sales, REGION_DAY)


def device_cube(orders: DataFrame) -> DataFrame:
    return _cube(orders, DEVICES, ("revenue", "order_count"))


def product_month_cube(sales: DataFrame) -> DataFrame:
    return _cube(sales, PRODUCT_MONTH)


def order_cube(orders: DataFrame) -> DataFrame:
    return _cube(orders, ORDERS, ("revenue", "order_count"))


# The cubes the ingest maintains, each from fact rows.
CUBES = {
    "cube_store_day": lambda fact: store_day_cube(sales_measures(fact)),
    "cube_product_month": lambda fact: product_month_cube(sales_measures(fact)),
    "cube_orders": lambda fact: order_cube(order_measures(fact)),
    "cube_region_day": lambda fact: region_day_cube(sales_measures(fact)),
    "cube_devices": lambda fact: device_cube(order_measures(fact)),
}
# The same sums over several batches of a cube.
CUBE_SUMS = {
    "cube_store_day": store_day_cube, "cube_product_month": product_month_cube, "cube_orders": order_cube,
    "cube_region_day": region_day_cube, "cube_devices": device_cube,
}
_SUMS = "revenue double, cost double, profit double, units bigint, row_count bigint, priced_rows bigint"
CUBE_SCHEMAS = {
    "cube_store_day": fields("txn_date date, month int, store_id string, region string, channel string, "
                             f"costed boolean, {_SUMS}"),
    "cube_product_month": fields(f"product_id string, txn_month date, month int, costed boolean, {_SUMS}"),
    "cube_region_day": fields(f"txn_date date, region string, channel string, costed boolean, {_SUMS}"),
    "cube_devices": fields("device string, payment_method string, revenue double, order_count bigint"),
    "cube_orders": fields("customer_id string, device string, payment_method string, revenue double, "
                          "order_count bigint"),
}


def _total(name: str) -> Column:
    return whole(F.sum(name)).alias(name)


def rows_per_source(fact: DataFrame) -> DataFrame:
    return fact.groupBy("source").agg(F.count(F.lit(1)).alias("row_count"))


def rows_per_channel(fact: DataFrame) -> DataFrame:
    return (fact.where(F.col("channel").isNotNull())
            .groupBy("channel").agg(F.count(F.lit(1)).alias("row_count")))


def store_month_pnl(sales: DataFrame) -> DataFrame:
    """Months are numbered 1 to 12: the same month of different years is one row."""
    return (sales.where((F.col("channel") == OFFLINE) & F.col("costed"))
            .groupBy("store_id", "month").agg(_total("revenue"), _total("cost"), _total("profit")))


def region_profit(sales: DataFrame) -> DataFrame:
    return sales.where("costed").groupBy("region").agg(_total("revenue"), _total("profit"))


def top_products_revenue(sales: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` products with the highest rounded revenue, ties by product."""
    return (sales.groupBy("product_id").agg(_total("revenue"), F.sum("units").alias("units_sold"))
            .orderBy(F.col("revenue").desc(), "product_id").limit(n))


def top_products_profit(sales: DataFrame, n: int = 10) -> DataFrame:
    return (sales.where("costed").groupBy("product_id")
            .agg(_total("profit"), F.sum("row_count").alias("rows_sold"))
            .orderBy(F.col("profit").desc(), "product_id").limit(n))


def low_stock_products(current: DataFrame) -> DataFrame:
    return current.where(low_stock()).select("product_id", "product_name", "stock_qty", "reorder_level")


def stock_value_list(current: DataFrame) -> DataFrame:
    return current.select("product_id", "product_name", "stock_qty", "unit_cost", "stock_value")


def channel_pnl(sales: DataFrame) -> DataFrame:
    return (sales.where(F.col("channel").isNotNull()).groupBy("channel")
            .agg(F.sum("row_count").alias("row_count"), _total("revenue"), _total("profit")))


def device_payment(orders: DataFrame) -> DataFrame:
    return (orders.groupBy("device", "payment_method")
            .agg(F.sum("order_count").alias("order_count"), _total("revenue")))


def segment_revenue(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Online orders per customer segment. Orders are summed per customer before the join, so a customer
    with very many orders brings one row to it."""
    per_customer = (orders.where(F.col("customer_id").isNotNull()).groupBy("customer_id")
                    .agg(F.sum("order_count").alias("order_count"), F.sum("revenue").alias("revenue")))
    return (per_customer.join(customer.select("customer_id", "segment"), "customer_id")
            .groupBy("segment").agg(F.sum("order_count").alias("order_count"), _total("revenue")))


def stock_trend(snapshots: DataFrame) -> DataFrame:
    return snapshots.groupBy("snapshot_date").agg(
        whole(F.sum("stock_value")).alias("stock_value"),
        F.count_if(F.coalesce(low_stock(), F.lit(False))).alias("low_stock_products"))


def daily_series(sales: DataFrame) -> DataFrame:
    """Every day with sales, the open one too; days without sales have no row."""
    return (sales.where(F.col("txn_date").isNotNull()).groupBy(F.col("txn_date").alias("day"))
            .agg(_total("revenue"), _total("profit"), F.sum("row_count").alias("row_count")))


def in_range(series: DataFrame, column: str, first, last) -> DataFrame:
    """The dashboard's time range, both ends included."""
    return series.where(F.col(column).between(F.lit(first), F.lit(last)))


def recent(live: DataFrame, minutes: int = 15) -> DataFrame:
    """Live rows processed in the last ``minutes``."""
    return live.where(F.col("processed_at") >= F.current_timestamp() - F.make_dt_interval(mins=F.lit(minutes)))


def latest(live: DataFrame, n: int) -> DataFrame:
    """The ``n`` live rows processed last; ties fall to the remaining columns."""
    rest = [name for name in live.columns if name != "processed_at"]
    return live.orderBy(F.col("processed_at").desc(), *rest).limit(n)


def first_rows(table: DataFrame, column: str, n: int = 5) -> DataFrame:
    return table.orderBy(column).limit(n)


def alert_total(alerts: DataFrame) -> DataFrame:
    return alerts.agg(F.count(F.lit(1)).alias("alert_count"))


def labelled_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table under its label."""
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(label).alias("label"), "row_count")
              for label, df in tables.items()]
    return union_sources(*counts).orderBy("label")


# How each report is read: a stored table has no order.
ORDER = {
    "store_month_pnl": ("store_id", "month"),
    "region_profit": ("-profit", "region"),
    "top_products_revenue": ("-revenue", "product_id"),
    "low_stock": ("stock_qty", "product_id"),
    "top_products_profit": ("-profit", "product_id"),
    "stock_value": ("-stock_value", "product_id"),
    "channel_pnl": ("-revenue", "channel"),
    "device_payment": ("-revenue", "device", "payment_method"),
    "segment_revenue": ("-revenue", "segment"),
    "stock_trend": ("snapshot_date",),
    "daily_series": ("day",),
    "replenishment_plan": ("-suggested_qty", "product_id"),
    "store_clusters": ("cluster", "-revenue", "store_id"),
}


def ordered(df: DataFrame, report: str) -> DataFrame:
    keys = [F.col(key[1:]).desc() if key.startswith("-") else F.col(key) for key in ORDER[report]]
    return df.orderBy(*keys)


def presented(df: DataFrame, *columns: str) -> DataFrame:
    """The chosen columns with money as whole numbers, so that none is shown in scientific notation."""
    kinds = dict(df.dtypes)
    return df.select(*[F.col(name).try_cast("bigint").alias(name) if kinds[name] == "double" else F.col(name)
                       for name in columns or df.columns])


def previewed(df: DataFrame, report: str, n: int = 20) -> DataFrame:
    """The first ``n`` rows in the report's reading order."""
    return ordered(df, report).limit(n) if report in ORDER else df.limit(n)
