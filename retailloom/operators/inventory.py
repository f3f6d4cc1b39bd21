"""Event-sourced stock, daily snapshots, and the accounting rules between sales and stock."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailloom.functions.columns import line_cost, low_stock, stock_value
from retailloom.operators.normalize import union_sources
from retailloom.schemas import INBOUND, INVENTORY, OFFLINE, ONLINE, OPENING, OUTBOUND, SNAPSHOT


def stock_on_hand(movements: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Signed movements summed per product. With ``previous`` balances only the new movements are read."""
    rows = movements.select("product_id", "qty")
    if previous is not None:
        rows = rows.unionByName(previous.select("product_id", F.col("stock_qty").alias("qty")))
    return rows.groupBy("product_id").agg(F.sum("qty").cast("bigint").alias("stock_qty"))


def value_stock(stock: DataFrame, product: DataFrame) -> DataFrame:
    """Balances with the product's name, threshold, unit cost and value; unknown products keep nulls."""
    return (stock.join(product, "product_id", "left")
            .withColumn("stock_value", stock_value())
            .select(*INVENTORY.fieldNames()))


def inventory(movements: DataFrame, product: DataFrame) -> DataFrame:
    return value_stock(stock_on_hand(movements), product)


def snapshot(current: DataFrame, snapshot_date: date) -> DataFrame:
    return (current.withColumn("snapshot_date", F.lit(snapshot_date))
            .select(*SNAPSHOT.fieldNames()))


def snapshots_as_of(movements: DataFrame, product: DataFrame, dates: Sequence[date]) -> DataFrame:
    """The stock of several past days from one pass: a movement counts from its day on, an undated one
    always. One conditional sum per requested date, so the shuffle holds one row per product and task."""
    def included(day: date):
        return F.col("moved_on").isNull() | (F.col("moved_on") <= F.lit(day))

    sums = [F.sum(F.when(included(day), F.col("qty"))).cast("bigint").alias(f"qty_{i}")
            for i, day in enumerate(dates)]
    rows = [F.count_if(included(day)).alias(f"rows_{i}") for i, day in enumerate(dates)]
    per_product = movements.groupBy("product_id").agg(*sums, *rows)
    points = F.array(*[
        F.struct(F.lit(day).alias("snapshot_date"), F.col(f"qty_{i}").alias("stock_qty"),
                 F.col(f"rows_{i}").alias("rows"))
        for i, day in enumerate(dates)
    ])
    named = per_product.join(product, "product_id", "left")
    return (named.select("product_id", "product_name", "reorder_level", "unit_cost", F.inline(points))
            .where(F.col("rows") > 0)
            .withColumn("stock_value", stock_value())
            .select(*SNAPSHOT.fieldNames()))


def post_financials(pos: DataFrame, ecommerce: DataFrame, product: DataFrame) -> DataFrame:
    """Finance rows for every sale: channel, cost of goods, and the order as its own invoice online.

    The product lookup is left to Spark's size check: broadcast while small, otherwise a sort-merge join
    whose hot products AQE splits.
    """
    columns = ["txn_id", "invoice_id", "store_id", "region", "product_id", "qty", "revenue", "txn_date"]
    offline = pos.withColumn("channel", F.lit(OFFLINE))
    online = (ecommerce.withColumn("channel", F.lit(ONLINE))
              .withColumn("invoice_id", F.col("txn_id"))
              .withColumn("store_id", F.lit(None).cast("string")))
    keep = [name for name in columns + ["channel"] if name in offline.columns or name in online.columns]
    sales = union_sources(offline.select(*[c for c in keep if c in offline.columns]),
                          online.select(*[c for c in keep if c in online.columns]))
    return (sales.join(product.select("product_id", "unit_cost"), "product_id", "left")
            .withColumn("cost", line_cost(F.col("qty")))
            .select(*keep, "cost"))


def outbound_movements(erp: DataFrame, product: DataFrame) -> DataFrame:
    """Every sale takes its quantity out of the warehouse at cost."""
    return (erp.join(product.select("product_id", "unit_cost"), "product_id", "left")
            .select("product_id", F.lit(OUTBOUND).alias("kind"), (-F.col("qty")).alias("qty"),
                    line_cost(F.col("qty")).alias("cost"), F.col("txn_date").alias("moved_on")))


def opening_balances(product: DataFrame, factor: int = 2) -> DataFrame:
    qty = F.col("reorder_level") * F.lit(factor)
    return product.select("product_id", F.lit(OPENING).alias("kind"), qty.alias("qty"),
                          line_cost(qty).alias("cost"))


def reorder_lots(product: DataFrame, stock: DataFrame, lot_factor: int = 4) -> DataFrame:
    """One inbound lot for each product below its threshold; a product never moved counts as zero."""
    qty = F.col("reorder_level") * F.lit(lot_factor)
    balances = product.join(stock.select("product_id", "stock_qty"), "product_id", "left")
    return (balances.withColumn("stock_qty", F.coalesce("stock_qty", F.lit(0)))
            .where(low_stock())
            .select("product_id", F.lit(INBOUND).alias("kind"), qty.alias("qty"),
                    line_cost(qty).alias("cost")))
