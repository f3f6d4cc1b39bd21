"""Five systems into one sales schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailloom.functions.columns import channel, whole_number
from retailloom.functions.messages import from_messages
from retailloom.schemas import ECOMMERCE, ERP, FACT, INVOICE, LANDING, POS


def parse_invoices(messages: DataFrame, value: str = "value") -> DataFrame:
    """JSON invoices to nested columns."""
    return from_messages(messages, INVOICE, value)


def flatten_invoices(invoices: DataFrame) -> DataFrame:
    """One row per invoice line, each carrying its invoice's header. Narrow: no shuffle."""
    return invoices.select("invoice_id", "store_id", "region", "Ngay", F.inline("lines"))


def with_source(df: DataFrame, source: str) -> DataFrame:
    """Tag rows that carry no source yet."""
    if "source" not in df.columns:
        return df.withColumn("source", F.lit(source))
    return df.withColumn("source", F.coalesce("source", F.lit(source)))


def normalize_pos(lines: DataFrame) -> DataFrame:
    return with_source(lines.withColumnsRenamed({"Doanh_Thu": "revenue", "Ngay": "txn_date"}), POS)


def normalize_ecommerce(orders: DataFrame) -> DataFrame:
    kept = ["customer_id", "region", "product_id", "qty", "revenue", "device", "payment_method"]
    if "source" in orders.columns:
        kept.append("source")
    renamed = orders.select(
        F.col("order_id").alias("txn_id"), *[name for name in kept if name in orders.columns],
        F.col("order_date").alias("txn_date"),
    )
    return with_source(renamed, ECOMMERCE)


def normalize_erp(sales: DataFrame) -> DataFrame:
    return with_source(sales.withColumnsRenamed({"kenh": "channel"}).drop("id"), ERP)


def union_sources(*sources: DataFrame) -> DataFrame:
    """The sources under one schema; a column a source lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def conform(raw: DataFrame) -> DataFrame:
    """Add the landing columns that are missing as nulls."""
    missing = [field for field in LANDING if field.name not in raw.columns]
    return raw.select("*", *[F.lit(None).cast(field.dataType).alias(field.name) for field in missing])


def to_fact(raw: DataFrame) -> DataFrame:
    """Landing rows as sales-fact rows. Bad numbers and dates become null; rows without a source or
    transaction id (malformed lines among them) are dropped."""
    rows = conform(raw)
    typed = rows.select(
        "txn_id", "invoice_id", "store_id", "product_id", "region",
        whole_number(F.col("qty"), "int").alias("qty"),
        F.col("revenue").try_cast("double").alias("revenue"),
        F.col("cost").try_cast("double").alias("cost"),
        whole_number(F.col("promotion"), "int").alias("promotion"),
        channel(F.coalesce("channel", "kenh")).alias("channel"),
        "customer_id", "device", "payment_method",
        F.col("txn_date").try_cast("date").alias("txn_date"),
        "source",
    ).where(F.col("source").isNotNull() & F.col("txn_id").isNotNull())
    dated = typed.withColumns({"month": F.month("txn_date"), "year": F.year("txn_date")})
    return dated.select(FACT.fieldNames())
