"""Fixed schemas: nothing is inferred at run time."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "date": T.DateType(), "timestamp": T.TimestampType(), "boolean": T.BooleanType(),
}


def fields(text: str) -> T.StructType:
    """A flat schema from ``name type`` pairs; needs no running session."""
    pairs = [pair.split() for pair in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# The three selling systems and the two channels.
POS, ERP, ECOMMERCE = "pos", "erp", "ecommerce"
SOURCES = (POS, ERP, ECOMMERCE)
ONLINE, OFFLINE = "online", "offline"

# Fixed value: the source tag of stock rows.
WAREHOUSE = "kho"

# Movement kinds.
OPENING, INBOUND, OUTBOUND = "opening", "inbound", "outbound"

# The names and kinds under which the stock system sends its movements.
SENT_KIND, SENT_TIME = "loai", "thoi_diem"
SENT_KINDS = {"nhap_dau": OPENING, "nhap": INBOUND, "xuat": OUTBOUND}
MOVEMENT_LANDING = T.StructType([
    T.StructField(name, T.StringType())
    for name in ("id", "product_id", "kind", SENT_KIND, "qty", "cost", "moved_at", SENT_TIME)
])

# The two message topics.
SALES_TOPIC, INVENTORY_TOPIC = "sales-report-clean", "inventory-events"

# One POS message; ``Ngay`` and ``Doanh_Thu`` are the names the tills send.
INVOICE = fields("invoice_id string, store_id string, region string, Ngay string").add(
    "lines", T.ArrayType(fields(
        "txn_id string, product_id string, qty double, Doanh_Thu double, promotion double")))

# Landing records keep every field as text, so that 1, 1.0 and "1" all survive parsing; ``to_fact`` casts them.
LANDING = T.StructType([
    T.StructField(name, T.StringType())
    for name in (
        "txn_id", "invoice_id", "store_id", "product_id", "region", "qty", "revenue", "cost", "promotion",
        "channel", "kenh", "txn_date", "customer_id", "device", "payment_method", "source",
    )
])

FACT = fields(
    "txn_id string, invoice_id string, store_id string, product_id string, region string, qty int, "
    "revenue double, cost double, promotion int, channel string, customer_id string, device string, "
    "payment_method string, txn_date date, source string, month int, year int"
)
FACT_PARTITIONS = ("source", "year", "month")
FACT_KEY = ("txn_id", "source")
KEY_INDEX, FACT_KEYS = "sales_keys", fields("source string, year int, month int, key_hash bigint")

PRODUCT = fields(
    "product_id string, product_name string, unit_cost double, reorder_level int"
)
CUSTOMER = fields(
    "customer_id string, customer_name string, segment string, region string"
)
MOVEMENT = fields(
    "id bigint, product_id string, kind string, qty int, cost double, moved_at timestamp"
)
INVENTORY = fields(
    "product_id string, product_name string, stock_qty bigint, reorder_level int, unit_cost double, "
    "stock_value double"
)
SNAPSHOT = fields(
    "product_id string, product_name string, stock_qty bigint, reorder_level int, unit_cost double, "
    "stock_value double, snapshot_date date"
)
PERIOD = fields("period date, revenue double, profit double, row_count bigint")

# Live payload. ``promotion`` is read as double because a bigint field turns 1.0 into null.
EVENT = fields(
    "source string, import_time string, txn_id string, store_id string, product_id string, region string, "
    "qty double, revenue double, cost double, promotion double, txn_date string"
)
LIVE_STATS = fields(
    "revenue double, profit double, txn_count bigint, processed_at timestamp, batch_id bigint"
)
LIVE_ALERTS = fields(
    "processed_at timestamp, txn_id string, store_id string, region string, revenue double, cost double, "
    "profit double, batch_id bigint"
)
