"""A star schema (orders, line items, parts, suppliers, customers, events) seen as the retail systems.

Each view joins only the tables its requested columns need: every line item has its part, supplier and
order (checked in the tests), so a look-up that is not used changes no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from retailloom.functions.columns import whole
from retailloom.operators.normalize import union_sources
from retailloom.schemas import ECOMMERCE, ERP, INBOUND, OFFLINE, ONLINE, OPENING, OUTBOUND, POS
from retailloom.sources.files import is_folder

# A till sends an invoice as one message; one with line numbers beyond this is sent in parts of as many numbers.
LINES_PER_MESSAGE = 1000


def _txn_id():
    """The four keys together are unique; order and line number alone are not."""
    return F.concat(F.lit("L"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))


def _line_id(columns: list[str]):
    """A running number: order, line, and 30 bits of a hash of the whole row, as order and line can occur twice."""
    place = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * (1 << 30)
    return place + F.pmod(F.xxhash64(*columns), F.lit(1 << 30))


def _line_columns():
    """Columns every selling system takes from a line item."""
    return {
        "txn_id": _txn_id(),
        "invoice_id": F.concat(F.lit("INV"), F.col("l_orderkey")),
        "product_id": F.concat(F.lit("P"), F.col("l_partkey")),
        "qty": F.col("l_quantity").cast("int"),
        "revenue": whole(F.col("l_extendedprice") * (1 - F.col("l_discount"))),
        "txn_date": F.col("l_shipdate").cast("date"),
        "month": F.month("l_shipdate"),
    }


_schemas: dict[tuple[str, str], StructType] = {}


def _file_schema(spark: SparkSession, path: str) -> StructType:
    """The schema in the file's footer, looked up once per application: each look-up is a Spark job."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _schemas:
        _schemas[key] = spark.read.parquet(path).schema
    return _schemas[key]


class Star:
    """The retail views over one folder of Parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        return self.spark.read.schema(_file_schema(self.spark, path)).parquet(path)

    def product(self) -> DataFrame:
        return self.table("part").select(
            F.concat(F.lit("P"), F.col("p_partkey")).alias("product_id"),
            F.col("p_name").alias("product_name"), F.col("p_retailprice").alias("unit_cost"),
            (F.col("p_size") * 4).alias("reorder_level"))

    def customer(self, *columns: str) -> DataFrame:
        columns = columns or ("customer_id", "customer_name", "segment", "region")
        known = {
            "customer_id": F.concat(F.lit("C"), F.col("c_custkey")), "customer_name": F.col("c_name"),
            "segment": F.col("c_mktsegment"), "region": F.col("r_name"),
        }
        rows = self.table("customer")
        if "region" in columns:
            rows = self._with_region(rows, "c_nationkey")
        return rows.select(*[known[name].alias(name) for name in columns])

    def store(self) -> DataFrame:
        """One row per supplier: its key, store and region."""
        return self._with_region(self.table("supplier"), "s_nationkey").select(
            F.col("s_suppkey").alias("supplier_key"), F.col("s_name").alias("store_name"),
            F.col("r_name").alias("region"))

    def _with_region(self, rows: DataFrame, nation_key: str) -> DataFrame:
        """Join nation and region one after the other: Spark then sees each table's own file size and
        broadcasts it; the size it would guess for a joined pair is too high for that."""
        return (rows.join(self.table("nation").select("n_nationkey", "n_regionkey"),
                          F.col(nation_key) == F.col("n_nationkey"))
                .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")))

    def _lines(self, status: str | None, columns: tuple[str, ...], store_columns: set[str]) -> DataFrame:
        lines = self.table("lineitem")
        if status:
            lines = lines.where(F.col("l_linestatus") == status)
        if "cost" in columns:
            lines = lines.join(self.table("part").select("p_partkey", "p_retailprice"),
                               F.col("l_partkey") == F.col("p_partkey"))
        if store_columns & set(columns):
            lines = lines.join(self.table("supplier").select("s_suppkey", "s_name", "s_nationkey"),
                               F.col("l_suppkey") == F.col("s_suppkey"))
        if "region" in columns:
            lines = self._with_region(lines, "s_nationkey")
        return lines

    def erp(self, *columns: str) -> DataFrame:
        """Finance rows of both channels."""
        offline = F.col("l_linestatus") == "F"
        columns = columns or ("txn_id", "invoice_id", "product_id", "store_id", "region", "qty", "revenue",
                              "cost", "channel", "txn_date", "month", "source")
        known = _line_columns() | {
            "supplier_key": F.col("l_suppkey"),
            "store_id": F.when(offline, F.col("s_name")) if "store_id" in columns else None,
            "region": F.col("r_name"),
            "cost": whole(F.col("l_quantity") * F.col("p_retailprice")),
            "channel": F.when(offline, OFFLINE).otherwise(ONLINE),
            "source": F.lit(ERP),
        }
        lines = self._lines(None, columns, {"store_id", "region"})
        return lines.select(*[known[name].alias(name) for name in columns])

    def pos(self, *columns: str) -> DataFrame:
        """Till lines: no cost, no channel."""
        columns = columns or ("txn_id", "invoice_id", "product_id", "store_id", "region", "qty", "revenue",
                              "promotion", "txn_date", "source")
        known = _line_columns() | {
            "store_id": F.col("s_name"),
            "region": F.col("r_name"),
            "promotion": F.when(F.col("l_discount") > 0.05, 1).otherwise(0),
            "source": F.lit(POS),
        }
        lines = self._lines("F", columns, {"store_id", "region"})
        return lines.select(*[known[name].alias(name) for name in columns])

    def ecommerce(self, *columns: str) -> DataFrame:
        """Online orders: customer and their region, device and payment, no cost."""
        columns = columns or ("txn_id", "customer_id", "region", "product_id", "qty", "revenue", "device",
                              "payment_method", "txn_date", "source")
        known = _line_columns() | {
            "customer_id": F.concat(F.lit("C"), F.col("o_custkey")),
            "region": F.col("r_name"),
            "device": F.col("o_orderstatus"),
            "payment_method": F.col("o_orderpriority"),
            "source": F.lit(ECOMMERCE),
        }
        lines = self._lines("O", (), set())
        if {"customer_id", "region", "device", "payment_method"} & set(columns):
            orders = self.table("orders")
            if "region" in columns:
                home = self._with_region(self.table("customer").select("c_custkey", "c_nationkey"), "c_nationkey")
                orders = orders.join(home.select("c_custkey", "r_name"), F.col("o_custkey") == F.col("c_custkey"))
            lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        return lines.select(*[known[name].alias(name) for name in columns])

    def all_sources(self) -> DataFrame:
        """The three systems under one schema, before conforming."""
        return union_sources(self.erp(), self.pos(), self.ecommerce())

    def movement(self) -> DataFrame:
        inbound = F.col("l_returnflag") == "R"
        qty = F.col("l_quantity").cast("int")
        opening = self.table("part").select(
            # Line movements have positive ids, opening ones negative: together they are unique.
            (-1 - F.col("p_partkey")).cast("bigint").alias("id"),
            F.concat(F.lit("P"), F.col("p_partkey")).alias("product_id"), F.lit(OPENING).alias("kind"),
            (F.col("p_size") * 10).alias("qty"), whole(F.col("p_size") * 10 * F.col("p_retailprice")).alias("cost"),
            F.lit(None).cast("date").alias("moved_on"))
        moved = self.table("lineitem").select(
            _line_id(self.table("lineitem").columns).alias("id"),
            F.concat(F.lit("P"), F.col("l_partkey")).alias("product_id"),
            F.when(inbound, INBOUND).otherwise(OUTBOUND).alias("kind"),
            F.when(inbound, qty).otherwise(-qty).alias("qty"),
            whole(F.col("l_extendedprice")).alias("cost"),
            F.col("l_shipdate").cast("date").alias("moved_on"))
        return opening.unionByName(moved)

    def invoices(self) -> DataFrame:
        """Till lines as JSON invoices with order-level headers, the way the tills send them: all lines of an
        invoice in one message, or in one for each ``LINES_PER_MESSAGE`` line numbers."""
        part = F.floor((F.col("l_linenumber") - 1) / LINES_PER_MESSAGE)
        lines = self.table("lineitem").where(F.col("l_linestatus") == "F").withColumn("part", part)
        known = _line_columns()
        line = F.struct(_txn_id().alias("txn_id"), known["product_id"].alias("product_id"),
                        known["qty"].alias("qty"), known["revenue"].alias("Doanh_Thu"),
                        F.when(F.col("l_discount") > 0.05, 1).otherwise(0).alias("promotion"))
        gathered = lines.groupBy("l_orderkey", "part").agg(F.collect_list(line).alias("lines"))
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
        return gathered.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.to_json(F.struct(
            known["invoice_id"].alias("invoice_id"), F.concat(F.lit("T"), F.col("o_custkey")).alias("store_id"),
            F.col("o_orderstatus").alias("region"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("Ngay"),
            F.col("lines"))).alias("value"))

    def messages(self) -> DataFrame:
        """The event stream as JSON text, the way a topic delivers it."""
        reader = self.spark.readStream.schema(self.table("events").schema)
        path = f"{self.folder}/events.parquet"
        if is_folder(self.spark, path):
            return event_messages(reader.parquet(path))
        return event_messages(reader.option("pathGlobFilter", "events.parquet").parquet(self.folder))


def event_messages(events: DataFrame) -> DataFrame:
    cost = F.get_json_object("props", "$.k").try_cast("double")
    payload = F.struct(
        F.lit(ERP).alias("source"), F.concat(F.lit("E"), F.col("event_id")).alias("txn_id"),
        F.concat(F.lit("U"), F.col("user_id")).alias("store_id"), F.col("event_type").alias("region"),
        F.col("value").alias("revenue"), cost.alias("cost"),
        F.date_format("ts", "yyyy-MM-dd").alias("txn_date"))
    return events.select(F.to_json(payload).alias("value"))
