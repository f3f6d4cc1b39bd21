"""The batch run: ingest, rollup, reports, analysis, publish."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from retailloom.operators import ml, planning, reports
from retailloom.operators.dedup import newest_customers
from retailloom.operators.inventory import snapshot, stock_on_hand, value_stock
from retailloom.operators.rollup import LEVELS, business_date, closed, daily, late_rows
from retailloom.plans import periods
from retailloom.plans.publish import publish
from retailloom.schemas import (
    CUSTOMER, FACT, FACT_KEYS, FACT_PARTITIONS, INVENTORY, KEY_INDEX, LIVE_ALERTS, LIVE_STATS, MOVEMENT,
    MOVEMENT_LANDING, PRODUCT, SNAPSHOT, WAREHOUSE, fields)
from retailloom.sinks.buckets import PairedSales
from retailloom.sinks.stores import Lake
from retailloom.sinks.tables import counted, ensure_table, overwrite_day, replace_table
from retailloom.sources import files
from retailloom.streaming.ingest import ingest_landed, start_movements

log = logging.getLogger(__name__)

STOCK = StructType(INVENTORY.fields).add("source", StringType())
LEDGER = fields("product_id string, stock_qty bigint")


@dataclass
class Config:
    """Places of one warehouse. Folders must be reachable by every executor."""

    database: str
    landing: str
    movements: str
    customers: str
    product: str
    lake: str
    checkpoint: str
    snapshot_date: date
    archive: str | None = None
    target: object | None = None
    in_vietnamese: bool = False
    files_per_batch: int = 1000
    resent_within: str | None = None
    paired_buckets: int | None = None

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    @property
    def paired(self) -> PairedSales | None:
        return PairedSales(self.table("paired_sales"), self.paired_buckets) if self.paired_buckets else None


def create_database(spark: SparkSession, cfg: Config) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {cfg.database}")
    ensure_table(spark, cfg.table("sales"), FACT, FACT_PARTITIONS)
    ensure_table(spark, cfg.table("inventory"), STOCK)
    ensure_table(spark, cfg.table("stock_snapshot"), SNAPSHOT, ["snapshot_date"])
    for level in LEVELS:
        periods.create(spark, cfg.table(f"agg_{level}"))


def ingest(spark: SparkSession, cfg: Config) -> dict[str, int]:
    """New landing files into the fact, new movements into the stock ledger, then the small tables. A backlog is taken
    in batches of ``files_per_batch`` files. With ``resent_within`` (as ``2 hours``) rows sent again in that time are stopped
    by streaming state; set it from the start, as a checkpoint keeps its plan. With ``paired_buckets`` till and finance
    rows are also kept by transaction in that many buckets, for the correlation. Returns the rows of the fact per source and channel."""
    create_database(spark, cfg)
    if files.exists(spark, cfg.landing):
        landing = files.json_lines_stream(spark, cfg.landing, cfg.archive, cfg.files_per_batch)
        ingest_landed(landing, cfg.table("sales"), f"{cfg.checkpoint}/sales", Lake(cfg.lake), cfg.resent_within,
                      cfg.paired)
    replace_table(spark.read.schema(PRODUCT).parquet(cfg.product), cfg.table("dim_product"))
    lake = Lake(cfg.lake)
    if files.exists(spark, cfg.movements):
        landing = files.json_lines_stream(spark, cfg.movements, None, cfg.files_per_batch, MOVEMENT_LANDING)
        start_movements(landing, lake, f"{cfg.checkpoint}/movements").awaitTermination()
    balances = lake.read_batches(spark, "stock_ledger", LEDGER)
    current = value_stock(stock_on_hand(balances.withColumnRenamed("stock_qty", "qty")),
                          spark.table(cfg.table("dim_product"))).withColumn("source", F.lit(WAREHOUSE))
    replace_table(current, cfg.table("inventory"))
    overwrite_day(snapshot(spark.table(cfg.table("inventory")), cfg.snapshot_date),
                  cfg.table("stock_snapshot"), "snapshot_date", cfg.snapshot_date)
    ensure_table(spark, cfg.table("dim_customer"), CUSTOMER)
    if files.exists(spark, cfg.customers):  # without a new export the stored customers stay
        newest = newest_customers(files.customer_file(spark, cfg.customers), "arrived").drop("arrived")
        replace_table(newest, cfg.table("dim_customer"))
    sales = spark.table(cfg.table("sales"))
    counts = reports.rows_per_source(sales).collect() + reports.rows_per_channel(sales).collect()
    return {row[0]: row["row_count"] for row in counts}


def cube(spark: SparkSession, cfg: Config, name: str) -> DataFrame:
    """The sums of all batches; the reports that read them add them up."""
    return Lake(cfg.lake).read_batches(spark, name, reports.CUBE_SCHEMAS[name])


def rollup(spark: SparkSession, cfg: Config) -> dict[str, int]:
    """Append the newly closed periods of every level; returns how many each got.

    The bounds are read first (one row each) and used as literals. A day that was stored stays as it is:
    sales that arrive for it later are found by ``late_days``.
    """
    sales = cube(spark, cfg, "cube_region_day")
    current = business_date(sales).first()["business_date"]
    return {} if current is None else periods.append_closed(daily(sales), _period_tables(cfg), current)


def _period_tables(cfg: Config) -> dict[str, str]:
    return {level: cfg.table(f"agg_{level}") for level in LEVELS}


def late_days(spark: SparkSession, cfg: Config) -> DataFrame:
    """Stored days whose sales have changed since."""
    return late_rows(daily(cube(spark, cfg, "cube_region_day")), periods.stored(spark, cfg.table("agg_day")))


def rebuild_periods(spark: SparkSession, cfg: Config) -> None:
    """All closed periods anew, late sales included."""
    current = business_date(cube(spark, cfg, "cube_region_day")).first()["business_date"]
    days, tables = daily(cube(spark, cfg, "cube_region_day")), _period_tables(cfg)
    for level, table in tables.items():
        rows = periods.level_rows(days, tables, level)
        periods.replace(closed(rows, level, current) if current else rows, table)


def repair_periods(spark: SparkSession, cfg: Config) -> dict[str, int]:
    """The stored periods that hold a late day anew; the others, and the files of their years, stay."""
    return periods.repair(daily(cube(spark, cfg, "cube_region_day")), _period_tables(cfg))


def report_tables(spark: SparkSession, cfg: Config) -> dict[str, Callable[[], DataFrame]]:
    """Every report by name."""
    def table(name: str) -> DataFrame:
        return spark.table(cfg.table(name))

    days, products, orders, regions, devices = (cube(spark, cfg, name) for name in (
        "cube_store_day", "cube_product_month", "cube_orders", "cube_region_day", "cube_devices"))
    return {
        "store_month_pnl": lambda: reports.store_month_pnl(days),
        "region_profit": lambda: reports.region_profit(regions),
        "top_products_revenue": lambda: reports.top_products_revenue(products),
        "low_stock": lambda: reports.low_stock_products(table("inventory")),
        "top_products_profit": lambda: reports.top_products_profit(products),
        "stock_value": lambda: reports.stock_value_list(table("inventory")),
        "channel_pnl": lambda: reports.channel_pnl(regions),
        "device_payment": lambda: reports.device_payment(devices),
        "segment_revenue": lambda: reports.segment_revenue(orders, table("dim_customer")),
        "stock_trend": lambda: reports.stock_trend(table("stock_snapshot")),
        "daily_series": lambda: reports.daily_series(regions),
    }


def analysis_tables(spark: SparkSession, cfg: Config) -> dict[str, Callable[[], DataFrame]]:
    """Forecast, clusters, correlation and plan by name. Only the correlation reads single sales, as it pairs
    rows of two sources: those kept by transaction, or the fact where there are none."""
    def table(name: str) -> DataFrame:
        return spark.table(cfg.table(name))

    def sales() -> DataFrame:
        return cfg.paired.rows(spark) if cfg.paired else table("sales")

    days, products = cube(spark, cfg, "cube_store_day"), cube(spark, cfg, "cube_product_month")
    return {
        "revenue_forecast": lambda: ml.forecast_next(ml.monthly_series(cube(spark, cfg, "cube_region_day"))),
        "store_clusters": lambda: ml.cluster_stores(ml.store_features(days)),
        "promo_profit_corr": lambda: ml.promo_profit_corr(sales()),
        "replenishment_plan": lambda: planning.replenishment_plan(
            planning.monthly_demand(products), table("dim_product"), table("inventory")),
    }


def _store(spark: SparkSession, cfg: Config, tables: dict[str, Callable[[], DataFrame]]) -> dict[str, int]:
    """Write each report once and log its first rows. One failing report does not stop the others."""
    rows, failed = {}, []
    for name, build in tables.items():
        stored = cfg.table(f"report_{name}")
        try:
            rows[name] = counted(build(), lambda written, stored=stored: replace_table(written, stored))
            for row in reports.previewed(spark.table(stored), name).collect():
                log.info("%s %s", name, row.asDict())
        except Exception as error:
            log.exception("report %s failed", name)
            failed.append(f"{name}: {error}")
    if failed:
        raise RuntimeError("; ".join(failed))
    return rows


def store_reports(spark: SparkSession, cfg: Config) -> dict[str, int]:
    return _store(spark, cfg, report_tables(spark, cfg))


def fold(spark: SparkSession, cfg: Config) -> dict[str, int]:
    """Batches of like size of each cube, the ledger, the movements and the live tables put together; what they were
    is kept for one more version, for readers under way. Returns the rows written per table."""
    lake = Lake(cfg.lake)
    rows = {name: lake.fold(spark, name, reports.CUBE_SCHEMAS[name], sums, keep=1)
            for name, sums in reports.CUBE_SUMS.items()}
    rows["stock_ledger"] = lake.fold(spark, "stock_ledger", LEDGER, lambda parts: parts.groupBy("product_id").agg(
        F.sum("stock_qty").alias("stock_qty")), keep=1)
    for name, schema in (("movements", MOVEMENT), (KEY_INDEX, FACT_KEYS), ("rt_stats", LIVE_STATS), ("rt_alerts", LIVE_ALERTS)):
        rows[name] = lake.fold(spark, name, schema, keep=1)
    if cfg.paired and spark.catalog.tableExists(cfg.paired.table):
        cfg.paired.compact(spark)
    return rows


def store_analysis(spark: SparkSession, cfg: Config) -> dict[str, int]:
    return _store(spark, cfg, analysis_tables(spark, cfg))


def publish_marts(spark: SparkSession, cfg: Config) -> dict[str, int]:
    if cfg.target is None:
        return {}
    return publish(spark, cfg.database, cfg.target, cfg.in_vietnamese)


@dataclass
class Step:
    name: str
    work: Callable[[SparkSession, Config], dict[str, int]]
    required: bool = False


STEPS = (
    Step("ingest", ingest, required=True),
    Step("fold", fold),
    Step("rollup", rollup),
    Step("reports", store_reports),
    Step("analysis", store_analysis),
    Step("publish", publish_marts),
)


@dataclass
class Result:
    ok: bool
    rows: dict[str, int]
    error: str | None = None


def run(spark: SparkSession, cfg: Config, steps: Iterable[str] | None = None) -> dict[str, Result]:
    """Run the steps (all, or those named) in order. A failing required step raises; another failure is
    recorded, later steps still run, and the caller finds it in the result."""
    wanted = set(steps) if steps is not None else {step.name for step in STEPS}
    unknown = wanted - {step.name for step in STEPS}
    if unknown:
        raise ValueError(f"unknown steps: {sorted(unknown)}")
    results = {}
    for step in STEPS:
        if step.name not in wanted:
            continue
        try:
            results[step.name] = Result(True, step.work(spark, cfg))
        except Exception as error:
            if step.required:
                raise
            log.exception("step %s failed", step.name)
            results[step.name] = Result(False, {}, str(error))
    return results


def reset(spark: SparkSession, cfg: Config, keep: Iterable[str] = ("dim_product",)) -> None:
    """Empty the warehouse but for the tables to ``keep``, with the cubes, movements, ledger and live tables of its
    lake and the checkpoints of its streams, so that all landing files count as new. Landing files and the archive
    stay."""
    for name in (*reports.CUBES, KEY_INDEX, "movements", "stock_ledger", "rt_stats", "rt_alerts"):
        Lake(cfg.lake).drop(spark, name)
    for name in ("sales", "movements", "dashboard", "alerts"):
        files.remove(spark, f"{cfg.checkpoint}/{name}")
    if not spark.catalog.databaseExists(cfg.database):
        return
    kept = set(keep)
    present = [t.name for t in spark.catalog.listTables(cfg.database) if not t.isTemporary]
    for name in present:
        if name not in kept:
            spark.sql(f"DROP TABLE {cfg.table(name)}")
    if not kept & set(present):
        spark.sql(f"DROP DATABASE IF EXISTS {cfg.database} CASCADE")
