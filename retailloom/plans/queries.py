"""The registered queries: each runs one operator over a star-schema folder seen as the retail systems."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailloom.functions.messages import from_messages, split_array, to_messages
from retailloom.operators import dedup, inventory, ml, normalize, planning, reports, rollup
from retailloom.schemas import (
    EVENT, FACT, FACT_KEYS, KEY_INDEX, LIVE_ALERTS, LIVE_STATS, MOVEMENT, MOVEMENT_LANDING, OFFLINE, PERIOD, SENT_KIND, SENT_KINDS, SENT_TIME,
    SNAPSHOT, fields)
from retailloom.plans import periods
from retailloom.session import materialize, scratch, shuffles_released, state_on_disk, unused_shuffles_go
from retailloom.sinks.buckets import PairedSales
from retailloom.sinks.stores import Lake
from retailloom.sinks.tables import append_counted, ensure_table, overwrite_day
from retailloom.sources import files, tables
from retailloom.sources.starmap import Star, event_messages
from retailloom.streaming import ingest, intake, live

SNAPSHOT_DATES = (date(1998, 6, 30), date(1999, 12, 31), date(2001, 9, 30))
RESUME_AFTER = date(1999, 6, 1)
RANGE = (date(1998, 1, 1), date(1999, 12, 31))
EVENT_LOSS = -50
PAIRED_BUCKETS = 16

REGISTRY: dict[str, Callable[[Star], DataFrame]] = {}


def query(build: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
    REGISTRY[build.__name__] = build
    return build


def _sales(star: Star, *columns: str) -> DataFrame:
    """Finance measures; columns the query does not need are null and cost no look-up."""
    wanted = ("source", *columns)
    every = ("txn_id", "store_id", "product_id", "region", "channel", "txn_date", "month", "revenue", "cost", "qty")
    rows = star.erp(*wanted)
    missing = [F.lit(None).cast(FACT[name].dataType).alias(name) for name in every if name not in wanted]
    return reports.sales_measures(rows.select("*", *missing))


def _store_sums(star: Star, *more: str) -> DataFrame:
    """Finance measures per store, summed per supplier before any store is looked up: what the joins carry is one
    row per supplier and task, not the lines."""
    rows = star.erp("source", "supplier_key", "channel", "revenue", "cost", "qty", *more)
    by = ["supplier_key", "channel", *more, "costed"]
    profit = F.col("revenue") - F.col("cost")
    sums = rows.withColumn("costed", F.col("cost").isNotNull()).groupBy(*by).agg(
        F.sum("revenue").alias("revenue"), F.sum("cost").alias("cost"), F.sum(profit).alias("profit"),
        F.count(F.lit(1)).alias("row_count"), F.count("revenue").alias("priced_rows"))
    return sums.join(star.store(), "supplier_key").withColumn(
        "store_id", F.when(F.col("channel") == OFFLINE, F.col("store_name")))


def _fresh_database(star: Star, label: str) -> str:
    """A database of its own under the shared folder."""
    name = f"retailloom_{label}_{uuid.uuid4().hex}"
    star.spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch(star.spark, label)}'")
    return name


# Finance reports

@query
def region_profit(star: Star) -> DataFrame:
    return reports.ordered(reports.region_profit(_store_sums(star)), "region_profit")


@query
def region_profit_presented(star: Star) -> DataFrame:
    return reports.presented(region_profit(star), "region", "revenue", "profit")


@query
def store_month_pnl(star: Star) -> DataFrame:
    return reports.ordered(reports.store_month_pnl(_store_sums(star, "month")), "store_month_pnl")


@query
def top_products_revenue(star: Star) -> DataFrame:
    return reports.top_products_revenue(_sales(star, "product_id", "revenue", "qty"))


@query
def top_products_profit(star: Star) -> DataFrame:
    return reports.top_products_profit(_sales(star, "product_id", "revenue", "cost"))


@query
def channel_pnl(star: Star) -> DataFrame:
    return reports.ordered(reports.channel_pnl(_sales(star, "channel", "revenue", "cost")), "channel_pnl")


@query
def daily_series(star: Star) -> DataFrame:
    return reports.ordered(reports.daily_series(_sales(star, "txn_date", "revenue", "cost")), "daily_series")


@query
def daily_series_range(star: Star) -> DataFrame:
    series = reports.daily_series(_sales(star, "txn_date", "revenue", "cost"))
    return reports.in_range(series, "day", *RANGE)


@query
def store_day_cube(star: Star) -> DataFrame:
    sales = _sales(star, "txn_date", "month", "store_id", "region", "channel", "revenue", "cost", "qty")
    return reports.store_day_cube(sales)


@query
def product_month_cube(star: Star) -> DataFrame:
    return reports.product_month_cube(_sales(star, "txn_date", "product_id", "month", "revenue", "cost", "qty"))


@query
def region_profit_from_cube(star: Star) -> DataFrame:
    cube = materialize(store_day_cube(star), "store-day-cube")
    return reports.ordered(reports.region_profit(cube), "region_profit")


# Fact counts and online orders

@query
def rows_per_source(star: Star) -> DataFrame:
    fact = normalize.union_sources(star.erp("source"), star.pos("source"), star.ecommerce("source"))
    return reports.rows_per_source(fact)


@query
def rows_per_channel(star: Star) -> DataFrame:
    fact = normalize.union_sources(star.erp("source", "channel", "txn_id"), star.pos("source", "txn_id"),
                                   star.ecommerce("source", "txn_id"))
    return reports.rows_per_channel(normalize.to_fact(fact))


@query
def device_payment(star: Star) -> DataFrame:
    fact = star.ecommerce("source", "device", "payment_method", "revenue")
    orders = reports.order_measures(fact.withColumn("customer_id", F.lit(None).cast("string")))
    return reports.ordered(reports.device_payment(orders), "device_payment")


@query
def segment_revenue(star: Star) -> DataFrame:
    fact = star.ecommerce("source", "customer_id", "revenue")
    orders = reports.order_measures(fact.withColumns(
        {name: F.lit(None).cast("string") for name in ("device", "payment_method")}))
    return reports.ordered(reports.segment_revenue(orders, star.customer("customer_id", "segment")), "segment_revenue")


@query
def order_cube(star: Star) -> DataFrame:
    fact = star.ecommerce("source", "customer_id", "device", "payment_method", "revenue")
    return reports.order_cube(reports.order_measures(fact))


# Periods

def _business_date(star: Star):
    return rollup.business_date(star.erp("txn_date")).scalar()


def _closed(star: Star, unit: str) -> DataFrame:
    return rollup.closed_periods(_sales(star, "txn_date", "revenue", "cost"), unit, _business_date(star))


@query
def business_date(star: Star) -> DataFrame:
    return rollup.business_date(star.erp("txn_date"))


@query
def period_day(star: Star) -> DataFrame:
    return _closed(star, "day")


@query
def period_week(star: Star) -> DataFrame:
    return _closed(star, "week")


@query
def period_month(star: Star) -> DataFrame:
    return _closed(star, "month")


@query
def period_quarter(star: Star) -> DataFrame:
    return _closed(star, "quarter")


@query
def period_year(star: Star) -> DataFrame:
    return _closed(star, "year")


@query
def period_resume(star: Star) -> DataFrame:
    return rollup.unseen(_closed(star, "month"), RESUME_AFTER)


def _cascade(star: Star, times: int) -> dict[str, DataFrame]:
    """The period tables, rolled up ``times`` times over the same sales."""
    database = _fresh_database(star, "periods")
    sales = _sales(star, "txn_date", "revenue", "cost")
    current = rollup.business_date(star.erp("txn_date")).first()["business_date"]
    stored = {level: f"{database}.agg_{level}" for level in rollup.LEVELS}
    for table in stored.values():
        ensure_table(star.spark, table, PERIOD)
    for _ in range(times):
        for level, table in stored.items():
            last = star.spark.table(table).agg(F.max("period").alias("last")).first()["last"]
            source = rollup.daily(sales) if level == "day" else rollup.roll_up(
                star.spark.table(stored[rollup.PARENT[level]]), level)
            append_counted(rollup.unseen(rollup.closed(source, level, current), last), table)
    return {level: star.spark.table(table) for level, table in stored.items()}


@query
def rollup_cascade(star: Star) -> DataFrame:
    """Run twice: the second run adds nothing."""
    return normalize.union_sources(*[
        periods.withColumn("unit", F.lit(level)) for level, periods in _cascade(star, 2).items()])


@query
def period_repair(star: Star) -> DataFrame:
    """Periods stored before the 13th to 19th of the first three months and all of 1995 were known, then repaired."""
    database = _fresh_database(star, "repair")
    stored = {level: f"{database}.agg_{level}" for level in rollup.LEVELS}
    for table in stored.values():
        periods.create(star.spark, table)
    days = rollup.daily(_sales(star, "txn_date", "revenue", "cost"))
    late = (F.year("period") == 1995) | ((F.month("period") <= 3) & F.dayofmonth("period").between(13, 19))
    periods.append_closed(days.where(~late), stored, rollup.business_date(star.erp("txn_date")).first()["business_date"])
    periods.repair(days, stored)
    return normalize.union_sources(*[
        periods.stored(star.spark, table).withColumn("unit", F.lit(level)) for level, table in stored.items()])


@query
def serving_counts(star: Star) -> DataFrame:
    return reports.labelled_counts({f"agg_{level}": df for level, df in _cascade(star, 1).items()})


# Stock

def _inventory(star: Star) -> DataFrame:
    return inventory.inventory(star.movement(), star.product())


@query
def stock_on_hand(star: Star) -> DataFrame:
    return inventory.stock_on_hand(star.movement())


@query
def stock_on_hand_incremental(star: Star) -> DataFrame:
    """Balances up to a date, then only the movements after it."""
    cut = F.lit(SNAPSHOT_DATES[1])
    before = F.col("moved_on").isNull() | (F.col("moved_on") <= cut)
    previous = inventory.stock_on_hand(star.movement().where(before))
    return inventory.stock_on_hand(star.movement().where(F.col("moved_on") > cut), previous)


@query
def current_inventory(star: Star) -> DataFrame:
    return _inventory(star)


@query
def low_stock(star: Star) -> DataFrame:
    return reports.ordered(reports.low_stock_products(_inventory(star)), "low_stock")


@query
def stock_value(star: Star) -> DataFrame:
    return reports.ordered(reports.stock_value_list(_inventory(star)), "stock_value")


@query
def stock_trend(star: Star) -> DataFrame:
    snapshots = inventory.snapshots_as_of(star.movement(), star.product(), SNAPSHOT_DATES)
    return reports.ordered(reports.stock_trend(snapshots), "stock_trend")


@query
def snapshot_table(star: Star) -> DataFrame:
    """Day partitions from one pass over the movements, the last one once more from the stored rows: it replaces
    itself, the others stay."""
    table = f"{_fresh_database(star, 'snapshots')}.stock_snapshot"
    ensure_table(star.spark, table, SNAPSHOT, ["snapshot_date"])
    days = materialize(inventory.snapshots_as_of(star.movement(), star.product(), SNAPSHOT_DATES), "days")
    for day in (*SNAPSHOT_DATES, SNAPSHOT_DATES[-1]):
        overwrite_day(days.where(F.col("snapshot_date") == F.lit(day)), table, "snapshot_date", day)
    return star.spark.table(table)


@query
def stock_ledger(star: Star) -> DataFrame:
    """Movements as JSON files through the movement stream; stock is the sum over its ledger."""
    ledger = _movement_lake(star).read_batches(star.spark, "stock_ledger", fields("product_id string, stock_qty bigint"))
    return inventory.stock_on_hand(ledger.withColumnRenamed("stock_qty", "qty"))


@query
def movement_kinds(star: Star) -> DataFrame:
    """What the movement stream has stored, by kind."""
    stored = _movement_lake(star).read_batches(star.spark, "movements", MOVEMENT)
    return stored.groupBy("kind").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("qty").alias("qty"), F.sum("cost").alias("cost"),
        F.min(F.to_date("moved_at")).alias("first_day"), F.max(F.to_date("moved_at")).alias("last_day"))


def _movement_lake(star: Star) -> Lake:
    """All movements as the stock system sends them, id and cost included; then every third is sent again."""
    lake = Lake(scratch(star.spark, "ledger"))

    def arrive(rows: DataFrame) -> None:
        files.land(rows, lake.path("landing"))
        landing = files.json_lines_stream(star.spark, lake.path("landing"), schema=MOVEMENT_LANDING)
        ingest.start_movements(landing, lake, lake.path("checkpoint")).awaitTermination()

    sent = {ours: theirs for theirs, ours in SENT_KINDS.items()}
    kind = F.create_map(*[F.lit(text) for pair in sent.items() for text in pair])[F.col("kind")]
    rows = star.movement().select(
        "id", "product_id", kind.alias(SENT_KIND), "qty", "cost", F.col("moved_on").alias(SENT_TIME))
    arrive(rows)
    arrive(rows.where("id % 3 = 0"))
    return lake


@query
def opening_balances(star: Star) -> DataFrame:
    return inventory.opening_balances(star.product())


@query
def reorder_lots(star: Star) -> DataFrame:
    return inventory.reorder_lots(star.product(), inventory.stock_on_hand(star.movement()))


@query
def sales_to_movements(star: Star) -> DataFrame:
    return inventory.outbound_movements(star.erp("txn_id", "product_id", "qty", "txn_date"), star.product())


@query
def post_financials(star: Star) -> DataFrame:
    pos = star.pos("txn_id", "invoice_id", "store_id", "region", "product_id", "qty", "revenue", "txn_date")
    online = star.ecommerce("txn_id", "region", "product_id", "qty", "revenue", "txn_date")
    return inventory.post_financials(pos, online, star.product())


# Planning and models

@query
def monthly_demand(star: Star) -> DataFrame:
    return planning.monthly_demand(_sales(star, "product_id", "month", "qty"))


@query
def replenishment_plan(star: Star) -> DataFrame:
    plan = planning.replenishment_plan(monthly_demand(star), star.product(), stock_on_hand(star))
    return reports.ordered(plan, "replenishment_plan")


@query
def promo_profit_corr(star: Star) -> DataFrame:
    fact = normalize.union_sources(star.pos("txn_id", "promotion", "source"),
                                   star.erp("txn_id", "revenue", "cost", "source"))
    return ml.promo_profit_corr(fact)


@query
def promo_profit_buckets(star: Star) -> DataFrame:
    """The correlation from sales kept by transaction: finance rows first, then the tills' twice, as after a crash."""
    pos, erp = star.pos("txn_id", "promotion", "source"), star.erp("txn_id", "revenue", "cost", "source")
    database = _fresh_database(star, "paired")
    normalize.union_sources(pos.where("false"), erp).write.saveAsTable(f"{database}.fact")
    paired = PairedSales(f"{database}.paired_sales", PAIRED_BUCKETS)
    paired.ready(star.spark, f"{database}.fact")
    for _ in range(2):
        paired.append(normalize.union_sources(pos, erp.where("false")), "tills", 0)
    return ml.promo_profit_corr(paired.rows(star.spark))


@query
def monthly_series(star: Star) -> DataFrame:
    return ml.indexed(ml.monthly_series(_sales(star, "txn_date", "revenue", "cost")))


@query
def revenue_forecast(star: Star) -> DataFrame:
    return ml.forecast_next(ml.monthly_series(_sales(star, "txn_date", "revenue", "cost")))


@query
def revenue_forecast_closed(star: Star) -> DataFrame:
    """Without the running month."""
    sales = _sales(star, "txn_date", "revenue", "cost")
    return ml.forecast_next(ml.monthly_series(sales, closed_before=_business_date(star)))


@query
def store_features(star: Star) -> DataFrame:
    return ml.store_features(_store_sums(star))


@query
def store_clusters(star: Star) -> DataFrame:
    return reports.ordered(ml.cluster_stores(store_features(star)), "store_clusters")


@query
def store_cluster_check(star: Star) -> DataFrame:
    """The features, and that the clustering is one of k-means."""
    return ml.cluster_check(store_features(star))


@query
def cluster_sizes(star: Star) -> DataFrame:
    return ml.cluster_sizes(ml.cluster_stores(store_features(star)))


# Normalisation

@query
def sales_normalized(star: Star) -> DataFrame:
    return normalize.to_fact(star.all_sources())


@query
def channel_derivation(star: Star) -> DataFrame:
    """Which channel each source's rows get, with the finance rows' own channel taken away too."""
    fact = normalize.union_sources(
        star.erp("txn_id", "source", "channel"), star.pos("txn_id", "source"), star.ecommerce("txn_id", "source"),
        star.erp("txn_id").withColumn("source", F.lit("unmarked")))
    return normalize.to_fact(fact).groupBy("source", "channel").agg(F.count(F.lit(1)).alias("row_count"))


@query
def sales_dedup(star: Star) -> DataFrame:
    lines = star.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                          "l_extendedprice")
    return dedup.dedup(lines, ["l_orderkey", "l_linenumber"])


@query
def customer_dedup(star: Star) -> DataFrame:
    """Three exports: the second one changes the segment of every other customer and leaves some names out, the third
    repeats a part of the first under an older time."""
    first = star.customer().withColumn("arrived", F.lit(1))
    number = F.substr("customer_id", F.lit(2)).cast("bigint")
    second = first.where(number % 2 == 0).withColumns({
        "segment": F.lit("CHANGED"), "arrived": F.lit(2),
        "customer_name": F.when(number % 3 != 0, F.col("customer_name"))})
    third = first.where(number % 5 == 0).withColumns({"region": F.lit("OLD"), "arrived": F.lit(0)})
    return dedup.newest_customers(first.unionByName(second).unionByName(third), "arrived").drop("arrived")


@query
def invoice_flatten(star: Star) -> DataFrame:
    lines = normalize.flatten_invoices(normalize.parse_invoices(star.invoices()))
    return normalize.to_fact(normalize.normalize_pos(lines)).select(
        "txn_id", "invoice_id", "store_id", "region", "product_id", "qty", "revenue", "promotion", "txn_date", "source",
        "channel")


@query
def invoice_messages(star: Star) -> DataFrame:
    """Lines per message."""
    invoices = normalize.parse_invoices(star.invoices())
    return invoices.select("invoice_id", "store_id", F.size("lines").alias("line_count"))


@query
def ecommerce_rename(star: Star) -> DataFrame:
    orders = star.ecommerce("txn_id", "customer_id", "region", "product_id", "qty", "revenue", "device", "payment_method",
                            "txn_date").withColumnsRenamed({"txn_id": "order_id", "txn_date": "order_date"})
    return normalize.normalize_ecommerce(orders.withColumn("id", F.lit(0)))


@query
def json_round_trip(star: Star) -> DataFrame:
    """Finance rows to messages and back."""
    columns = ("source", "txn_id", "store_id", "region", "product_id", "revenue", "cost", "txn_date")
    return from_messages(to_messages(star.erp(*columns)), EVENT).select(*columns)


@query
def array_split(star: Star) -> DataFrame:
    """Messages that hold an array: one element for a sale, one for its stock movement."""
    rows = star.erp("txn_id", "product_id", "qty")
    element = fields("txn_id string, product_id string, qty int")
    pair = F.array(F.struct("txn_id", "product_id", "qty"),
                   F.struct("txn_id", "product_id", (-F.col("qty")).alias("qty")))
    return split_array(rows.select(F.to_json(pair).alias("value")), element)


# Sources and ingest

@query
def incremental_read(star: Star) -> DataFrame:
    """Each table read from the start and once more from the mark that read left."""
    reads = []
    for name, column in (("orders", "o_orderkey"), ("customer", "c_custkey"), ("part", "p_partkey")):
        table = star.table(name)
        first = tables.high_water_mark(tables.rows_after(table, -1, column), -1, column)
        mark = first.select("last_id").scalar()
        second = tables.high_water_mark(tables.rows_after(table, mark, column), mark, column)
        reads += [read.select(F.lit(name).alias("table_name"), F.lit(number).alias("read_no"), "rows_read", "last_id")
                  for number, read in ((1, first), (2, second))]
    return normalize.union_sources(*reads)


@query
def id_high_water_mark(star: Star) -> DataFrame:
    marks = [("invoice", tables.next_id(star.erp("invoice_id"), "invoice_id", "INV")),
             ("customer", tables.next_id(star.customer("customer_id"), "customer_id", "C")),
             ("order", tables.next_id(star.erp("invoice_id"), "invoice_id", "WEB"))]
    return normalize.union_sources(*[mark.select(F.lit(kind).alias("kind"), "last_id", "next_id")
                                     for kind, mark in marks])


@query
def first_rows(star: Star) -> DataFrame:
    return reports.first_rows(star.table("orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey")


@query
def product_insert_absent(star: Star) -> DataFrame:
    """Products offered again with another threshold keep their stored one; only new keys come in."""
    product = star.product()
    stored = product.where(F.col("reorder_level") >= 100)
    offered = product.withColumn("reorder_level", F.lit(0))
    return stored.unionByName(dedup.absent(offered, stored, ["product_id"]))


@query
def landing_ingest(star: Star) -> DataFrame:
    """All three systems as JSON Lines through the landing stream; then the tills resend everything, and
    a second run adds nothing."""
    spark = star.spark
    folder, table = scratch(spark, "landing"), f"{_fresh_database(star, 'ingest')}.sales"

    def arrive(rows: DataFrame) -> None:
        files.land(rows, f"{folder}/in")
        stream = files.json_lines_stream(spark, f"{folder}/in", archive=f"{folder}/done")
        ingest.ingest_landed(stream, table, f"{folder}/checkpoint")

    arrive(star.all_sources())
    arrive(star.pos())
    return spark.table(table)


@query
def resends_by_state(star: Star) -> DataFrame:
    """All three systems, then the tills again, then everything again, each in a run of its own from the checkpoint: what
    the streaming state lets pass, without a look at the history."""
    spark, folder = star.spark, scratch(star.spark, "state")
    for rows in (star.all_sources(), star.pos(), star.all_sources()):
        files.land(rows, f"{folder}/in")
        passed = normalize.to_fact(ingest.first_seen(files.json_lines_stream(spark, f"{folder}/in"), "6 hours"))
        writer = (passed.writeStream.format("parquet").option("path", f"{folder}/rows")
                  .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True))
        with state_on_disk(spark), shuffles_released(spark):
            writer.start().awaitTermination()
        unused_shuffles_go(spark)
    return spark.read.schema(FACT).parquet(f"{folder}/rows")


@query
def key_index_lookup(star: Star) -> DataFrame:
    """The fact by its key index: which partitions a resent piece of history is in, and how many of its rows are there."""
    spark = star.spark
    lake = Lake(scratch(spark, "keys"))
    fact = materialize(normalize.to_fact(star.all_sources()), "fact")
    lake.append_batch(dedup.keys_of(fact), KEY_INDEX, "q", 0)
    sent = fact.where("source = 'erp' AND year = 1998 AND month <= 2")
    places = dedup.partitions_with(sent, lake.read_batches(spark, KEY_INDEX, FACT_KEYS))
    held = fact.where(F.concat_ws("/", "source", "year", "month").isin(places))
    return held.groupBy("source", "year", "month").agg(F.count(F.lit(1)).alias("row_count"))


@query
def intake_to_landing(star: Star) -> DataFrame:
    """Invoices as message files, orders and finance rows as tables with running ids, taken to landing files in two
    turns of which the first sees the ids up to the middle one and the second finds what is new, and a third that
    finds nothing."""
    spark = star.spark
    place = Lake(scratch(spark, "intake"))
    files.land(star.invoices(), place.path("tills"), "text")
    orders = star.ecommerce("txn_id", "customer_id", "region", "product_id", "qty", "revenue", "device",
                            "payment_method", "txn_date").withColumnsRenamed({"txn_id": "order_id", "txn_date": "order_date"})
    books = star.erp("txn_id", "invoice_id", "store_id", "region", "product_id", "qty", "revenue", "cost", "channel",
                     "txn_date").withColumnRenamed("channel", "kenh")
    running = F.monotonically_increasing_id() + 1
    tables_ = {name: materialize(rows.withColumn("id", running), name, "zstd")
               for name, rows in (("ecommerce_orders", orders), ("sales", books))}
    middle = {name: rows.agg(F.percentile_approx("id", 0.5)).first()[0] for name, rows in tables_.items()}
    for turn in range(3):
        intake.take_invoices(spark, place.path("tills"), place.path("landing"), place.path("checkpoint"))
        for name, rows in tables_.items():
            seen = rows.where(F.col("id") <= F.lit(middle[name])) if turn == 0 else rows
            feed = intake.stored_table(name, lambda seen=seen: seen, intake.NORMALISED[name])
            intake.take_table(spark, feed, place.path("landing"), place)
    return normalize.to_fact(files.json_lines(spark, place.path("landing")))


@query
def intake_gaps(star: Star) -> DataFrame:
    """Online orders whose rows are not committed in the order of their ids: the first turn finds a stretch and single
    ids missing, the second all but some of these, the third the rest, a fourth nothing. Each lands once."""
    spark = star.spark
    place = Lake(scratch(spark, "gaps"))
    columns = ("txn_id", "customer_id", "region", "product_id", "qty", "revenue", "device", "payment_method", "txn_date")
    rows = materialize(star.ecommerce(*columns).withColumnsRenamed({"txn_id": "order_id", "txn_date": "order_date"})
                       .withColumn("id", F.monotonically_increasing_id() + 1), "orders")
    ends = rows.agg(F.percentile_approx("id", F.array(F.lit(0.3), F.lit(0.4)))).first()[0]
    stretch, single = F.col("id").between(*ends), F.col("id") % 5000 == 17
    for seen in (~stretch & ~single, ~single | (F.col("id") > ends[1]), F.lit(True), F.lit(True)):
        feed = intake.stored_table("ecommerce_orders", lambda seen=seen: rows.where(seen), intake.NORMALISED["ecommerce_orders"])
        intake.take_table(spark, feed, place.path("landing"), place)
    landed = normalize.to_fact(files.json_lines(spark, place.path("landing")))
    return landed.select("txn_id", "customer_id", "product_id", "qty", "revenue", "txn_date")


@query
def ingested_cubes(star: Star) -> DataFrame:
    """All sources through the ingest in two batches, whose cubes, folded, alone feed the eight reports."""
    spark = star.spark
    lake, table = Lake(scratch(spark, "cubes")), f"{_fresh_database(star, 'cubes')}.sales"
    for rows in (star.all_sources(), star.pos()):
        files.land(rows, lake.path("landing"))
        ingest.ingest_landed(files.json_lines_stream(spark, lake.path("landing")), table, lake.path("checkpoint"), lake)
    cubes = {}
    for name, schema in reports.CUBE_SCHEMAS.items():
        lake.fold(spark, name, schema, reports.CUBE_SUMS[name])
        cubes[name] = lake.read_batches(spark, name, schema)
    days, products, orders = cubes["cube_store_day"], cubes["cube_product_month"], cubes["cube_orders"]
    regions, devices = cubes["cube_region_day"], cubes["cube_devices"]
    built = {
        "region_profit": (reports.region_profit(regions), ["region"]),
        "store_month_pnl": (reports.store_month_pnl(days), ["store_id", "month"]),
        "top_products_revenue": (reports.top_products_revenue(products), ["product_id"]),
        "top_products_profit": (reports.top_products_profit(products), ["product_id"]),
        "channel_pnl": (reports.channel_pnl(regions), ["channel"]),
        "device_payment": (reports.device_payment(devices), ["device", "payment_method"]),
        "segment_revenue": (reports.segment_revenue(orders, star.customer("customer_id", "segment")), ["segment"]),
        "daily_series": (reports.daily_series(regions), ["day"]),
    }
    return reduce(DataFrame.unionByName, [report.select(
        F.lit(name).alias("report"), F.concat_ws("/", *keys).alias("key"),
        *[F.col(c) if c in report.columns else F.lit(None).cast("double").alias(c) for c in ("revenue", "profit")])
        for name, (report, keys) in built.items()])


# Live

def _live(star: Star) -> Lake:
    """Run the event stream to its end into a lake folder of its own."""
    lake = Lake(scratch(star.spark, "live"))
    live.start_dashboard(star.messages(), lake, lake.path("checkpoint"), threshold=EVENT_LOSS,
                         availableNow=True).awaitTermination()
    return lake


def _alerts(star: Star) -> DataFrame:
    return _live(star).read_batches(star.spark, "rt_alerts", LIVE_ALERTS)


@query
def live_stats(star: Star) -> DataFrame:
    return _live(star).read_batches(star.spark, "rt_stats", LIVE_STATS).select("revenue", "profit", "txn_count")


@query
def live_alerts(star: Star) -> DataFrame:
    return _alerts(star).drop("processed_at", "query_id", "batch_id")


@query
def live_alerts_timed(star: Star) -> DataFrame:
    """The dashboard on a clock of one second, a few files a batch, stopped after its second batch and started again."""
    spark, lake = star.spark, Lake(scratch(star.spark, "timed"))
    event_messages(star.table("events")).repartition(8).write.text(lake.path("topic"))

    def start():
        messages = spark.readStream.option("maxFilesPerTrigger", 2).text(lake.path("topic"))
        return live.start_dashboard(messages, lake, lake.path("checkpoint"), EVENT_LOSS, processingTime="1 second")

    first, end = start(), time.monotonic() + 30  # an empty table has a single batch
    while time.monotonic() < end and (first.lastProgress is None or first.lastProgress.batchId < 1):
        time.sleep(0.1)
    first.stop()
    second = start()
    try:
        second.processAllAvailable()
    finally:
        second.stop()
    return lake.read_batches(spark, "rt_alerts", LIVE_ALERTS).drop("processed_at", "query_id", "batch_id")


@query
def labelled_alerts(star: Star) -> DataFrame:
    """The alert job, written to files instead of the console."""
    path = scratch(star.spark, "alerts")
    stream = live.start_alerts(star.messages(), f"{path}/checkpoint", EVENT_LOSS, sink="parquet",
                               options={"path": f"{path}/rows"}, availableNow=True)
    stream.awaitTermination()
    return star.spark.read.parquet(f"{path}/rows")


@query
def alert_total(star: Star) -> DataFrame:
    return reports.alert_total(_alerts(star))


@query
def latest_alerts(star: Star) -> DataFrame:
    alerts = _alerts(star).drop("query_id", "batch_id")
    return reports.latest(alerts, 5).drop("processed_at")
