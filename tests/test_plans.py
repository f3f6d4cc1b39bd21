"""The shape of the physical plans."""

import pytest

from retailloom.operators import reports, rollup
from retailloom.plans.queries import REGISTRY
from retailloom.sources.starmap import Star
from tests.conftest import plan

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def star(spark):
    return Star(spark, FOLDER)


@pytest.fixture
def stored(spark, shop, database):
    shop.fact.write.partitionBy("source", "month").saveAsTable(f"{database}.sales")
    return spark.table(f"{database}.sales")


def test_reports_prune_partitions_and_columns(stored):
    text = plan(reports.region_profit(reports.sales_measures(stored)))
    assert "PartitionFilters: [isnotnull(source" in text and "(source" in text and "= erp)" in text
    assert "IsNotNull(cost)" in text
    assert "ReadSchema: struct<region:string,revenue:double,cost:double>" in text


def test_rollup_bound_reaches_the_scan(stored):
    from datetime import date
    days = rollup.closed(rollup.daily(reports.sales_measures(stored)), "month", date(2026, 8, 3))
    text = plan(rollup.unseen(days, date(2026, 6, 30)))
    assert "LessThan(txn_date,2026-08-01)" in text and "GreaterThan(txn_date,2026-06-30)" in text


def test_top_products_take_n(star):
    for name in ("top_products_revenue", "top_products_profit", "first_rows"):
        assert "TakeOrderedAndProject" in plan(REGISTRY[name](star))


def test_unused_lookups_are_not_joined(star):
    assert "Join" not in plan(REGISTRY["channel_derivation"](star).select("source")).replace("Broadcast", "")
    text = plan(REGISTRY["top_products_revenue"](star))
    assert "Join" not in text
    assert plan(REGISTRY["daily_series"](star)).count("BroadcastHashJoin") == 1


def test_no_python_and_no_cross_join(star):
    eager = {"rollup_cascade", "period_repair", "serving_counts", "snapshot_table", "stock_ledger", "store_clusters", "cluster_sizes",
             "landing_ingest", "live_stats", "live_alerts", "labelled_alerts", "alert_total", "latest_alerts",
             "region_profit_from_cube", "ingested_cubes", "live_alerts_timed"}
    for name, build in REGISTRY.items():
        if name in eager:
            continue
        text = plan(build(star))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in text, (name, bad)


def test_sums_are_partial_before_the_shuffle(star):
    for name in ("region_profit", "segment_revenue", "monthly_demand", "promo_profit_corr", "stock_on_hand"):
        text = plan(REGISTRY[name](star))
        assert text.count("partial_sum") >= 1, name
    assert plan(REGISTRY["monthly_demand"](star)).count("Exchange hashpartitioning") == 1


def test_hot_partition_is_written_by_many_tasks(spark, database):
    from retailloom.sinks.tables import append_partitioned
    rows = spark.range(0, 400000, 1, 8).selectExpr(
        "cast(id as string) txn_id", "if(id % 3 = 0, 'hot', concat('s', id % 4)) source", "int(1) month")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200000")
    try:
        append_partitioned(rows, f"{database}.sales", ["source", "month"], sort=["txn_id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    stored = spark.table(f"{database}.sales")
    assert stored.count() == 400000
    assert len([f for f in stored.inputFiles() if "source=hot" in f]) > 1
