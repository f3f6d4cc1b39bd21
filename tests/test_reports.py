from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from retailloom.operators import inventory, reports
from tests.conftest import CH, CO, MA, PA, tuples

BY_RAW_OR_CUBE = pytest.mark.parametrize("cube", [False, True])


def stores(shop, cube):
    return reports.store_day_cube(shop.sales) if cube else shop.sales


def products(shop, cube):
    return reports.product_month_cube(shop.sales) if cube else shop.sales


@BY_RAW_OR_CUBE
def test_region(shop, cube):
    report = reports.ordered(reports.region_profit(stores(shop, cube)), "region_profit")
    assert [tuple(r) for r in report.collect()] == [("West", 2020, 790), ("South", 50, -100), ("East", 450, -150)]


@BY_RAW_OR_CUBE
def test_channel(shop, cube):
    report = reports.ordered(reports.channel_pnl(stores(shop, cube)), "channel_pnl")
    assert [tuple(r) for r in report.collect()] == [("offline", 4, 2020, 490), ("online", 2, 500, 50)]


@BY_RAW_OR_CUBE
def test_store_month(shop, cube):
    report = reports.ordered(reports.store_month_pnl(stores(shop, cube)), "store_month_pnl")
    assert [tuple(r) for r in report.collect()] == [
        ("California", 6, 1240, 630, 610), ("California", 8, 330, 300, 30), ("Ohio", 7, 450, 600, -150)]


@BY_RAW_OR_CUBE
def test_products(shop, cube):
    sales = products(shop, cube)
    assert [tuple(r) for r in reports.top_products_revenue(sales).collect()] == [
        (CO, 1980, 4), (MA, 450, 3), (CH, 50, 1), (PA, 40, 5)]
    assert [tuple(r) for r in reports.top_products_profit(sales).collect()] == [
        (CO, 780, 3), (PA, 10, 1), (CH, -100, 1), (MA, -150, 1)]
    assert [r["product_id"] for r in reports.top_products_revenue(sales, 2).collect()] == [CO, MA]


@BY_RAW_OR_CUBE
def test_daily_series_holds_the_open_day(shop, cube):
    series = reports.daily_series(stores(shop, cube))
    assert tuples(series) == [
        (date(2026, 6, 30), 1240, 610, 2), (date(2026, 7, 1), 500, -250, 2), (date(2026, 7, 6), 450, 150, 1),
        (date(2026, 8, 3), 330, 30, 1)]
    assert reports.in_range(series, "day", date(2026, 7, 1), date(2026, 7, 6)).count() == 2


def test_uncosted_rows_count_for_revenue_only(spark, shop):
    extra = shop.fact.where("txn_id = 'L000000001' and source = 'erp'").withColumns(
        {"cost": F.lit(None).cast("double"), "txn_id": F.lit("L9")})
    for sales in (reports.sales_measures(shop.fact.unionByName(extra)),
                  reports.store_day_cube(reports.sales_measures(shop.fact.unionByName(extra)))):
        assert dict((r[0], r[1]) for r in reports.region_profit(sales).collect())["West"] == 2020
        assert ("offline", 5, 3220, 490) in tuples(reports.channel_pnl(sales))


def test_ties_fall_to_the_product(spark, shop):
    sales = reports.sales_measures(spark.createDataFrame(
        [("erp", f"P{i}", 10.4 if i % 2 else 9.6, 5.0) for i in range(9)],
        "source string, product_id string, revenue double, cost double").selectExpr(
        "*", "'t' txn_id", "'s' store_id", "'r' region", "'online' channel", "date'2026-01-01' txn_date",
        "1 month", "1 qty"))
    assert [r["product_id"] for r in reports.top_products_revenue(sales, 3).collect()] == ["P0", "P1", "P2"]


def test_counts(shop):
    assert tuples(reports.rows_per_source(shop.fact)) == [("ecommerce", 2), ("erp", 6), ("pos", 4)]
    assert tuples(reports.rows_per_channel(shop.fact)) == [("offline", 8), ("online", 4)]


def test_finance_holds_every_sale_once(shop):
    counts = dict(tuples(reports.rows_per_source(shop.fact)))
    assert counts["erp"] == counts["pos"] + counts["ecommerce"]


def orders(shop, cube=False):
    rows = reports.order_measures(shop.fact)
    return reports.order_cube(rows) if cube else rows


@BY_RAW_OR_CUBE
def test_online(shop, cube):
    rows = orders(shop, cube)
    assert tuples(reports.device_payment(rows)) == [("app", "cod", 1, 450), ("web", "card", 1, 50)]
    assert tuples(reports.segment_revenue(rows, shop.customer)) == [("Consumer", 1, 50), ("Corporate", 1, 450)]


def test_cube_schemas(shop):
    for name, build in reports.CUBES.items():
        found = build(shop.fact)
        assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in reports.CUBE_SCHEMAS[name]]


def test_presented(shop):
    shown = reports.presented(reports.region_profit(shop.sales), "region", "profit")
    assert shown.dtypes == [("region", "string"), ("profit", "bigint")]


def test_segments_drop_unknown_and_repeat_doubled_customers(shop):
    known = shop.customer.where("customer_id = 'CUST0001'")
    assert tuples(reports.segment_revenue(orders(shop), known)) == [("Consumer", 1, 50)]
    assert tuples(reports.segment_revenue(orders(shop), known.unionByName(known))) == [("Consumer", 2, 100)]


def test_stock_reports(shop):
    assert tuples(reports.low_stock_products(shop.inventory)) == [(CH, "Stool", 14, 22)]
    values = reports.ordered(reports.stock_value_list(shop.inventory), "stock_value")
    assert [(r["product_id"], r["stock_value"]) for r in values.collect()] == [
        (CO, 16800), (MA, 9400), (CH, 2100), (PA, 1410)]


def test_stock_trend(shop):
    days = [date(2026, 5, 31), date(2026, 6, 30), date(2026, 8, 3)]
    snapshots = inventory.snapshots_as_of(shop.movement, shop.product, days)
    one_by_one = [inventory.snapshot(inventory.inventory(
        shop.movement.where(F.col("moved_on").isNull() | (F.col("moved_on") <= F.lit(day))), shop.product), day)
        for day in days]
    assert tuples(snapshots) == sorted(sum((tuples(s) for s in one_by_one), []), key=repr)
    assert [r["low_stock_products"] for r in reports.ordered(reports.stock_trend(snapshots), "stock_trend").collect()] \
        == [0, 1, 1]


def test_live_readers(spark):
    now = datetime.now()
    live = spark.createDataFrame([(now - timedelta(minutes=m), f"T{m}") for m in (1, 5, 40)],
                                 "processed_at timestamp, txn_id string")
    assert [r["txn_id"] for r in reports.latest(live, 2).collect()] == ["T1", "T5"]
    assert reports.recent(live).count() == 2
    assert reports.alert_total(live).first()["alert_count"] == 3
    assert reports.first_rows(live, "txn_id", 1).first()["txn_id"] == "T1"


def test_labelled_counts(shop):
    counts = reports.labelled_counts({"a": shop.erp, "b": shop.pos.where("false")})
    assert tuples(counts) == [("a", 6), ("b", 0)]


def test_preview(shop):
    assert reports.previewed(reports.region_profit(shop.sales), "region_profit", 1).first()["region"] == "West"


def pairs(spark, rows):
    """(id, promotion, profit) as till and finance rows."""
    tills = [(i, "pos", p, None, None) for i, p, _ in rows if p is not None]
    books = [(i, "erp", None, y, 0.0) for i, _, y in rows if y is not None]
    return spark.createDataFrame(tills + books, "txn_id string, source string, promotion int, revenue double, cost double")


def test_correlation_of_large_amounts(spark):
    from retailloom.operators.ml import promo_profit_corr

    perfect = [(f"L{i}", i % 2, 1e9 + i % 2) for i in range(2000)]
    assert promo_profit_corr(pairs(spark, perfect)).first()["value"] == 1.0
    rows = [(f"L{i}", i % 3, 1e9 + (i * 7919 % 13)) for i in range(2000)]
    both = spark.createDataFrame([(float(p), y) for _, p, y in rows], "p double, y double")
    assert promo_profit_corr(pairs(spark, rows)).first()["value"] == round(both.selectExpr("corr(p, y) c").first()["c"], 4)


def test_correlation_without_spread_or_pairs(spark):
    from retailloom.operators.ml import promo_profit_corr

    flat = [(f"L{i}", 1, 0.1 * i) for i in range(50)]
    assert promo_profit_corr(pairs(spark, flat)).first()["value"] is None
    assert promo_profit_corr(pairs(spark, [(i, i % 2, 1e9 + 0.1) for i in range(7)])).first()["value"] is None
    assert promo_profit_corr(pairs(spark, [("a", 1, None), ("b", None, 2.0)])).first()["value"] is None


def test_correlation_pairs_repeated_ids(spark):
    from itertools import product

    import numpy as np

    from retailloom.operators.ml import promo_profit_corr

    rows = [("a", 0, 1.0), ("a", 1, 5.0), ("b", 1, 9.0), ("b", 1, 2.0), ("c", 0, 3.0), ("c", None, 7.0)]
    by = {}
    for i, p, y in rows:
        by.setdefault(i, ([], []))[1].append(y)
        if p is not None:
            by[i][0].append(p)
    matched = np.array([pair for x, y in by.values() for pair in product(x, y)])
    assert promo_profit_corr(pairs(spark, rows)).first()["value"] == round(np.corrcoef(matched.T)[0, 1], 4)
