import json
from datetime import date

import pytest

from retailloom.functions.names import vietnamese
from retailloom.plans import jobs
from retailloom.sinks.stores import Lake
from tests.conftest import CH, CUSTOMERS, tuples


@pytest.fixture
def cfg(spark, shop, tmp_path):
    shop.fact.drop("month").write.json(str(tmp_path / "landing"))
    shop.movement.selectExpr("product_id", "kind", "qty", "moved_on moved_at").write.json(str(tmp_path / "movements"))
    shop.product.write.parquet(str(tmp_path / "product"))
    (tmp_path / "crm.json").write_text(json.dumps(
        [dict(zip(("customer_id", "customer_name", "segment", "region"), c)) for c in CUSTOMERS + CUSTOMERS[:1]]))
    return jobs.Config(
        database=f"job_{tmp_path.name.replace('-', '_')}", landing=str(tmp_path / "landing"),
        movements=str(tmp_path / "movements"), customers=str(tmp_path / "crm.json"), product=str(tmp_path / "product"),
        lake=str(tmp_path / "lake"), checkpoint=str(tmp_path / "checkpoint"), snapshot_date=date(2026, 8, 3),
        target=Lake(str(tmp_path / "serving")))


def table(spark, cfg, name):
    return spark.table(cfg.table(name))


def test_whole_run_twice(spark, cfg, shop):
    first = jobs.run(spark, cfg)
    assert all(result.ok for result in first.values()), first
    assert first["rollup"].rows == {"day": 3, "week": 2, "month": 2, "quarter": 1, "year": 0}
    assert table(spark, cfg, "sales").count() == 12
    assert table(spark, cfg, "dim_customer").count() == 2
    assert tuples(table(spark, cfg, "report_low_stock").select("product_id")) == [(CH,)]
    assert tuples(table(spark, cfg, "report_region_profit")) == [("East", 450, -150), ("South", 50, -100), ("West", 2020, 790)]
    assert table(spark, cfg, "report_revenue_forecast").first()["revenue_forecast"] == -70
    assert table(spark, cfg, "report_promo_profit_corr").first()["value"] == 0.6769
    assert table(spark, cfg, "report_replenishment_plan").count() == 4
    assert set(first["publish"].rows) == {f"agg_{u}" for u in ("day", "week", "month", "quarter", "year")} | {
        "inventory", "dim_customer"} | {f"report_{n}" for n in (
            "store_month_pnl region_profit top_products_revenue low_stock top_products_profit stock_value channel_pnl "
            "device_payment segment_revenue stock_trend daily_series revenue_forecast store_clusters "
            "promo_profit_corr replenishment_plan").split()}
    assert len(first["publish"].rows) == 22

    second = jobs.run(spark, cfg)
    assert second["rollup"].rows == {"day": 0, "week": 0, "month": 0, "quarter": 0, "year": 0}
    assert second["publish"].rows == first["publish"].rows
    assert table(spark, cfg, "stock_snapshot").count() == 4

    cfg.snapshot_date = date(2026, 8, 4)
    jobs.run(spark, cfg, ["ingest"])
    assert table(spark, cfg, "stock_snapshot").count() == 8

    jobs.reset(spark, cfg)
    assert [t.name for t in spark.catalog.listTables(cfg.database) if not t.isTemporary] == ["dim_product"]
    jobs.reset(spark, cfg, keep=())
    assert not spark.catalog.databaseExists(cfg.database)


def test_reset_starts_anew(spark, cfg):
    jobs.run(spark, cfg)
    before = tuples(table(spark, cfg, "report_region_profit"))
    jobs.reset(spark, cfg)
    again = jobs.run(spark, cfg)
    assert all(result.ok for result in again.values())
    assert again["ingest"].rows["erp"] == 6 and table(spark, cfg, "sales").count() == 12
    assert tuples(table(spark, cfg, "report_region_profit")) == before
    assert tuples(table(spark, cfg, "report_low_stock").select("product_id")) == [(CH,)]


def test_customers_stay_without_an_export_and_the_newest_row_wins(spark, cfg, tmp_path):
    import os

    folder = tmp_path / "crm"
    folder.mkdir()
    names = ("customer_id", "customer_name", "segment", "region")
    for name, time, row in (("b.json", 2_000, ("CUST0001", "Zoe", "Home Office", "South")),
                            ("a.json", 1_000, ("CUST0001", "Ann", "Consumer", "South"))):
        (folder / name).write_text(json.dumps([dict(zip(names, row))]))
        os.utime(folder / name, (time, time))
    cfg.customers = str(folder)
    jobs.run(spark, cfg, ["ingest"])
    assert tuples(table(spark, cfg, "dim_customer")) == [("CUST0001", "Zoe", "Home Office", "South")]
    cfg.customers = str(tmp_path / "nowhere")
    jobs.run(spark, cfg, ["ingest"])
    assert table(spark, cfg, "dim_customer").count() == 1


def test_one_batch_or_many(spark, cfg, shop, tmp_path):
    jobs.run(spark, cfg, ["ingest"])
    expected = [tuples(table(spark, cfg, "sales")), tuples(table(spark, cfg, "inventory"))]
    jobs.reset(spark, cfg)
    cfg.files_per_batch = 1
    jobs.run(spark, cfg, ["ingest"])
    assert [tuples(table(spark, cfg, "sales")), tuples(table(spark, cfg, "inventory"))] == expected


def test_nothing_landed(spark, cfg, tmp_path):
    cfg.landing = str(tmp_path / "nowhere")
    results = jobs.run(spark, cfg, ["ingest", "rollup", "reports"])
    assert results["rollup"].rows == {} and results["reports"].ok
    assert table(spark, cfg, "report_region_profit").isEmpty()


def test_late_sales(spark, cfg, tmp_path):
    jobs.run(spark, cfg, ["ingest", "rollup"])
    assert jobs.late_days(spark, cfg).isEmpty()
    (tmp_path / "landing" / "late.json").write_text(json.dumps({
        "source": "erp", "txn_id": "L000000099", "qty": 1, "revenue": 70, "cost": 50, "txn_date": "2026-07-03"}))
    assert jobs.run(spark, cfg, ["ingest", "rollup"])["rollup"].rows["day"] == 0
    assert tuples(jobs.late_days(spark, cfg).select("period", "revenue", "stored_revenue")) == [
        (date(2026, 7, 3), 70, None)]
    assert jobs.repair_periods(spark, cfg) == {"day": 1, "week": 1, "month": 1, "quarter": 0, "year": 0}
    assert jobs.late_days(spark, cfg).isEmpty()
    repaired = tuples(table(spark, cfg, "agg_week"))
    jobs.rebuild_periods(spark, cfg)
    assert tuples(table(spark, cfg, "agg_week")) == repaired
    assert jobs.late_days(spark, cfg).isEmpty()
    assert tuples(table(spark, cfg, "agg_month").select("revenue")) == [(1020.0,), (1240.0,)]
    assert jobs.run(spark, cfg, ["rollup"])["rollup"].rows == {
        "day": 0, "week": 0, "month": 0, "quarter": 0, "year": 0}


def test_failing_steps(spark, cfg, monkeypatch):
    def broken(*_):
        raise RuntimeError("broken")

    jobs.run(spark, cfg, ["ingest", "rollup"])
    monkeypatch.setattr(jobs, "report_tables", lambda *_: {"bad": broken, "region_profit": lambda: table(
        spark, cfg, "sales").groupBy("region").count().selectExpr("region", "1 profit")})
    results = jobs.run(spark, cfg, ["reports", "publish"])
    assert not results["reports"].ok and "bad" in results["reports"].error
    assert results["publish"].ok and "report_region_profit" in results["publish"].rows
    monkeypatch.setattr(jobs, "STEPS", (jobs.Step("ingest", broken, required=True),))
    with pytest.raises(RuntimeError):
        jobs.run(spark, cfg)
    with pytest.raises(ValueError):
        jobs.run(spark, cfg, ["lunch"])


def test_vietnamese_names(spark):
    plan = spark.createDataFrame([("P", 1, 2.0)], "product_id string, stock_qty int, monthly_demand double")
    shown, name = vietnamese(plan, "report_replenishment_plan")
    assert (shown.columns, name) == (["product_id", "ton_hien_tai", "du_bao_thang"], "bc_kehoach_nhaphang")
    metric = spark.createDataFrame([("promotion_vs_profit", 0.1)], "metric string, value double")
    shown, name = vietnamese(metric, "report_promo_profit_corr")
    assert (tuples(shown), shown.columns, name) == (
        [("khuyen_mai_vs_loi_nhuan", 0.1)], ["chi_tieu", "gia_tri"], "bc_tuongquan")
    alerts = spark.createDataFrame([(1.0,)], "revenue double")
    assert vietnamese(alerts, "rt_alerts")[0].columns == ["revenue"]
    assert vietnamese(alerts, "agg_day")[0].columns == ["doanh_thu"]


def test_command_line(spark, cfg, tmp_path, capsys):
    from retailloom.__main__ import main
    settings = {name: getattr(cfg, name) for name in
                ("database", "landing", "movements", "customers", "product", "lake", "checkpoint")}
    settings |= {"snapshot_date": "2026-08-03", "target": {"lake": str(tmp_path / "serving")}, "in_vietnamese": True}
    (tmp_path / "settings.json").write_text(json.dumps(settings))
    path = str(tmp_path / "settings.json")
    assert main(["batch", path, "ingest", "rollup", "publish"]) == 0
    assert "rollup ok {'day': 3" in capsys.readouterr().out
    assert spark.read.parquet(str(tmp_path / "serving" / "agg_ngay")).columns == ["ky", "doanh_thu", "loi_nhuan", "so_dong"]
    assert main(["late", path]) == 0 and main(["repair", path]) == 0 and main(["rebuild", path]) == 0
    assert table(spark, cfg, "agg_month").count() == 2
    assert main(["reset", path]) == 0
