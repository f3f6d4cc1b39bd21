import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from retailloom.functions.columns import id_number, period_start, whole
from retailloom.functions.messages import from_messages, split_array, to_messages
from retailloom.operators import normalize
from retailloom.schemas import EVENT, FACT, LANDING, fields
from retailloom.sources import files, tables
from tests.conftest import tuples

INVOICE = {
    "invoice_id": "INV000000815", "store_id": "Harbour", "region": "North", "Ngay": "2026-05-04",
    "lines": [{"txn_id": "L1", "product_id": "P1", "qty": 3, "Doanh_Thu": 87, "promotion": 0},
              {"txn_id": "L2", "product_id": "P2", "qty": 1, "Doanh_Thu": 8.0, "promotion": 1.0}],
}


def messages(spark, *objects):
    return spark.createDataFrame([(o if isinstance(o, str) else json.dumps(o),) for o in objects], "value string")


def test_invoice_lines(spark):
    raw = messages(spark, INVOICE, {**INVOICE, "invoice_id": "EMPTY", "lines": []}, "{broken")
    lines = normalize.flatten_invoices(normalize.parse_invoices(raw))
    fact = normalize.to_fact(normalize.normalize_pos(lines))
    assert fact.schema.fieldNames() == FACT.fieldNames()
    assert [f.dataType for f in fact.schema] == [f.dataType for f in FACT]
    wanted = fact.select("txn_id", "invoice_id", "store_id", "region", "qty", "revenue", "promotion", "cost", "channel",
                         "txn_date", "source", "month")
    assert tuples(wanted) == [
        ("L1", "INV000000815", "Harbour", "North", 3, 87.0, 0, None, "offline", date(2026, 5, 4), "pos", 5),
        ("L2", "INV000000815", "Harbour", "North", 1, 8.0, 1, None, "offline", date(2026, 5, 4), "pos", 5)]


def test_given_source_is_kept(spark):
    rows = spark.createDataFrame([("a", None), ("b", "other")], "txn_id string, source string")
    assert tuples(normalize.with_source(rows, "pos")) == [("a", "pos"), ("b", "other")]


def test_ecommerce_and_erp_names(spark):
    orders = spark.createDataFrame([(7, "WEB1", "C1", "East", "P", 1, 5.0, "web", "card", "2026-07-01")],
                                   "id int, order_id string, customer_id string, region string, product_id string, "
                                   "qty int, revenue double, device string, payment_method string, order_date string")
    out = normalize.normalize_ecommerce(orders)
    assert set(out.columns) == {"txn_id", "customer_id", "region", "product_id", "qty", "revenue", "device",
                                "payment_method", "txn_date", "source"}
    erp = spark.createDataFrame([(1, "L1", "online")], "id int, txn_id string, kenh string")
    assert normalize.normalize_erp(erp).columns == ["txn_id", "channel", "source"]


def test_landing_edge_rows(spark, tmp_path):
    lines = [
        {"source": "pos", "txn_id": "A", "qty": 1, "revenue": 5, "promotion": 1.0, "txn_date": "2026-07-01"},
        {"source": "erp", "txn_id": "B", "qty": "2", "revenue": 5.5, "cost": 1, "kenh": "online", "txn_date": "bad"},
        {"source": "ecommerce", "txn_id": "C", "qty": 3.0, "revenue": "x", "txn_date": "2026-02-30"},
        {"source": None, "txn_id": "D"}, {"source": "erp", "txn_id": None}, {"source": "unknown", "txn_id": "E"},
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(json.dumps(o) for o in lines) + "\n{oops\n")
    fact = normalize.to_fact(files.json_lines(spark, str(tmp_path / "in")))
    assert tuples(fact.select("txn_id", "qty", "revenue", "cost", "promotion", "channel", "txn_date", "month")) == [
        ("A", 1, 5.0, None, 1, "offline", date(2026, 7, 1), 7), ("B", 2, 5.5, 1.0, None, "online", None, None),
        ("C", 3, None, None, None, "online", None, None), ("E", None, None, None, None, None, None, None)]


def test_no_landing_is_no_data(spark, tmp_path):
    assert files.json_lines(spark, str(tmp_path / "missing")).isEmpty()
    (tmp_path / "empty").mkdir()
    empty = files.json_lines(spark, str(tmp_path / "empty"))
    assert empty.isEmpty() and empty.schema == LANDING


def test_customer_file(spark, tmp_path):
    people = [{"customer_id": f"CUST{i:04d}", "customer_name": f"Customer {i}", "segment": "Consumer", "region": "West"}
              for i in range(3)]
    (tmp_path / "crm.json").write_text(json.dumps(people, indent=2))
    assert files.customer_file(spark, str(tmp_path / "crm.json")).count() == 3


def test_json_both_ways(spark):
    rows = spark.createDataFrame([("erp", "T", 1.5, date(2026, 7, 1))],
                                 "source string, txn_id string, revenue double, txn_date date")
    out = to_messages(rows, "sales-report-clean", key="txn_id")
    assert out.columns == ["key", "value", "topic"]
    assert json.loads(out.first()["value"]) == {
        "source": "erp", "txn_id": "T", "revenue": 1.5, "txn_date": "2026-07-01"}
    back = from_messages(out, EVENT).first()
    assert (back["txn_id"], back["revenue"], back["txn_date"], back["cost"]) == ("T", 1.5, "2026-07-01", None)


def test_array_split(spark):
    raw = messages(spark, [{"a": 1}, {"a": 2}], [], "nonsense")
    assert tuples(split_array(raw, fields("a int"))) == [(1,), (2,)]


@pytest.mark.parametrize("value", [0.5, -0.5, 0.49999999999999994, -0.3, 2.5, -2.5, 1e300, float("inf"), 0.0,
                                   4503599627370495.5, 1.4999999999999998, -1234.5, None])
def test_whole_equals_round(spark, value):
    row = spark.createDataFrame([(value,)], "x double").select(whole(F.col("x")), F.round("x", 0)).first()
    assert repr(row[0]) == repr(row[1])


def test_periods(spark):
    day = spark.createDataFrame([(date(2026, 7, 1),)], "d date")
    found = day.select(*[period_start(F.col("d"), u) for u in ("day", "week", "month", "quarter", "year")]).first()
    assert tuple(found) == (date(2026, 7, 1), date(2026, 6, 29), date(2026, 7, 1), date(2026, 7, 1), date(2026, 1, 1))
    with pytest.raises(ValueError):
        period_start(F.col("d"), "decade")


def test_running_numbers(spark):
    ids = spark.createDataFrame([("INV000000041",), ("INV7x",), ("L3",), (None,)], "id string")
    assert tuple(tables.next_id(ids, "id", "INV").first()) == (41, 42)
    assert tuple(tables.next_id(ids, "id", "WEB").first()) == (None, 0)
    assert ids.select(id_number(F.col("id"), "L")).where("`%s` = 3" % ids.select(id_number(F.col("id"), "L")).columns[0]
                                                          ).count() == 1


def test_incremental_read(spark):
    rows = spark.range(1, 11).withColumnRenamed("id", "id")
    assert tuple(tables.high_water_mark(tables.rows_after(rows, 7), 7).first()) == (3, 10)
    assert tuple(tables.high_water_mark(tables.rows_after(rows, 10), 10).first()) == (0, 10)


def test_table_names(spark, database):
    for name in ("report_a", "agg_day", "inventory", "sales"):
        spark.sql(f"CREATE TABLE {database}.{name} (a int) USING parquet")
    assert tables.table_names(spark, database, ("report_", "agg_"), ("inventory",)) == [
        "agg_day", "inventory", "report_a"]
    assert tables.has_table(spark, f"{database}.sales") and not tables.has_table(spark, f"{database}.nothing")
    listed = spark.createDataFrame([("report_a",), ("sales",), ("inventory",)], "name string")
    assert tuples(tables.matching(listed, "name", ["report%"], ["inventory"])) == [("inventory",), ("report_a",)]
