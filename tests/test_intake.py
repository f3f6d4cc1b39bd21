"""From the operational systems to landing files."""

import json
import random
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

import __spark_entry__ as contract
from retailloom.schemas import INVENTORY_TOPIC, SALES_TOPIC
from retailloom.sinks.stores import Lake
from retailloom.sources.files import json_lines
from retailloom.sources.tables import islands, jdbc_rows_between, rows_between
from retailloom.streaming import intake
from tests.compare import TABLES, connect, difference
from tests.conftest import tuples


def orders(spark, *ids):
    return spark.createDataFrame([(i, f"WEB{i}", "East", 5.0, "2026-07-01") for i in ids],
                                 "id int, order_id string, region string, revenue double, order_date string")


def test_marks_survive_and_only_new_rows_are_read(spark, tmp_path):
    place, landing = Lake(str(tmp_path)), str(tmp_path / "landing")

    def take(*ids):
        feed = intake.stored_table("ecommerce_orders", lambda: orders(spark, *ids), intake.NORMALISED["ecommerce_orders"])
        return intake.take_table(spark, feed, landing, place)

    assert intake.last_mark(spark, place, "ecommerce_orders") == 0
    for ids, mark in (((1, 2), 2), ((1, 2), 2), ((1, 2, 3, 7), 7)):
        assert take(*ids) == mark == intake.last_mark(spark, place, "ecommerce_orders")
    assert tuples(json_lines(spark, landing).select("txn_id", "source")) == [
        (f"WEB{i}", "ecommerce") for i in (1, 2, 3, 7)]


def test_rows_committed_late_land_once(spark, tmp_path):
    place, landing = Lake(str(tmp_path)), str(tmp_path / "landing")

    def take(*ids, patience=intake.PATIENCE):
        feed = intake.stored_table("ecommerce_orders", lambda: orders(spark, *ids), intake.NORMALISED["ecommerce_orders"])
        intake.take_table(spark, feed, landing, place, patience)
        return sorted(int(r[0][3:]) for r in json_lines(spark, landing).select("txn_id").collect())

    assert take(1, 2, 3, 4, 5, 6, 9) == [1, 2, 3, 4, 5, 6, 9]
    assert take(1, 2, 3, 4, 5, 6, 8, 9) == [1, 2, 3, 4, 5, 6, 8, 9]
    assert intake.taken(spark, place, "ecommerce_orders").gaps == ((7, 7, 1),)
    assert take(*range(1, 10), 14) == [*range(1, 10), 14]
    assert take(*range(1, 10), 14) == [*range(1, 10), 14]
    assert intake.taken(spark, place, "ecommerce_orders").gaps == ((10, 13, 3),)
    take(*range(1, 10), 14, patience=2)  # given up
    assert take(*range(1, 15)) == [*range(1, 10), 14]


def test_taken_ids_equal_a_set():
    rng = random.Random(4)
    for _ in range(200):
        known, every, seen = intake.Taken(), list(range(1, 60)), {1}
        known = known.after([(1, 1)], 99)
        while seen != set(every):
            new = {i for i in every if i not in seen and rng.random() < 0.2}
            runs = [(i, i) for i in sorted(new)]
            known, seen = known.after(runs, 99), seen | new
            missing = {i for low, high, _ in known.gaps for i in range(low, high + 1)}
            assert missing == set(range(1, known.last + 1)) - seen and known.last == max(seen)


def test_islands(spark):
    df = spark.createDataFrame([(i,) for i in (5, 1, 2, 2, 7, 8, 9, 70_000, None)] + [(i,) for i in range(65_530, 65_545)], "id long")
    assert islands(df) == [(1, 2), (5, 5), (7, 9), (65_530, 65_544), (70_000, 70_000)]
    assert islands(df.where("false")) == []


def test_invoices_land_once_beside_other_rows(spark, tmp_path):
    landing = str(tmp_path / "landing")
    invoice = {"invoice_id": "INV7", "store_id": "Quay", "region": "North", "Ngay": "2026-05-04",
               "lines": [{"txn_id": "L7", "product_id": "P", "qty": 1, "Doanh_Thu": 3, "promotion": 0}]}
    (tmp_path / "tills").mkdir()
    (tmp_path / "tills" / "a.txt").write_text(json.dumps(invoice) + "\n{broken\n")
    orders(spark, 1).selectExpr("order_id txn_id", "'ecommerce' source").write.json(landing)
    for _ in range(2):
        intake.take_invoices(spark, str(tmp_path / "tills"), landing, str(tmp_path / "checkpoint"))
    assert tuples(json_lines(spark, landing).select("txn_id", "source", "region").where("txn_id is not null")) == [
        ("L7", "pos", "North"), ("WEB1", "ecommerce", None)]


def test_rows_go_to_the_topic_of_their_kind(spark):
    assert intake.topic_of(orders(spark, 1)) == SALES_TOPIC
    assert intake.topic_of(spark.createDataFrame([(1, "nhap")], "id int, loai string")) == INVENTORY_TOPIC
    assert intake.topic_of(spark.createDataFrame([(1, "inbound")], "id int, kind string")) == INVENTORY_TOPIC


def test_no_row_is_lost_over_several_large_partitions(spark, tmp_path):
    """Finance rows in two row groups of 110,000, each read by a task of its own."""
    for name in TABLES:
        (tmp_path / f"{name}.parquet").symlink_to(Path("/root/testdata/sf0.1") / f"{name}.parquet")
    lines = pq.read_table("/root/testdata/sf0.1/lineitem.parquet")
    (tmp_path / "lineitem.parquet").unlink()
    pq.write_table(lines.slice(0, 220_000), tmp_path / "lineitem.parquet", row_group_size=110_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2m")
    try:
        found = contract.queries()["intake_to_landing"](spark, str(tmp_path))
        sums = found.groupBy("source").agg(F.count("*").alias("n"), F.count_distinct("txn_id").alias("ids"),
                                           F.sum("qty").alias("qty"))
        assert difference(sums.withColumn("qty", F.col("qty").cast("long")), connect(str(tmp_path)), f"""
            SELECT source, count(*) AS n, count(DISTINCT txn_id) AS ids, CAST(sum(qty) AS BIGINT) AS qty
            FROM ({contract.oracle_sql()["intake_to_landing"]}) GROUP BY source""") is None
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_rows_between_many_ranges(spark, monkeypatch):
    """More ranges than a condition can hold: short and long ones, overlapping, negative, at the blocks' ends."""
    rng = random.Random(7)
    ranges = [(i, i) for i in range(17, 60_000, 10)] + [(low, low + rng.randrange(40)) for low in rng.sample(range(60_000), 500)]
    ranges += [(-50, -40), (0, 3), (7, 5), (40_000, 44_096), (1 << 33, (1 << 34) + 5)]
    rng.shuffle(ranges)
    table = spark.range(-100, 60_000).union(spark.range(1 << 33, (1 << 33) + 50)).union(spark.range((1 << 34) - 3, (1 << 34) + 9))
    rows = table.union(table.where("id < 100")).selectExpr("id", "-id AS other").union(spark.sql("SELECT null, null"))
    wanted = {i for low, high in ranges if high < 1 << 33 for i in range(low, high + 1)}
    wanted |= {*range(1 << 33, (1 << 33) + 50), *range((1 << 34) - 3, (1 << 34) + 6)}
    held = [r["id"] for r in rows.collect()]
    found = rows_between(rows, ranges)
    assert found.columns == ["id", "other"]
    assert sorted(r["id"] for r in found.collect()) == sorted(i for i in held if i in wanted)
    assert rows_between(rows, []).isEmpty()
    asked = []
    monkeypatch.setattr(type(spark.read), "jdbc", lambda self, url, table, predicates, properties: asked.extend(predicates))
    jdbc_rows_between(spark, "jdbc:x", "t", ranges, {})
    assert 1 < len(asked) <= 32 and asked[0].startswith("id between -50 and -40 or id between 0 and 3 or")


def test_marks_of_many_gaps_take_one_pass():
    gaps = tuple((10 * i, 10 * i + 4, 1) for i in range(1, 200_000))
    after = intake.Taken(3_000_000, 1, gaps).after([(10 * i + 1, 10 * i + 1) for i in range(1, 200_000)], 99)
    assert after.gaps[:3] == ((10, 10, 1), (12, 14, 1), (20, 20, 1)) and len(after.gaps) == 2 * len(gaps)
