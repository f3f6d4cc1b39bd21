"""De-duplication against history: the key index, and streaming state."""

import time
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from retailloom.operators import dedup
from retailloom.plans import queries
from retailloom.schemas import FACT, FACT_KEYS, FACT_PARTITIONS, KEY_INDEX
from retailloom.session import ROCKSDB, STATE_STORE, shared_dir
from retailloom.sinks.stores import Lake
from retailloom.sinks.tables import ensure_table
from retailloom.sources import files
from retailloom.streaming import ingest
from tests.conftest import tuples
from tests.test_streams import drop, sale


def scattered(spark, rows):
    """A fact row per (id, source, month): ids without any order."""
    df = spark.createDataFrame(rows, "txn_id string, source string, month int").selectExpr(
        "*", "2026 year", "make_date(2026, month, 1) txn_date")
    have = {"txn_id", "source", "month", "year", "txn_date"}
    return df.select(*[F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in FACT])


def test_only_partitions_that_hold_a_key_are_opened(spark, database, tmp_path):
    table, lake = f"{database}.sales", Lake(str(tmp_path))
    history = scattered(spark, [(f"T{hash((i, 7)) % 10**9}-{i}", "erp", 1 + i % 12) for i in range(1200)])
    ensure_table(spark, table, FACT, FACT_PARTITIONS)
    ingest.append_fact(history, table, lake, "q", 0)
    fact = spark.table(table)
    old = [r["txn_id"] for r in fact.where("month in (3, 8)").limit(400).collect()][::40]
    months = {r["month"] for r in fact.where(F.col("txn_id").isin(old)).collect()}
    batch = scattered(spark, [(i, "erp", 5) for i in old] + [(f"N{i}", "erp", 5) for i in range(50)] + [(old[0], "pos", 5)])
    index = lake.read_batches(spark, KEY_INDEX, FACT_KEYS)
    assert dedup.partitions_with(batch, index) == sorted(f"erp/2026/{month}" for month in months)
    near = fact.where(dedup._partition(*FACT_PARTITIONS).isin(dedup.partitions_with(batch, index)))
    opened = {path.split("month=")[1].split("/")[0] for path in near.inputFiles()}
    assert opened == {str(month) for month in months} and len(months) < 3
    fresh = dedup.new_only(batch, fact, index)
    assert sorted(r["txn_id"] for r in fresh.collect()) == sorted([f"N{i}" for i in range(50)] + [old[0]])
    none = batch.where("txn_id LIKE 'N%'")
    assert dedup.new_only(none, fact, index) is none  # nothing known: the history is not opened at all


def test_index_is_made_for_a_fact_without_one_and_survives_folds(spark, database, tmp_path):
    table, lake = f"{database}.sales", Lake(str(tmp_path))
    ensure_table(spark, table, FACT, FACT_PARTITIONS)
    rows = [scattered(spark, [(f"T{i}", "erp", 1 + i % 3) for i in range(20 * n, 20 * n + 30)]) for n in range(4)]
    ingest.append_fact(rows[0], table)  # no lake yet
    for n, batch in enumerate(rows):
        ingest.append_fact(batch, table, lake, "q", n)
        lake.fold(spark, KEY_INDEX, FACT_KEYS)
    assert spark.table(table).count() == spark.table(table).select("txn_id").distinct().count() == 90
    assert tuples(lake.read_batches(spark, KEY_INDEX, FACT_KEYS).select("key_hash")) == tuples(
        spark.table(table).select(dedup.key_hash()))


def test_state_stops_what_is_resent_in_time_and_history_the_rest(spark, database, tmp_path):
    landing, table = tmp_path / "in", f"{database}.sales"

    def run(within):
        stream = files.json_lines_stream(spark, str(landing))
        query = ingest.start_ingest(stream, table, str(tmp_path / f"checkpoint-{within}"), None, within)
        query.awaitTermination()
        dropped = sum(op["customMetrics"].get("numDroppedDuplicateRows", 0) for p in query.recentProgress for op in p["stateOperators"])
        held = query.lastProgress["stateOperators"][0]["numRowsTotal"] if query.lastProgress else 0
        spark.catalog.refreshTable(table)
        return dropped, held, spark.table(table).count()

    drop(landing, "1.json", sale(1), sale(1), sale(2), sale(2, "pos"), {"txn_id": None}, "{broken")
    assert run("1 hour")[0] == 2 and spark.table(table).count() == 3  # the copy, and the second row without any key
    drop(landing, "2.json", sale(2), sale(3), sale(1, "ecommerce"))
    assert run("1 hour")[0] == 1 and spark.table(table).count() == 5  # from the checkpoint


def test_state_is_bounded_and_later_copies_are_found_in_history(spark, database, tmp_path):
    landing, table = tmp_path / "in", f"{database}.sales"
    held = []
    for n in range(4):
        drop(landing, f"{n}.json", *[sale(i) for i in range(100 * n, 100 * n + 100)], *[sale(i) for i in range(20)])
        query = ingest.start_ingest(files.json_lines_stream(spark, str(landing)), table, str(tmp_path / "checkpoint"), None, "1 second")
        query.awaitTermination()
        held.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
        time.sleep(1.5)
    spark.catalog.refreshTable(table)
    assert spark.table(table).count() == 400 and max(held) < 250


@pytest.fixture
def heap_state(spark):
    """A session as Spark's defaults leave it: state in the executors' heaps."""
    heap = ROCKSDB.replace("RocksDBStateStore", "HDFSBackedStateStore")
    spark.conf.set(STATE_STORE, heap)
    yield heap
    spark.conf.set(STATE_STORE, ROCKSDB)


def test_state_lies_on_disk_whatever_the_session_says(spark, database, tmp_path, heap_state):
    drop(tmp_path / "in", "1.json", sale(1), sale(1), sale(2))
    stream = files.json_lines_stream(spark, str(tmp_path / "in"))
    query = ingest.start_ingest(stream, f"{database}.sales", str(tmp_path / "checkpoint"), None, "1 hour")
    query.awaitTermination()
    assert any(name.startswith("rocksdb") for name in query.lastProgress["stateOperators"][0]["customMetrics"])
    assert spark.conf.get(STATE_STORE) == heap_state


def test_resends_are_stopped_by_state_on_disk(spark, heap_state):
    tills = spark.createDataFrame([(f"T{i}", "pos", f"{i}") for i in range(20)], "txn_id string, source string, qty string")
    every = tills.unionByName(tills.withColumn("source", F.lit("erp")))
    before = set(Path(shared_dir(spark)).glob("state-*"))
    rows = queries.resends_by_state(SimpleNamespace(spark=spark, all_sources=lambda: every, pos=lambda: tills))
    assert tuples(rows.select("txn_id", "source")) == tuples(every.select("txn_id", "source"))
    [own] = set(Path(shared_dir(spark)).glob("state-*")) - before
    kinds = {path.suffix for path in (own / "checkpoint" / "state").rglob("*") if path.is_file()}
    assert ".zip" in kinds and ".delta" not in kinds
