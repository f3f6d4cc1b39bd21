"""What the ingest leaves on disk."""

import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from retailloom import session
from retailloom.operators.dedup import dedup
from retailloom.operators.normalize import to_fact
from retailloom.schemas import FACT, FACT_KEY, FACT_KEYS, FACT_PARTITIONS, KEY_INDEX
from retailloom.session import shared_dir, shuffles_released
from retailloom.sinks.stores import Lake
from retailloom.sinks.tables import ensure_table
from retailloom.sources import files
from retailloom.streaming import ingest
from tests.conftest import tuples


def shuffle_files(spark) -> set[str]:
    every = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(every.size()) if (name := every.apply(i).getName()).startswith("shuffle_")}


def test_landed_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "LANDED_ROWS", 10)
    folder = tmp_path / "in"
    files.land(spark.range(25).selectExpr("concat('L', id) txn_id", "'erp' source").coalesce(1), str(folder))
    sizes = [len(gzip.open(path).read().splitlines()) for path in folder.glob("part-*.json.gz")]
    assert sorted(sizes) == [5, 10, 10] and files.json_lines(spark, str(folder)).count() == 25


@pytest.mark.parametrize("cubes", [False, True])
def test_a_batch_leaves_neither_shuffles_nor_folders(spark, shop, database, tmp_path, cubes):
    table = f"{database}.sales"
    ensure_table(spark, table, FACT, FACT_PARTITIONS)
    lake = Lake(str(tmp_path)) if cubes else None
    before, folders = shuffle_files(spark), files.names(spark, shared_dir(spark))
    for batch in range(2):
        ingest.append_fact(shop.fact, table, lake, "q", batch)
    assert files.names(spark, shared_dir(spark)) == folders
    assert len(shuffle_files(spark) - before) <= 4  # of the look-ups, a few rows each
    assert tuples(spark.table(table).select("txn_id", "source")) == tuples(shop.fact.select("txn_id", "source"))


def test_the_setting_is_put_back(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with pytest.raises(ZeroDivisionError), shuffles_released(spark):
        assert spark.conf.get(name) == "true"
        1 / 0
    assert spark.conf.get(name) == before


def sales(spark, first, last):
    """Finance rows of 20 months, each third one twice, in another month and with other figures."""
    rows = spark.range(first, last).withColumn("copy", F.explode(F.expr("if(id % 3 = 0, array(0, 1), array(0))")))
    return rows.selectExpr("concat('L', id) txn_id", "'erp' source", "cast(id + copy as string) qty", "cast(7.5 - copy as string) revenue",
                           "cast(add_months(date'2026-01-01', cast((id + copy) % 20 as int)) as string) txn_date")


@pytest.fixture
def slices(spark, monkeypatch):
    """Every cell a slice of its own; lists the cells that the folders hold whenever the fact is written to."""
    held, write = [], ingest.append_partitioned

    def seen(df, *args, **more):
        write(df, *args, **more)
        held.append(sorted(path.name for path in Path(shared_dir(spark)).glob("*/_cell=*")))

    monkeypatch.setattr(session, "SLICE_BYTES", 1)
    monkeypatch.setattr(ingest, "append_partitioned", seen)
    return held


@pytest.mark.parametrize("compared", [1_000_000, 60])
@pytest.mark.parametrize("cubes", [False, True])
def test_a_batch_is_written_slice_by_slice_and_goes_as_it_is_written(spark, database, tmp_path, monkeypatch, slices, cubes, compared):
    monkeypatch.setattr(ingest, "COMPARED", compared)
    table, lake = f"{database}.sales", Lake(str(tmp_path)) if cubes else None
    ensure_table(spark, table, FACT, FACT_PARTITIONS)
    first, second = sales(spark, 0, 300), sales(spark, 200, 400)
    ingest.append_fact(first, table, lake, "q", 0)
    assert [len(cells) for cells in slices] == list(range(len(slices), 0, -1)) and len(slices) > 3
    wanted = dedup(to_fact(first), FACT_KEY)
    assert tuples(spark.table(table).select(FACT.fieldNames())) == tuples(wanted)
    for _ in range(2):
        ingest.append_fact(second, table, lake, "q", 1)
        later = dedup(to_fact(second), FACT_KEY).where("cast(substr(txn_id, 2) as int) >= 300")
        assert tuples(spark.table(table).select(FACT.fieldNames())) == tuples(wanted.unionByName(later))
    if cubes:
        assert lake.read_batches(spark, KEY_INDEX, FACT_KEYS).count() == 400


def test_copies_of_one_key_are_all_compared(spark, database, slices):
    table = f"{database}.sales"
    ensure_table(spark, table, FACT, FACT_PARTITIONS)
    raw = spark.range(500).selectExpr("'L1' txn_id", "'erp' source", "cast(500 - id as string) qty")
    ingest.append_fact(raw, table)
    assert tuples(spark.table(table).select("txn_id", "qty")) == [("L1", 1)]
    ingest.append_fact(raw.where("false"), table)
    assert spark.table(table).count() == 1


def test_landing_leaves_no_shuffles(spark, tmp_path):
    before = shuffle_files(spark)
    files.land(spark.range(100).repartition(3).selectExpr("concat('L', id) txn_id"), str(tmp_path / "in"))
    assert not shuffle_files(spark) - before
