"""Batch tables of the lake: manifests, folds that break off, compaction by size."""

import math
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from retailloom.schemas import MOVEMENT, fields
from retailloom.sinks import stores
from retailloom.sinks.stores import Lake, Part, like_sized
from retailloom.sources import files
from retailloom.streaming import ingest
from tests.conftest import tuples
from tests.test_streams import LEDGER, movements

NUMBERS = fields("n bigint")
STEPS = ("names", "read_text", "put_if_absent", "remove")


class Lost(Exception):
    pass


def breaking_at(monkeypatch, at, after=False):
    """File-system calls of the lake, of which the one with number ``at`` fails before (or after) its work."""
    calls = []

    def wrap(real):
        def call(*arguments):
            calls.append(real.__name__)
            if len(calls) == at + 1 and not after:
                raise Lost
            result = real(*arguments)
            if len(calls) == at + 1:
                raise Lost
            return result
        return call

    for step in STEPS:
        monkeypatch.setattr(stores, step, wrap(getattr(files, step)))
    return calls


def restored(monkeypatch):
    for step in STEPS:
        monkeypatch.setattr(stores, step, getattr(files, step))


def sums(rows):
    return rows.groupBy("product_id").agg(F.sum("stock_qty").alias("stock_qty"))


@pytest.mark.parametrize("after", [False, True])
def test_a_fold_may_break_off_at_any_call(spark, tmp_path, monkeypatch, after):
    landed = [movements(spark, *[(10 * batch + i, "AB"[i % 2], "opening", 1, 1, None) for i in range(10)]) for batch in range(3)]
    template = Lake(str(tmp_path / "template"))
    for batch, rows in enumerate(landed):
        ingest.append_movements(rows, template, "q", batch)
    at, folded = 0, False
    while not folded:
        lake = Lake(str(tmp_path / f"lake-{at}"))
        spark._jvm.org.apache.commons.io.FileUtils.copyDirectory(
            spark._jvm.java.io.File(template.root), spark._jvm.java.io.File(lake.root))
        calls = breaking_at(monkeypatch, at, after)
        try:
            lake.fold(spark, "movements", MOVEMENT)
            lake.fold(spark, "stock_ledger", LEDGER, sums)
            folded = True
        except Lost:
            pass
        restored(monkeypatch)
        # Readers, without a second fold
        assert lake.read_batches(spark, "movements", MOVEMENT).select("id").distinct().count() == 30
        assert lake.read_batches(spark, "movements", MOVEMENT).count() == 30
        assert lake.read_batches(spark, "stock_ledger", LEDGER).agg(F.sum("stock_qty")).first()[0] == 30
        if at % 4 == 0 or folded:
            ingest.append_movements(landed[0].unionByName(landed[1]), lake, "other", 0)  # resent by another query
            ingest.append_movements(landed[0], lake, "q", 0)  # and a batch that the fold has taken in
            assert lake.read_batches(spark, "stock_ledger", LEDGER).agg(F.sum("stock_qty")).first()[0] == 30
            lake.fold(spark, "movements", MOVEMENT)
            assert lake.read_batches(spark, "movements", MOVEMENT).count() == 30
            lake.drop(spark, "movements")
            lake.drop(spark, "stock_ledger")
            assert lake.read_batches(spark, "movements", MOVEMENT).isEmpty() and not list(Path(lake.root).glob("*"))
        at += 1
    assert at == len(calls) + 1 > 12


def test_an_append_may_break_off_at_any_call(spark, tmp_path, monkeypatch):
    def rows(*numbers):
        return spark.createDataFrame([(n,) for n in numbers], NUMBERS)

    at, done = 0, False
    while not done:
        lake = Lake(str(tmp_path / str(at)))
        lake.append_batch(rows(1), "t", "q", 0)
        lake.append_batch(rows(2, 3), "t", "q", 1)
        breaking_at(monkeypatch, at)
        try:
            lake.append_batch(rows(2, 3, 4), "t", "q", 1)
            done = True
        except Lost:
            pass
        restored(monkeypatch)
        assert tuples(lake.read_batches(spark, "t", NUMBERS).select("n")) in ([(1,), (2,), (3,)], [(1,), (2,), (3,), (4,)])
        lake.append_batch(rows(2, 3, 4), "t", "q", 1)
        assert tuples(lake.read_batches(spark, "t", NUMBERS).select("n")) == [(1,), (2,), (3,), (4,)]
        assert len(list((Path(lake.root) / "t").glob("query_id=q/batch_id=1/attempt=*"))) == 1
        at += 1


def test_one_writer_wins_a_version(spark, tmp_path, monkeypatch):
    """Another writer commits between the look and the put: the loser looks again, and both are in."""
    lake, other = Lake(str(tmp_path)), []
    real = files.put_if_absent

    def late(session, path, text):
        if not other:
            other.append(1)
            monkeypatch.setattr(stores, "put_if_absent", real)
            lake.append_batch(session.createDataFrame([(7,)], NUMBERS), "t", "second", 0)
        return real(session, path, text)

    monkeypatch.setattr(stores, "put_if_absent", late)
    lake.append_batch(spark.createDataFrame([(1,)], NUMBERS), "t", "first", 0)
    assert tuples(lake.read_batches(spark, "t", NUMBERS).select("n", "query_id")) == [(1, "first"), (7, "second")]
    assert lake.manifest(spark, "t").version == 2
    assert files.put_if_absent(spark, lake.path("t/_versions/2.json"), "x") is False


def test_a_fold_gives_way_to_a_rebuild(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path))
    for batch in range(3):
        lake.append_batch(spark.createDataFrame([(batch,)], NUMBERS), "t", "q", batch)
    real, done = Lake._written, []

    def slow(self, df, name, query, batch):
        part = real(self, df, name, query, batch)
        if query == "folded" and not done:
            done.append(1)
            lake.replace_batches(spark.createDataFrame([(100,)], NUMBERS), "t")
        return part

    monkeypatch.setattr(Lake, "_written", slow)
    lake.fold(spark, "t", NUMBERS)
    assert tuples(lake.read_batches(spark, "t", NUMBERS).select("n")) == [(100,)]


def test_readers_under_way_can_finish(spark, tmp_path):
    lake = Lake(str(tmp_path))
    for batch in range(4):
        lake.append_batch(spark.createDataFrame([(batch,)], NUMBERS), "t", "q", batch)
    reader = lake.read_batches(spark, "t", NUMBERS)
    lake.fold(spark, "t", NUMBERS, keep=1)
    assert reader.count() == 4 and lake.read_batches(spark, "t", NUMBERS).count() == 4
    lake.append_batch(spark.createDataFrame([(4,)], NUMBERS), "t", "q", 4)
    lake.append_batch(spark.createDataFrame([(5,)], NUMBERS), "t", "q", 5)
    lake.fold(spark, "t", NUMBERS, keep=1)
    assert not (tmp_path / "t" / "query_id=q" / "batch_id=0").exists()
    assert tuples(lake.read_batches(spark, "t", NUMBERS).select("n")) == [(i,) for i in range(6)]


def test_rows_are_rewritten_a_logarithm_of_times(spark, tmp_path):
    """64 batches, a fold after each: at most log2(64) times the rows, and few folders at any time."""
    lake, written = Lake(str(tmp_path), small=1), 0
    for batch in range(65):
        lake.append_batch(spark.range(batch * 100, batch * 100 + 100).withColumnRenamed("id", "n").coalesce(1), "t", "q", batch)
        written += lake.fold(spark, "t", NUMBERS)
        assert len(lake.manifest(spark, "t").parts) <= 1 + 1 + int(math.log2(batch + 1))
    rows = lake.read_batches(spark, "t", NUMBERS)
    assert rows.count() == rows.select("n").distinct().count() == 6500
    assert written <= math.log2(64) * 6400
    assert len(list((tmp_path / "t" / "_versions").glob("*.json"))) < 10


def test_size_classes():
    rng = random.Random(3)
    parts, cost, total, number = [], 0, 0, 0
    for batch in range(3000):
        rows = rng.choice([1, 3, 50, 700])
        total += rows
        parts.append(Part("q", batch, "a", rows))
        for group in like_sized(parts, 1):
            number += 1
            together = Part("folded", number, "a", sum(p.rows for p in group))
            cost += together.rows
            parts = [p for p in parts if p not in group] + [together]
        assert len(parts) <= 1 + math.log2(total)
    assert cost <= math.log2(total) * total and sum(p.rows for p in parts) == total
    assert like_sized([], 8) == [] and like_sized([Part("q", 0, "a", 0)], 8) == []
    assert len(like_sized([Part("q", i, "a", 0) for i in range(3)], 8)[0]) == 3
