import base64
import gzip
import hashlib
import os

import pytest

from retailloom.llm import warc

PAGES = "page_id long, url string, html string, shard string, sha1 string, target string"


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "own", "own", "own") for i, u, h in rows], PAGES).repartition(3)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(rows, least=0):
    largest = {}
    for i, _, h in rows:
        largest[h or ""] = max(largest.get(h or "", -1), -1 if i is None else i)
    out = []
    for i, u, h in rows:
        own = h or ""
        revisit = len(own.encode()) >= least and (-1 if i is None else i) != largest[own]
        out.append((i, u, None if revisit else own.encode(), len(own.encode()), digest(h),
                    "revisit" if revisit else "response", largest[own] if revisit else None))
    return sorted(out, key=str)


def written(spark, rows, folder, **more):
    warc.write_archives(pages_of(spark, rows), folder, **more)
    return sorted([(r["page_id"], r["url"], None if r["payload"] is None else bytes(r["payload"]), r["payload_bytes"],
                    r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in warc.read_archives(spark, folder).collect()], key=str)


ROWS = [(i, f"http://h/{i}", f"<p>{i % 40} " + "é" * (i % 7) + "</p>" * (i % 11)) for i in range(300)]
ODD = [(1000, None, None), (1001, "http://x/a b\r\nWARC: y", ""), (1002, "http://é/ ", "a\r\n\r\nb\x00c"),
       (None, "http://n", "no id"), (1003, "u", "z" * 3_000_000), (2**53 + 1, "u", "far")]


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_round_trip(spark, tmp_path, scheme):
    rows = ROWS + ODD
    found = written(spark, rows, f"{scheme}{tmp_path}/w", range_bytes=1000, roll_bytes=2000)
    assert found == expected(rows)
    names = [n for n in os.listdir(tmp_path / "w") if n.endswith(".gz")]
    assert len(names) > 10
    manifest = {r["name"]: r for r in spark.read.parquet(f"{tmp_path}/w/manifest").collect()}
    assert set(manifest) == set(names)
    for name in names:
        data = (tmp_path / "w" / name).read_bytes()
        assert (len(data), hashlib.sha1(data).hexdigest()) == (manifest[name]["bytes"], manifest[name]["sha1"])
        assert gzip.decompress(data).count(b"WARC/1.1\r\n") >= manifest[name]["records"] + 1
    order = [i for name in sorted(names) for i in ids_in((tmp_path / "w" / name))]
    assert [i for i in order if i is not None] == sorted(i for i in order if i is not None)


def ids_in(path):
    with path.open("rb") as stream:
        for member in warc.members(stream, 100):
            fields, _ = warc.parsed(member)
            if fields["WARC-Type"] != "warcinfo":
                yield int(fields["X-Page-Id"]) if "X-Page-Id" in fields else None


def test_two_runs_write_the_same_bytes(spark, tmp_path):
    for name, parts in (("a", 2), ("b", 7)):
        warc.write_archives(pages_of(spark, ROWS).repartition(parts), f"{tmp_path}/{name}", range_bytes=3000, roll_bytes=1500)
    one, two = ({n: (tmp_path / x / n).read_bytes() for n in os.listdir(tmp_path / x) if n.endswith(".gz")} for x in "ab")
    assert one == two and len(one) > 3


def test_small_payloads_are_no_revisits(spark, tmp_path):
    assert written(spark, ROWS, f"{tmp_path}/w", revisit_bytes=30) == expected(ROWS, 30)


def test_one_payload_for_all(spark, tmp_path):
    rows = [(i, "u", "same") for i in range(500)]
    assert written(spark, rows, f"{tmp_path}/w", range_bytes=400) == expected(rows)


def test_repeated_rows_and_empty_table(spark, tmp_path):
    rows = [(5, "u", "x"), (5, "u", "x"), (4, "u", "x"), (6, "u", "y"), (6, "u", "z")]
    found = [(r[0], r[5], r[6]) for r in written(spark, rows, f"{tmp_path}/w")]
    assert sorted(found, key=str) == sorted([(5, "response", None), (5, "revisit", 5), (4, "revisit", 5),
                                             (6, "response", None), (6, "response", None)], key=str)
    assert written(spark, [], f"{tmp_path}/e") == []


def test_what_an_attempt_left_behind_is_not_read(spark, tmp_path):
    warc.write_archives(pages_of(spark, ROWS), f"{tmp_path}/w")
    left = tmp_path / "w" / "_temporary" / "other"
    left.mkdir(parents=True)
    (left / "pages-000000-00000.warc.gz").write_bytes(b"half a fi")
    (tmp_path / "w" / "pages-000099-00000.warc.gz").write_bytes(b"not listed")
    assert warc.read_archives(spark, f"{tmp_path}/w").count() == len(ROWS)


def test_a_damaged_payload_is_noticed(spark, tmp_path):
    record = warc.page_record("1", "u", b"payload", digest("other"), None, 0)
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "x.warc.gz").write_bytes(record)
    spark.createDataFrame([("x.warc.gz",)], "name string").write.parquet(f"{tmp_path}/w/manifest")
    with pytest.raises(Exception, match="differs from its digest"):
        warc.read_archives(spark, f"{tmp_path}/w").collect()
