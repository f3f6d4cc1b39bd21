"""WARC archives: a deterministic sharded writer and its reader.

Records are sorted by page id into ranges of about equal payload. Each task writes whole files under a temporary
name of its own attempt and returns their names, sizes and digests. Only files that the manifest lists are renamed,
and the manifest is written last: what a lost executor or a second attempt leaves behind is never read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailloom.llm.common import as_numbers, as_text
from retailloom.session import materialize

RANGE_BYTES = 64 << 20  # of payload in one range
ROLL_BYTES = 16 << 20  # of compressed records after which a file is closed
SAMPLE = 20_000  # page ids that the bounds of the ranges are taken from, about
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the name space of URLs
MANIFEST = "shard int, part int, temporary string, name string, bytes long, sha1 string, records long"
RECORDS = ("page_id string, url string, payload binary, payload_bytes long, payload_digest string, "
           "record_type string, refers_to string")


def _place(uri: str):
    """The file system of a URI or plain path, and the path within it."""
    return arrow_fs.FileSystem.from_uri(uri) if ":/" in uri else (arrow_fs.LocalFileSystem(), uri)


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _name(page_id, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'page/{page_id}/{digest}/{copy}')}>"


def _record(fields: dict[str, str], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + f"Content-Length: {len(block)}\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def page_record(page_id, url, payload: bytes, digest: str, target, copy: int) -> bytes:
    """A gzip member with one record: a response, or a revisit without payload if ``target`` is given (a one-tuple).
    Ids are text."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if target else http + payload
    fields = {"WARC-Type": "revisit" if target else "response", "WARC-Record-ID": _name(page_id, digest, copy),
              "WARC-Date": DATE}
    if url is not None:
        fields["WARC-Target-URI"] = "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in url)
        if fields["WARC-Target-URI"] != url:
            fields["X-Target-Base64"] = base64.b64encode(url.encode("utf-8", "surrogatepass")).decode()
    if page_id is not None:
        fields["X-Page-Id"] = page_id
    if target:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _name(target[0], digest, 0)}
        if target[0] is not None:
            fields["X-Refers-To-Page-Id"] = target[0]
    fields |= {"WARC-Payload-Digest": f"sha1:{digest}",
               "WARC-Block-Digest": f"sha1:{base32(hashlib.sha1(block).digest())}",
               "Content-Type": "application/http; msgtype=response"}
    return _record(fields, block)


class _Files:
    """The files of one task: opened on the first record of a part, closed when they are full or the range ends."""

    def __init__(self, folder: str, roll: int):
        self.fs, self.root = _place(folder)
        self.roll, self.attempt = roll, uuid.uuid4().hex
        self.shard, self.part, self.out, self.done = None, 0, None, []
        self.fs.create_dir(f"{self.root}/_temporary/{self.attempt}", recursive=True)

    def write(self, shard: int, member: bytes) -> None:
        if shard != self.shard:
            self.close()
            self.shard, self.part = shard, 0
        if self.out is None:
            self.name = f"pages-{shard:06d}-{self.part:05d}.warc.gz"
            self.path = f"_temporary/{self.attempt}/{self.name}"
            self.out, self.size, self.sha1, self.records = self.fs.open_output_stream(
                f"{self.root}/{self.path}", compression=None), 0, hashlib.sha1(), 0
            body = b"software: sharded writer\r\nformat: WARC File Format 1.1\r\n"
            self._append(_record({
                "WARC-Type": "warcinfo", "WARC-Date": DATE, "WARC-Filename": self.name,
                "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(SPACE, 'file/' + self.name)}>",
                "Content-Type": "application/warc-fields"}, body))
        self._append(member)
        self.records += 1
        if self.size >= self.roll:
            self.close()

    def _append(self, data: bytes) -> None:
        self.out.write(data)
        self.sha1.update(data)
        self.size += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.shard, self.part, self.path, self.name, self.size, self.sha1.hexdigest(), self.records))
            self.out, self.part = None, self.part + 1

    def listed(self) -> pd.DataFrame:
        rows, self.done = self.done, []
        return pd.DataFrame(rows, columns=["shard", "part", "temporary", "name", "bytes", "sha1", "records"])


def _writer(folder: str, roll: int):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A revisit's mark comes right before the rows that it marks."""
        files, mark, last, copy = None, None, None, 0
        for batch in batches:
            files = files or _Files(folder, roll)
            for shard, page_id, sha1, url, payload, marked, target in zip(
                    batch["shard"], batch["page_id"], batch["sha1"], batch["url"], batch["payload"], batch["marked"],
                    batch["target"]):
                if marked:
                    mark = (page_id, sha1, target)
                    continue
                copy = copy + 1 if last == (page_id, sha1) else 0
                last = (page_id, sha1)
                refers = (mark[2],) if mark and mark[:2] == last else (page_id,) if copy else None
                files.write(int(shard), page_record(page_id, url, bytes(payload), base32(bytes.fromhex(sha1)), refers, copy))
            yield files.listed()
        if files:
            files.close()
            yield files.listed()

    return write


def _committer(folder: str):
    def commit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = _place(folder)
        for batch in batches:
            for temporary, name in zip(batch["temporary"], batch["name"]):
                if fs.get_file_info(f"{root}/{temporary}").type == arrow_fs.FileType.File:
                    fs.move(f"{root}/{temporary}", f"{root}/{name}")
            yield batch

    return commit


def write_archives(pages: DataFrame, folder: str, revisit_bytes: int = 0, range_bytes: int = RANGE_BYTES,
                   roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write ``pages(page_id, url, html)`` to ``folder`` and return the manifest, also kept in ``folder/manifest``.

    Of equal payloads of ``revisit_bytes`` at least, the record of the largest page_id is the response and the others
    are revisits of it. A null page is an empty payload. Null page ids come last and count as smallest. Of repeated
    rows (same id, same payload) the first is the response or revisit that the id is, the others revisit it. An empty
    table gives an empty manifest. Columns other than the three are not read.

    The payload is shuffled once, into its range. Which records are revisits is worked out on ids and digests
    alone, and sent to the ranges as rows of its own.
    """
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload")
                         ).withColumn("sha1", F.sha1("payload"))
    ids = materialize(keyed.select("page_id", "sha1", F.octet_length("payload").cast("long").alias("size")), "digests")
    largest = (ids.where(F.col("size") >= revisit_bytes).groupBy("sha1")
               .agg(F.max("page_id").alias("target"), F.count("*").alias("n")).where("n > 1").drop("n"))
    marks = ids.join(largest, "sha1").where(~F.col("page_id").eqNullSafe(F.col("target"))).select(
        "page_id", "sha1", "target").distinct()
    total = ids.agg(F.sum("size").alias("bytes"), F.count("page_id").alias("n")).first()
    ranges = max(1, -(-(total["bytes"] or 0) // range_bytes))
    every = max(1, total["n"] // SAMPLE)
    sample = sorted({r["page_id"] for r in ids.where(  # about SAMPLE ids, by a hash: the same in every run
        F.pmod(F.xxhash64("page_id"), F.lit(every)) == 0).select("page_id").where("page_id is not null").collect()})
    bounds = sorted({float(sample[len(sample) * i // ranges]) for i in range(1, ranges)} if sample else set())
    splits = [float("-inf"), *bounds, float("inf")]
    ranged = Bucketizer(splits=splits if len(splits) > 2 else [float("-inf"), 0.0, float("inf")],
                        inputCol="at", outputCol="range", handleInvalid="keep")
    rows = keyed.select("page_id", "sha1", "url", "payload", F.lit(False).alias("marked"),
                        F.lit(None).cast("long").alias("target")).unionByName(
        marks.select("page_id", "sha1", F.lit(None).cast("string").alias("url"),
                     F.lit(None).cast("binary").alias("payload"), F.lit(True).alias("marked"), "target"))
    last = len(splits) - 2
    shard = F.when(F.col("page_id").isNull(), last).otherwise(
        F.col("range").cast("int") if last else F.lit(0)).cast("int")
    sorted_ = (ranged.transform(rows.withColumn("at", F.col("page_id").cast("double"))).withColumn("shard", shard)
               .repartitionById(last + 1, F.col("shard"))
               .sortWithinPartitions("shard", F.col("page_id").asc_nulls_last(), "sha1", F.desc("marked"), "url")
               .select("shard", as_text("page_id"), "sha1", "url", "payload", "marked", as_text("target")))
    written = materialize(sorted_.mapInPandas(_writer(folder, roll_bytes), MANIFEST), "written")
    written.mapInPandas(_committer(folder), MANIFEST).write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.parquet(f"{folder}/manifest")


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a stream, one after the other."""
    unpack, parts, data = zlib.decompressobj(31), [], b""
    while True:
        if not data:
            data = stream.read(chunk)
            if not data:
                if parts:
                    raise ValueError("the archive ends within a record")
                return
        parts.append(unpack.decompress(data))
        data = unpack.unused_data
        if unpack.eof:
            yield b"".join(parts)
            unpack, parts = zlib.decompressobj(31), []


def parsed(member: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = member.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(fields["Content-Length"])]
    if version != "WARC/1.1" or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    return fields, block


def _reader(folder: str):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = _place(folder)
        columns = [c.split()[0] for c in RECORDS.split(", ")]

        for batch in batches:
            for name in batch["name"]:
                out, size = [], 0
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for member in members(stream):
                        fields, block = parsed(member)
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        stated = int(http.rpartition(b"Content-Length: ")[2])
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        revisit = fields["WARC-Type"] == "revisit"
                        if not revisit and (len(payload) != stated or base32(hashlib.sha1(payload).digest()) != digest):
                            raise ValueError(f"{name}: a payload differs from its digest")
                        url = fields.get("WARC-Target-URI")
                        if "X-Target-Base64" in fields:
                            url = base64.b64decode(fields["X-Target-Base64"]).decode("utf-8", "surrogatepass")
                        out.append((fields.get("X-Page-Id"), url, None if revisit else payload, stated, digest,
                                    fields["WARC-Type"], fields.get("X-Refers-To-Page-Id")))
                        size += len(payload)
                        if size > 8 << 20:
                            yield pd.DataFrame(out, columns=columns)
                            out, size = [], 0
                yield pd.DataFrame(out, columns=columns)

    return read


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all files of the manifest: page_id, url, payload (null for revisits), payload_bytes,
    payload_digest (bare base 32, checked against the payload), record_type, refers_to."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    files = max(1, manifest.count())
    records = manifest.select("name").repartition(files, "name").mapInPandas(_reader(folder), RECORDS)
    return as_numbers(records, "page_id", "refers_to")
