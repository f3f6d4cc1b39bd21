"""Extendible hashing: a directory indexed by hash-prefix bits, whose buckets hold at most a byte limit each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailloom.llm.common import numbered
from retailloom.session import materialize

LIMIT_BYTES = 64 << 20
KEY_BITS, ROW_BITS = 40, 20
ALL_BITS = KEY_BITS + ROW_BITS
STEP = 8  # prefix bits by which one pass refines the buckets that are still too large


def _md5_bits(text: Column, bits: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, bits // 4), 16, 10).cast("long")


def _levels(depths, prefix: str, length: int) -> Column:
    """One entry per depth: the first ``depth`` bits of ``prefix``, which has ``length`` bits."""
    return F.explode(F.array([
        F.struct(F.lit(d).alias("depth"), F.expr(f"shiftrightunsigned({prefix}, {length - d})").alias("prefix"))
        for d in depths]))


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """The final buckets of ``rows(bits, bytes)``: depth, prefix, bytes, rows.

    A bucket splits on its next bit only while it is over the limit. One pass sums the bytes for ``STEP`` more
    prefix bits of the buckets still too large and takes, for each, the shortest prefix that fits; only the rows
    of cells that fit at none of these depths go on to the next pass. What a pass writes is one row per prefix.
    """
    depth, found = 0, None
    while True:
        last = min(depth + STEP, ALL_BITS)
        cell = F.expr(f"shiftrightunsigned(bits, {ALL_BITS - last})").alias("cell")
        cells = materialize(rows.groupBy(cell).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("rows")), "cells")
        sums = (cells.select(_levels(range(depth, last + 1), "cell", last).alias("at"), "bytes", "rows")
                .groupBy("at.depth", "at.prefix").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")))
        fits = (F.col("bytes") <= limit) | (F.col("rows") == 1) | (F.col("depth") == ALL_BITS)
        # A prefix is a bucket if it fits and its parent, one bit shorter, does not.
        parents = sums.where(~fits).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        split = (sums.where(fits).withColumn("parent", F.expr("shiftrightunsigned(prefix, 1)"))
                 .join(parents, ["depth", "parent"], "left_semi").drop("parent"))
        whole = sums.where(fits & (F.col("depth") == 0))
        buckets = materialize(split.unionByName(whole), "buckets")
        found = buckets if found is None else found.unionByName(buckets)
        too_large = cells.where((F.col("bytes") > limit) & (F.col("rows") > 1)).select("cell")
        if last == ALL_BITS or too_large.isEmpty():
            return found
        rows = materialize(rows.select("bits", "bytes", cell).join(too_large, "cell", "left_semi").drop("cell"), "open")
        depth = last


def assign_shards(docs: DataFrame, key: str = "doc_id", payload: str = "text", limit: int = LIMIT_BYTES) -> DataFrame:
    """Every row's key with its shard: ``shard`` (the hash prefix as a bit string, empty if one shard holds all),
    ``local_depth``, ``row_bytes``, ``shard_bytes``, ``shard_rows``.

    The hash has 40 bits of the key's MD5, so rows of one key stay together while they fit, then 20 bits of the
    row's own number, by which a key that holds too many rows is split as well. A null key hashes as the empty
    text. Null and empty payloads have 0 bytes. A single row over the limit is a shard of its own. Repeated rows
    count one by one. An empty table gives no rows. Columns other than key and payload are not read.
    """
    rows = numbered(docs.select(
        F.col(key).alias("key"), F.octet_length(F.coalesce(F.col(payload), F.lit(""))).cast("long").alias("row_bytes"),
    ), "row", "keys")
    keyed = rows.withColumn(
        "bits", _md5_bits(F.coalesce(F.col("key").cast("string"), F.lit("")), KEY_BITS) * F.lit(1 << ROW_BITS)
        + _md5_bits(F.concat(F.lit("row"), F.col("row").cast("string")), ROW_BITS))
    found = directory(keyed.select("bits", F.col("row_bytes").alias("bytes")), limit)
    depths = sorted(r["depth"] for r in found.select("depth").distinct().collect())  # at most 61 numbers
    return (keyed.select("key", "row_bytes", _levels(depths or [0], "bits", ALL_BITS).alias("at"))
            .select("key", "row_bytes", "at.depth", "at.prefix")
            .join(found.withColumnsRenamed({"bytes": "shard_bytes", "rows": "shard_rows"}), ["depth", "prefix"])
            .select(F.col("key").alias(key),
                    F.when(F.col("depth") == 0, "").otherwise(F.expr("lpad(bin(prefix), depth, '0')")).alias("shard"),
                    F.col("depth").alias("local_depth"), "row_bytes", "shard_bytes", "shard_rows"))
