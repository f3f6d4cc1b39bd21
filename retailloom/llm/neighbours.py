"""Approximate nearest neighbours by cosine: cross-polytope hashing with multiprobe, and exact ranking of what it finds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailloom.session import materialize

TABLES, PROBES, POLYTOPES = 6, 16, 1
NEAREST = 5
ROW_BLOCK, QUERY_BLOCK = 32_768, 4_096  # vectors that meet in one task


def _transform(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2)
        h *= 2
    return x.reshape(n, d) / np.sqrt(d)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one. The largest component is divided out first, so that no square over- or underflows."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def hashed(vectors: np.ndarray, tables: int, polytopes: int, probes: int) -> np.ndarray:
    """The codes of unit vectors, by nearness: shape (vectors, tables, up to ``probes``).

    Three rounds of random signs and a Hadamard transform stand in for a random rotation; the nearest signed axis
    is the hash. Several polytopes make one code; probes are then the pairs of near axes of the largest sum.
    """
    n, dim = vectors.shape
    wide = 1 << max(0, (dim - 1).bit_length())
    padded = np.zeros((n, wide))
    padded[:, :dim] = vectors
    rng = np.random.default_rng([7, dim])
    out = []
    for _ in range(tables):
        best = code = None
        for _ in range(polytopes):
            rotated = padded
            for _ in range(3):
                rotated = _transform(rotated * rng.choice([-1.0, 1.0], wide))
            axes = np.concatenate([rotated, -rotated], axis=1)
            near = np.argsort(-axes, axis=1, kind="stable")[:, :probes]
            score = np.take_along_axis(axes, near, 1)
            if code is None:
                best, code = score, near.astype(np.int64)
            else:
                sums = (best[:, :, None] + score[:, None, :]).reshape(n, -1)
                codes = (code[:, :, None] * (2 * wide) + near[:, None, :]).reshape(n, -1)
                at = np.argsort(-sums, axis=1, kind="stable")[:, :probes]
                best, code = np.take_along_axis(sums, at, 1), np.take_along_axis(codes, at, 1)
        out.append(code)
    return np.stack(out, axis=1)


def _hasher(tables: int, polytopes: int, probes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, part in batch.groupby("dim", sort=False):
                codes = hashed(unit(np.stack(part["vec"]).astype(np.float64)), tables, polytopes, probes)
                yield part.drop(columns="asked").assign(
                    codes=list(codes[:, :, 0]),
                    probes=[list(own) if asked else None for own, asked in zip(codes, part["asked"])])

    return run


def _ranker(nearest: int):
    """The best of a block of rows for each query of a block: one more than asked for, as it may find itself."""
    def run(key, rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(queries):
            x, q = unit(np.stack(rows["vec"]).astype(np.float64)), unit(np.stack(queries["vec"]).astype(np.float64))
            ids, cids = rows["ids"].to_numpy(), rows["cid"].to_numpy()
            for at in range(0, len(q), 256):
                dots = q[at:at + 256] @ x.T
                for own, cid, row in zip(q[at:at + 256], queries["cid"].to_numpy()[at:at + 256], dots):
                    k = min(nearest + 1, len(row))
                    least = np.partition(row, len(row) - k)[len(row) - k]
                    found = np.nonzero(row >= least - 1e-9)[0]  # ties and rounding included
                    # Summed row by row, so that equal vectors have equal scores in every block.
                    exact = (x[found] * own).sum(axis=1)
                    best = sorted((-s, i, c) for s, f, c in zip(exact, found, cids[found]) for i in ids[f])
                    out += [(cid, i, c, -s) for s, i, c in best[:nearest + 1]]
        return pd.DataFrame(out, columns=["query", "vec_id", "cid", "score"])

    return run


def _met(rows: DataFrame, queries: DataFrame, nearest: int) -> DataFrame:
    """Queries against the rows of their buckets. A bucket larger than a block is dealt over several tasks: rows by
    a hash, with every query of the bucket sent to each; queries likewise."""
    bucket = ["table", "dim", "code"]
    blocks = (rows.groupBy(*bucket).agg(F.ceil(F.count("*") / ROW_BLOCK).cast("int").alias("row_blocks"))
              .join(queries.groupBy(*bucket).agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("query_blocks")),
                    bucket))
    key = [*bucket, "s", "r"]
    own = F.pmod(F.xxhash64("cid"), F.col("row_blocks")).cast("int")
    asked = F.pmod(F.xxhash64("cid"), F.col("query_blocks")).cast("int")
    left = (rows.join(blocks, bucket).withColumn("s", own)
            .withColumn("r", F.explode(F.expr("sequence(0, query_blocks - 1)"))).select(*key, "cid", "ids", "vec"))
    right = (queries.join(blocks, bucket).withColumn("r", asked)
             .withColumn("s", F.explode(F.expr("sequence(0, row_blocks - 1)"))).select(*key, "cid", "vec"))
    right = right.toDF(*right.columns)  # names of its own: both sides come from one table
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(
        _ranker(nearest), "query long, vec_id long, cid long, score double")


def nearest_neighbours(vectors: DataFrame, is_query, nearest: int = NEAREST, tables: int = TABLES,
                       probes: int = PROBES, polytopes: int = POLYTOPES, vec_id: str = "vec_id",
                       embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row that ``is_query`` marks, the ``nearest`` other rows found.

    Scores are cosines in double precision; ties go to the smaller id. Every row is in every table; a query looks
    into ``probes`` buckets of each. Null, zero and empty vectors and those with a null or non-finite component take
    no part, nor do rows without an id. Vectors of different lengths never meet. Rows of equal id and vector are one
    row. A query that finds too few in its buckets is compared with all rows, so it gets fewer only if there are
    no more. Other columns are not read. An empty table gives no rows.

    Equal vectors are one class: it keeps the ``nearest + 1`` smallest ids, of which a query can need no more, and is
    searched for once however many queries share it.
    """
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(embedding, lambda x: x != 0)
    rows = (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("vec"),
                           F.coalesce(is_query, F.lit(False)).alias("asked"))
            .where(F.col("vec_id").isNotNull() & F.coalesce(~bad & some, F.lit(False))))
    least = Window.partitionBy("vec").orderBy("vec_id")
    smallest = (rows.select("vec", "vec_id").withColumn("n", F.dense_rank().over(least))
                .where(F.col("n") <= nearest + 1).groupBy("vec").agg(F.array_sort(F.collect_set("vec_id")).alias("ids")))
    asked = rows.where("asked").groupBy("vec").agg(F.lit(True).alias("asked"))
    classes = materialize(
        smallest.join(asked, "vec", "left").select(
            F.monotonically_increasing_id().alias("cid"), "ids", "vec", F.size("vec").alias("dim"),
            F.coalesce("asked", F.lit(False)).alias("asked")), "classes")
    kind = classes.schema["vec"].dataType.simpleString()
    index = materialize(classes.mapInPandas(
        _hasher(tables, polytopes, probes),
        f"cid long, ids array<long>, vec {kind}, dim int, codes array<long>, probes array<array<long>>"), "index")
    in_tables = index.select("cid", "ids", "vec", "dim", F.posexplode("codes").alias("table", "code"))
    queries = index.where(F.col("probes").isNotNull())
    probed = (queries.select("cid", "vec", "dim", F.posexplode("probes").alias("table", "own"))
              .select("cid", "vec", "dim", "table", F.explode("own").alias("code")))
    found = materialize(_met(in_tables, probed, nearest).distinct(), "found")
    few = materialize(
        queries.select("cid", "vec", "dim")
        .join(found.groupBy(F.col("query").alias("cid")).agg(F.count("*").alias("n")).where(F.col("n") > nearest),
              "cid", "left_anti"), "few")
    if not few.isEmpty():
        everywhere = [F.lit(-1).alias("table"), F.lit(-1).cast("long").alias("code")]
        rest = _met(index.select("cid", "ids", "vec", "dim", *everywhere), few.select("*", *everywhere), nearest)
        found = found.unionByName(rest).distinct()
    order = [F.desc("score"), "vec_id", "cid"]
    best = (found.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy(*order)))
            .where(F.col("n") <= nearest + 1).drop("n"))
    asked_rows = (rows.where("asked").select(F.col("vec_id").alias("query_id"), "vec").distinct()
                  .join(classes.select(F.col("cid").alias("query"), "vec"), "vec").select("query_id", "query"))
    others = asked_rows.join(best, "query").where((F.col("query") != F.col("cid")) | (F.col("query_id") != F.col("vec_id")))
    rank = F.row_number().over(Window.partitionBy("query_id", "query").orderBy(*order))
    return (others.withColumn("rank", rank).where(F.col("rank") <= nearest)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
