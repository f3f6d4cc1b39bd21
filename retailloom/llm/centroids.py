"""Centroid clustering of integer vectors by exact rounds, with the equal-average equal-variance nearest search.

A vector x of k components has the sum S and the deviation V, the length of x less its mean. For a centroid c the
squared distance is at least (S_x - S_c)^2 / k, and at least that plus (V_x - V_c)^2. Centroids lie in the order of
their sums; a vector's search starts at its own sum and goes outward, always to the nearer side. Once the first bound
exceeds the best distance so far, all that is left lies further out and the search ends; the second bound skips single
centroids; what passes both gets its exact distance in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailloom.session import materialize

CENTROIDS, ROUNDS, SCALE, DIMENSION = 16, 3, 64, 64
# Components are held to this: with 64 of them a squared distance then still fits into 64 bits.
LARGEST = 1 << 27
# Deviations are square roots in floating point: the second bound leaves them this much room.
ROOM = 1e-9
BATCH = 4096


def whole_components(embedding: str, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, x as double."""
    def whole(x: Column) -> Column:
        bounded = F.least(F.greatest(x.cast("double") * scale, F.lit(-float(LARGEST))), F.lit(float(LARGEST)))
        return F.floor(bounded).cast("int")

    return F.transform(embedding, whole)


def deviations(vectors: np.ndarray) -> np.ndarray:
    centred = vectors - vectors.mean(axis=1, keepdims=True)
    return np.sqrt((centred * centred).sum(axis=1))


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each vector's nearest centroid, the smallest on ties, and the squared distance; whole numbers.

    All vectors take their next step together; those whose search has ended drop out.
    """
    n, k = vectors.shape
    sums = centroids.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    sums, spread, ordered = sums[order], deviations(centroids)[order], centroids[order]
    own_sum, own_spread = vectors.sum(axis=1), deviations(vectors)
    best, cluster = np.full(n, np.iinfo(np.int64).max), np.full(n, len(order))
    up = np.searchsorted(sums, own_sum)
    down = up - 1
    left = np.arange(n)
    last = len(order) - 1
    while len(left):
        s, low, high = own_sum[left], down[left], up[left]
        below = np.where(low >= 0, s - sums[np.maximum(low, 0)], np.iinfo(np.int64).max)
        above = np.where(high <= last, sums[np.minimum(high, last)] - s, np.iinfo(np.int64).max)
        go_down = below <= above
        gap = np.minimum(below, above)
        # Exact: gap^2 > k * best, in floats only as far as they can tell, else in whole numbers.
        open_ = (gap < np.iinfo(np.int64).max) & (gap.astype(np.float64) ** 2 <= k * best[left].astype(np.float64) * (1 + ROOM))
        left, go_down, gap = left[open_], go_down[open_], gap[open_].astype(np.float64)
        at = np.where(go_down, down[left], up[left])
        down[left[go_down]] -= 1
        up[left[~go_down]] += 1
        apart = np.abs(own_spread[left] - spread[at])
        apart = np.maximum(apart - ROOM * (own_spread[left] + spread[at]), 0)
        near = gap * gap / k * (1 - ROOM) + apart * apart <= best[left].astype(np.float64) * (1 + ROOM)
        rows, at = left[near], at[near]
        difference = vectors[rows] - ordered[at]
        distance = np.einsum("ij,ij->i", difference, difference)
        number = order[at]
        closer = (distance < best[rows]) | ((distance == best[rows]) & (number < cluster[rows]))
        best[rows[closer]], cluster[rows[closer]] = distance[closer], number[closer]
    return cluster, best


def _batches(batch: pa.RecordBatch, dimension: int) -> Iterator[tuple[int, np.ndarray]]:
    values = batch.column("whole").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dimension)
    for at in range(0, len(values), BATCH):
        yield at, values[at:at + BATCH]


def _summed(centroids: np.ndarray):
    """One row per centroid and task: its number, how many vectors are nearest to it, and their sums."""
    dimension = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(centroids), dtype=np.int64)
        sums = np.zeros(centroids.shape, dtype=np.int64)
        for batch in batches:
            for _, vectors in _batches(batch, dimension):
                cluster, _ = nearest(vectors, centroids)
                counts += np.bincount(cluster, minlength=len(centroids))
                np.add.at(sums, cluster, vectors)
        some = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_pydict({
            "cluster": pa.array(some, pa.int32()), "n": pa.array(counts[some]),
            "sums": pa.array(list(sums[some]), pa.list_(pa.int64()))})

    return run


def _assigned(centroids: np.ndarray):
    dimension = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, vectors in _batches(batch, dimension):
                cluster, distance = nearest(vectors, centroids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").slice(at, len(vectors)), pa.array(cluster, pa.int32()), pa.array(distance)],
                    names=["vec_id", "cluster", "distance"])

    return run


def first_centroids(vectors: DataFrame, count: int) -> np.ndarray:
    """The ``count`` vectors of smallest sha256 of ``1:<vec_id>``; rows without an id come last, ties by components."""
    key = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(key.asc_nulls_last(), "whole").limit(count).select("whole").collect()
    return np.array([r["whole"] for r in rows], dtype=np.int64)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: floor(sum / count) of their vectors, in whole numbers; empty ones stay.

    A task returns a row per centroid and the tasks' rows are summed on Spark, so the driver gets one row per
    centroid and component (16 x 64) whatever the table's size.
    """
    parts = vectors.select("whole").mapInArrow(_summed(centroids), "cluster int, n long, sums array<long>")
    totals = (parts.select("cluster", "n", F.posexplode("sums").alias("place", "part"))
              .groupBy("cluster", "place").agg(F.sum(F.col("part").cast("decimal(20,0)")).alias("total"),
                                               F.sum("n").alias("n")))
    after = centroids.copy()
    for row in totals.collect():
        after[row["cluster"], row["place"]] = int(row["total"]) // row["n"]
    return after


def cluster_vectors(vectors: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS, dimension: int = DIMENSION,
                    vec_id: str = "vec_id", embedding: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance per vector; the final centroids).

    Vectors of another length, null ones and those with a null or non-finite component take no part. Components
    become floor(64 * x) and are held to 2^27 either way. Rows without an id are clustered like all others but start
    no centroid while there are enough others; repeated rows count as often as they occur, and equal starting
    vectors give equal centroids, of which the later stays empty. With fewer vectors than ``count`` there are fewer
    centroids; an empty table gives no rows. Other columns are not read.

    Only centroids travel with the tasks and to the driver (``count`` x ``dimension`` whole numbers).
    """
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = vectors.where(F.coalesce((F.size(embedding) == dimension) & ~bad, F.lit(False)))
    kept = materialize(kept.select(F.col(vec_id).cast("long").alias("vec_id"),
                                   whole_components(embedding).alias("whole")), "whole-vectors")
    centroids = first_centroids(kept, count)
    if not len(centroids):
        return kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    for _ in range(rounds):
        centroids = moved(kept, centroids)
    return kept.mapInArrow(_assigned(centroids), "vec_id long, cluster int, distance long"), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Each row with the sum of the distances of its cluster and of all, and its centroid's sha256.

    One row per centroid is joined, so Spark broadcasts it by its known size; sums beyond 64 bits are null.
    """
    spark = assigned.sparkSession
    assigned = materialize(assigned, "assigned")
    wide = F.sum(F.col("distance").cast("decimal(20,0)"))
    sums = {r["cluster"]: int(r["total"]) for r in assigned.groupBy("cluster").agg(wide.alias("total")).collect()}

    def long(value: int) -> int | None:
        return value if value < 1 << 63 else None

    rows = [(number, long(sums[number]), long(sum(sums.values())), ",".join(map(str, centroid)))
            for number, centroid in enumerate(centroids.tolist()) if number in sums]
    known = spark.createDataFrame(rows, "number int, cluster_inertia long, inertia long, components string")
    return assigned.join(known, assigned["cluster"] == known["number"]).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia",
        F.sha2("components", 256).alias("centroid_sha256"))
