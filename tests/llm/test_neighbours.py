import numpy as np
import pytest
from pyspark.sql import functions as F

from retailloom.llm import neighbours
from retailloom.llm.common import table
from retailloom.llm.queries import op1_neighbours

VECTORS = "vec_id long, embedding array<float>, label int, dim string, code string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, "own", "own") for i, v in rows], VECTORS).repartition(3)


def brute(rows, every, k=5):
    """Cosines of all pairs; ties to the smaller id."""
    good = {(i, tuple(np.float32(v).tolist())) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for i, v in good:
        if i % every == 0:
            found = []
            for j, w in good:
                if (i, v) != (j, w) and len(v) == len(w):
                    a, b = np.array(v, float), np.array(w, float)
                    found.append((-(a @ b) / np.sqrt(a @ a) / np.sqrt(b @ b), j))
            out[i] = sorted((round(s, 9), j) for s, j in found)[:k]
    return out


def searched(df, every, **more):
    out = {}
    rows = neighbours.nearest_neighbours(df, F.col("vec_id") % every == 0, **more).collect()
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((round(-r["score"], 9), r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("polytopes,probes", [(1, 16), (2, 256)])
def test_all_buckets_probed_equal_brute_force(spark, polytopes, probes):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(40)] + [(300 + i, (2 * np.float32(rows[4][1])).tolist()) for i in range(3)]
    assert searched(vectors_of(spark, rows), 5, polytopes=polytopes, probes=probes) == brute(rows, 5)


def test_odd_vectors_repeats_and_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0, 0.0]), (1, [1.0, 0.1, 0.0]), (2, None), (3, []), (4, [0.0, 0.0, 0.0]), (5, [1.0, None, 0.0]),
            (6, [nan, 1.0, 0.0]), (7, [inf, 1.0, 0.0]), (None, [1.0, 0.0, 0.0]), (8, [1e-30, 2e-30, 0.0]),
            (9, [1e30, -1e30, 0.0]), (10, [1.0, 2.0]), (0, [1.0, 0.0, 0.0]), (20, [3.0, 1.0])]
    assert searched(vectors_of(spark, rows), 10) == brute(rows, 10)
    assert searched(vectors_of(spark, []), 10) == {}
    assert searched(vectors_of(spark, [(10, [1.0])]), 10) == {}


def test_a_hot_vector_is_searched_for_once(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(1000)] + [(1000 + i, rng.normal(size=4).tolist()) for i in range(50)]
    found = searched(vectors_of(spark, rows), 50, probes=8)
    assert [j for _, j in found[0]] == [1, 2, 3, 4, 5] and [j for _, j in found[50]] == [0, 1, 2, 3, 4]


def test_blocks_of_a_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "ROW_BLOCK", 10)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=4) * 0.05 + 1).tolist()) for i in range(200)]
    assert searched(vectors_of(spark, rows), 4, probes=8) == brute(rows, 4)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall_of_the_query(spark, folder):
    rows = table(spark, folder, "embeddings").toPandas()
    x = neighbours.unit(np.stack(rows["embedding"]).astype(float))
    ids = rows["vec_id"].to_numpy()
    at = np.nonzero(ids % 50 == 0)[0]
    scores = x[at] @ x.T
    scores[np.arange(len(at)), at] = -2
    best = {ids[q]: set(ids[np.argsort(-s)[:5]]) for q, s in zip(at, scores)}
    found = op1_neighbours(spark, folder).toPandas()
    hits = [len(best[q] & set(own["vec_id"])) / 5 for q, own in found.groupby("query_id")]
    assert len(hits) == len(at) and np.mean(hits) >= 0.9
    assert (found.groupby("query_id")["rank"].max() == 5).all()
