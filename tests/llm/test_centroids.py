"""Centroid clustering against Lloyd's rounds in plain integers."""

import hashlib
import math

import numpy as np
import pytest

from staylens.llm import centroids
from staylens.llm.queries import op12_centroid_clustering

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, block long, distance string"


def plain(rows, k=8, rounds=10, size=64):
    """Python integers only."""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centres = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))
    for _ in range(rounds):
        groups = [[] for _ in centres]
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        centres = [[sum(x) // len(g) for x in zip(*g)] if g else c for g, c in zip(groups, centres)]
    out = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = {}
    for _, c, d in out:
        inertia[c] = inertia.get(c, 0) + d
    return [(i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest())
            for i, c, d in out]


def key(r):
    return tuple((x is None, x) for x in r)


def ran(spark, tmp_path, rows, parts=5):
    df = spark.createDataFrame([(i, v, 1, 2, 3, "x") for i, v in rows], SCHEMA)
    df.repartition(parts).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = op12_centroid_clustering(spark, str(tmp_path)).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()
    return sorted((tuple(r) for r in got), key=key)


def vectors(n, seed, spread=0.3, groups=12):
    rng = np.random.default_rng(seed)
    means = rng.normal(size=(groups, 64))
    return (means[rng.integers(0, groups, n)] + spread * rng.normal(size=(n, 64))).astype(np.float32).tolist()


def test_query_equals_plain_rounds(spark, tmp_path):
    got = vectors(300, 1)
    rows = list(enumerate(got)) + [(7, got[7]), (7, got[8]), (None, got[9]), (900, None), (901, got[0][:63]), (902, got[0] + [0.0]),
                                   (903, [None] + got[0][1:]), (904, [float("nan")] + got[0][1:]), (905, [float("inf")] + got[0][1:]), (906, [])]
    rows += [(1000 + i, got[3]) for i in range(150)]  # a hot group of copies
    assert ran(spark, tmp_path, rows) == sorted(plain(rows), key=key)


def test_ties_and_coarse_vectors(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.integers(0, 2, 64) / 1024).tolist()) for i in range(200)]  # components 0 and 1: many ties
    assert ran(spark, tmp_path, rows) == sorted(plain(rows), key=key)


def test_wide_components_stay_exact(spark, tmp_path):
    rows = [(i, [x * 20_000 for x in v]) for i, v in enumerate(vectors(120, 6))]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    assert ran(spark, tmp_path, rows) == sorted(plain(rows), key=key)
    assert centroids.squared_distances(np.array([[1 << 27] * 64]), np.array([[-(1 << 27)] * 64])).tolist() == [[64 << 56]]


@pytest.mark.parametrize("n", [0, 1, 5])
def test_fewer_vectors_than_centroids(spark, tmp_path, n):
    rows = list(enumerate(vectors(n, 2))) + [(99, None)]
    assert ran(spark, tmp_path, rows, 2) == sorted(plain(rows), key=key)


def test_heaps_spare_scans_and_agree_with_lloyd(spark):
    rows = list(enumerate(vectors(3000, 3, 0.15, 8)))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = centroids.cluster(spark, df, block_rows=256)
    want = {r[0]: r[1:3] for r in plain(rows)}
    assert {r["id"]: (r["cluster"], r["distance"]) for r in got.members.collect()} == want
    assert len(got.scanned) == 11 and got.scanned[0] == 3000 and sum(got.scanned[5:]) < 3000
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("centroids_")]


def test_heap_keeps_order_and_offsets():
    h = centroids.Heaps(2)
    h.push([0, 1, 2, 3], np.array([0, 0, 1, 0]), np.array([5.0, 1.0, 2.0, 3.0]), [10.0, 0.0])
    data, sizes = h.data()
    again = centroids.Heaps(2, data, sizes)
    assert again.clusters(4).tolist() == [0, 0, 1, 0]
    places, clusters = again.expired([13.0, 1.9])
    assert places == [1, 3] and clusters == [0, 0]
    assert again.expired([13.0, 2.0]) == ([2], [1])


def test_rounds_shuffle_no_vectors(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(vectors(400, 8))), "vec_id long, embedding array<float>")
    plain_blocks = centroids.blocks_of(df, "vec_id", "embedding", 64, 1024, 64)
    buckets = centroids.Buckets(spark, 4)
    blocks = buckets.save(plain_blocks)
    state = buckets.save(spark.createDataFrame([], centroids._STATE))
    joined = blocks.join(state.select("block", "heap", "sizes").hint("shuffle_hash"), "block")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    buckets.drop()
    assert "ShuffledHashJoin" in plan and "Exchange" not in plan
