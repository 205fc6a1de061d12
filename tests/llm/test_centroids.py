"""Centroid clustering against distances computed anew in whole Python integers."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerleaf.llm import centroids as C

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows, k, rounds, dims, scale=64):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    near = [(i, v) for i, v in kept if all(abs(x) <= C.FAR for x in v)]
    order = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in near)
    centers = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centers))

    for _ in range(rounds):
        groups = {}
        for _, v in near:
            groups.setdefault(nearest(v)[1], []).append(v)
        centers = [[sum(x) // len(g) for x in zip(*g, strict=True)] if (g := groups.get(j)) else c for j, c in enumerate(centers)]
    out = [(i, *nearest(v)[::-1]) for i, v in near] + [(i, None, None) for i, v in kept if any(abs(x) > C.FAR for x in v)]
    return out, centers


def rows_of(n, dims, seed, spread=3):
    rng = random.Random(seed)
    return [(i, [rng.randrange(-spread, spread) / 64 + rng.random() / 200 for _ in range(dims)]) for i in range(n)]


@pytest.mark.parametrize(("n", "dims", "k", "rounds", "spread"), [(150, 4, 16, 3, 3), (40, 2, 16, 5, 1), (300, 8, 5, 0, 200), (7, 3, 16, 3, 2), (120, 3, 6, 4, 10**7)])
def test_clusters_are_those_of_the_plain_version(spark, n, dims, k, rounds, spread):
    rows = rows_of(n, dims, n, spread)
    rows += [(i, v) for i, v in rows[: n // 3]] * 2 + [(None, rows[0][1]), (None, rows[1][1])]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got, clusters = C.cluster_vectors(docs, k=k, rounds=rounds, dims=dims)
    want, centers = plain(rows, k, rounds, dims)
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.collect())
    assert [c["centroid"] for c in clusters] == centers
    assert [(c["size"], c["inertia"]) for c in clusters] == [(sum(x[1] == j for x in want), sum(x[2] for x in want if x[1] == j)) for j in range(len(centers))]


def test_awkward_vectors(spark):
    bad = [(1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [1.0, math.nan]), (6, [math.inf, 0.0]), (7, [1.0, 2.0, 3.0])]
    far = [(8, [1e300, 0.0]), (9, [-3e6, 0.0])]
    good = [(10, [0.0, 0.0]), (11, [-0.001, 5.0]), (12, [2097152.0, -2097152.0]), (10, [0.0, 0.0])]
    rows = spark.createDataFrame(bad + far + good, SCHEMA).withColumns({c: F.lit(1) for c in ("key", "v", "h", "_h", "vector", "dots", "cluster", "n", "sums")})
    got, clusters = C.cluster_vectors(rows, k=2, dims=2)
    want, centers = plain(bad + far + good, 2, 3, 2)
    assert got.columns == ["vec_id", "cluster", "distance"] and sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.collect())
    assert len(clusters) == 2 and len(centers) == 2
    for few in (bad, far):
        none, clusters = C.cluster_vectors(spark.createDataFrame(few, SCHEMA), dims=2)
        assert clusters == [] and [tuple(r) for r in none.orderBy("vec_id").collect()] == [(i, None, None) for i, _ in few if few is far]


def test_sums_beyond_64_bits(spark):
    rows = [(i, [2097152.0 * (-1) ** i] * 64) for i in range(6)] + [(7, [0.0] * 64)]
    got, clusters = C.cluster_vectors(spark.createDataFrame(rows, SCHEMA).coalesce(1), k=1, rounds=0)
    want, _ = plain(rows, 1, 0, 64)
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.collect())
    assert clusters[0]["inertia"] == sum(d for _, _, d in want)


def test_query_on_tables_without_vectors(spark, tmp_path):
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    out = C.op11_centroids(spark, str(tmp_path))
    assert out.collect() == [] and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
