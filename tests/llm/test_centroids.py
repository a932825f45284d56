"""Centroid clustering against plain integer Lloyd rounds; bounds against exact distances."""

import hashlib
import math
import os

import numpy as np
import pytest

from tessera.llm import centroids
from tessera.llm.common import table
from tessera.llm.queries import QUERIES
from tests.llm.helpers import CLASHES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def brute(vectors, size=64, k=8, rounds=10):
    """``vectors`` of (id, components): rows as the query returns them."""
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in vectors
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    c = [v for _, v in first[:k]]

    def assign():
        d = [[sum((a - b) ** 2 for a, b in zip(v, x)) for x in c] for _, v in kept]
        return [(min(range(len(c)), key=lambda j: (r[j], j)), min(r)) for r in d]

    for _ in range(rounds):
        own = assign()
        c = [([sum(v[d] for (_, v), a in zip(kept, own) if a[0] == j) // n for d in range(size)] if (n := sum(a[0] == j for a in own)) else c[j])
             for j in range(len(c))]
    own = assign()
    total, per = sum(d for _, d in own), [sum(d for a, d in own if a == j) for j in range(len(c))]
    sha = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in c]
    return sorted(((i, a, d, per[a], total, sha[a]) for (i, _), (a, d) in zip(kept, own)), key=repr)


def rows_of(df):
    got = df.withColumn("sha", centroids.digest(df["centroid"])).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "sha")
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_query_equals_brute_force(spark):
    vectors = [(r["vec_id"], r["embedding"]) for r in table(spark, SF, "embeddings").collect()]
    got = QUERIES["op12_centroids"](spark, SF).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(vectors)


def test_intervals_hold_the_distances_and_spare_vectors():
    r = np.random.default_rng(4)
    middle = r.integers(-900, 900, (8, 64))
    v = middle[r.integers(0, 8, 5000)] + r.integers(-120, 120, (5000, 64))
    limits = centroids.cell_limits(v[:centroids.SAMPLE])
    cells = centroids.cells_of(v, limits)
    tables = centroids.interval_tables(middle, limits, v.min(axis=0), v.max(axis=0))
    low, high = centroids.bounds(cells, tables)
    exact = ((v[:, None, :] - middle[None]) ** 2).sum(axis=2)
    assert (low <= exact).all() and (exact <= high).all()
    best, fetched = centroids.nearest(cells, tables, middle, lambda rows: v[rows])
    assert (best == exact.argmin(axis=1)).all()
    assert fetched < 0.2 * len(v)


def test_edge_vectors(spark):
    r = np.random.default_rng(5)
    good = [[float(x) for x in r.normal(0, 0.2, 4)] for _ in range(40)]
    rows = [(i, v) for i, v in enumerate(good)] + [(7, good[7]), (7, good[8]), (None, good[3]), (50, None), (51, []), (52, [1.0] * 3), (53, [1.0] * 5),
            (54, [1.0, None, 1.0, 1.0]), (55, [1.0, float("nan"), 1.0, 1.0]), (56, [1.0, float("-inf"), 1.0, 1.0]), (57, [0.0] * 4), (58, [-0.0] * 4)]
    extra = ", ".join(f"`{c}` string" for c in (*CLASHES, "cluster", "cells", "full", "distance"))
    df = spark.createDataFrame([(*x, *["clash"] * (len(CLASHES) + 4)) for x in rows], f"vec_id long, embedding array<double>, {extra}")
    assert rows_of(centroids.cluster(df, size=4)) == brute(rows, 4)
    assert rows_of(centroids.cluster(df, size=4, centroids=3, rounds=2)) == brute(rows, 4, 3, 2)
    assert rows_of(centroids.cluster(df, size=3)) == brute(rows, 3)  # one vector, one centroid
    assert centroids.cluster(df, size=9).collect() == [] and centroids.cluster(df.limit(0), size=4).collect() == []


def test_ties_and_empty_clusters(spark):
    rows = [(i, [0.0, 0.0]) for i in range(30)] + [(30 + i, [1.0, 0.0]) for i in range(3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert rows_of(centroids.cluster(df, size=2)) == brute(rows, 2)


def test_few_vectors_are_fetched_in_late_rounds(spark):
    r = np.random.default_rng(6)
    middle = r.normal(0, 1, (8, 16))
    rows = [(i, [float(x) for x in middle[i % 8] + r.normal(0, 0.15, 16)]) for i in range(2000)]
    report = []
    found = centroids.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), size=16, report=report)
    assert rows_of(found) == brute(rows, 16)
    assert report[0] >= 2000 and len(report) > 1


def test_too_large_components_are_refused(spark):
    df = spark.createDataFrame([(1, [1e300, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError):
        centroids.cluster(df, size=2)
