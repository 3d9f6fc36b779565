"""Clusters against plain loops, and the tree's search against all distances."""

import hashlib
import math
import random

import numpy as np
import pytest

from tidewell.llm import centroid_clusters
from tidewell.llm.centroid_clusters import build_tree, cluster, nearest


def plain(rows, clusters, rounds, dims, scale=256, salt="2:"):
    kept = [
        (k, [math.floor(x * scale) for x in v])
        for k, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    drawn = sorted((hashlib.sha256(f"{salt}{k}".encode()).hexdigest(), v) for k, v in kept if k is not None)
    centroids = [v for _, v in drawn[:clusters]]
    if not centroids:
        return [], []

    def best(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        own = [[] for _ in centroids]
        for _, v in kept:
            own[best(v)[1]].append(v)
        centroids = [[sum(x) // len(vs) for x in zip(*vs)] if vs else c for vs, c in zip(own, centroids)]
    return sorted(((k, best(v)[1], best(v)[0]) for k, v in kept), key=repr), centroids


def check(spark, rows, clusters=9, rounds=3, dims=6):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, v int, cluster int").repartition(3)
    found, centroids = cluster(df, clusters=clusters, rounds=rounds, dims=dims)
    expected, centroids_expected = plain(rows, clusters, rounds, dims)
    assert found.columns == ["vec_id", "cluster", "distance"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected
    assert centroids.tolist() == centroids_expected


def vector(rng, n=6, among=256):
    return [rng.randint(-among, among) / 256 for _ in range(n)]


@pytest.mark.parametrize("block", [5, 4096])
def test_against_plain_loops(spark, monkeypatch, block):
    monkeypatch.setattr(centroid_clusters, "BLOCK_ROWS", block)
    rng = random.Random(1)
    rows = [(i, vector(rng)) for i in range(80)] + [(i, vector(rng, among=1)) for i in range(80, 200)]  # many ties
    check(spark, rows + rows[:30])


def test_odd_rows(spark):
    rng = random.Random(2)
    rows = [(i, vector(rng)) for i in range(12)] + [(None, vector(rng)), (13, None), (14, [None] * 6), (15, [math.nan] * 6)]
    rows += [(16, [math.inf] * 6), (17, []), (18, vector(rng, 5)), (3, vector(rng)), (3, vector(rng)), (19, [9000.0] * 6)]
    check(spark, rows)
    check(spark, rows[:4])
    check(spark, [(None, vector(rng))])


def test_empty_table(spark):
    check(spark, [])


@pytest.mark.parametrize("most, count, dims", [(1, 40, 3), (300, 40, 64), (4, 200, 2), ((1 << 27) - 1, 40, 8), (0, 10, 4), (5, 1, 2)])
def test_search_finds_the_smallest_number(most, count, dims):
    rng = np.random.default_rng(5)
    centroids, vectors = rng.integers(-most, most + 1, (count, dims)), rng.integers(-most, most + 1, (500, dims))
    vectors[:50] = centroids[rng.integers(0, count, 50)]
    found, least, _ = nearest(build_tree(centroids), vectors)
    apart = np.stack([((vectors.astype(object) - c) ** 2).sum(axis=1) for c in centroids], axis=1)
    assert (least == apart.min(axis=1)).all()
    assert (found == [row.tolist().index(low) for row, low in zip(apart, apart.min(axis=1))]).all()


def test_search_leaves_far_centroids_out():
    rng = np.random.default_rng(6)
    centroids = rng.integers(-1000, 1000, (40, 3))
    vectors = np.repeat(centroids, 25, axis=0) + rng.integers(-40, 41, (1000, 3))
    _, _, computed = nearest(build_tree(centroids), vectors)
    assert computed < 0.4 * 40 * 1000
