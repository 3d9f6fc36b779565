"""Top-k against all products computed plainly."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import vector_search
from tidewell.llm.vector_search import top_k


def plain(rows, k=5):
    good = []
    for i, (key, v) in enumerate(rows):
        if key is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        good.append((i, key, [math.floor(x * 256) for x in v]))
    out = []
    for i, key, q in good:
        if key % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), other) for j, other, v in good if j != i and len(v) == len(q))
            out += [(key, rank, other, -s) for rank, (s, other) in enumerate(scores[:k], 1)]
    return sorted(out)


def found(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit(1)).repartition(3)
    return sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 50 == 0).collect())


def vector(rng, n=64):
    return [rng.randint(-512, 511) / 1024 for _ in range(n)]


@pytest.mark.parametrize("shard, block", [(64, 3), (8192, 2048)])
def test_against_all_products(spark, monkeypatch, shard, block):
    monkeypatch.setattr(vector_search, "SHARD_ROWS", shard)
    monkeypatch.setattr(vector_search, "BLOCK_ROWS", block)
    rng = random.Random(3)
    rows = [(i, vector(rng)) for i in range(400)]
    same = vector(rng)
    rows += [(1000 + i, same) for i in range(200)]  # ties, one of them a query
    assert found(spark, rows) == plain(rows)


@pytest.mark.parametrize("gathered", [1, 50, 1 << 22])
def test_few_pairs_left(monkeypatch, gathered):
    """Vectors in clear groups: bounds leave few pairs, whose products are gathered in parts."""
    monkeypatch.setattr(vector_search, "GATHERED", gathered)
    rng = np.random.default_rng(8)
    centres = rng.integers(-3000, 3000, (60, 64))
    vectors = np.repeat(centres, 20, axis=0) + rng.integers(-3, 4, (1200, 64))
    rows, ids = np.arange(1200), rng.permutation(1200)
    own = np.arange(0, 1200, 50)
    q, found, scores = vector_search.best_of_shard(vectors[own], rows[own], vectors, rows, ids, 5)
    for place, row in enumerate(own):
        products = vectors @ vectors[row]
        best = sorted((-int(products[i]), int(ids[i])) for i in rows if i != row)[:5]
        assert list(zip((-scores[q == place]).tolist(), found[q == place].tolist())) == best


def test_odd_rows(spark):
    rng = random.Random(4)
    rows = [(i, vector(rng, 8)) for i in range(0, 120, 5)]
    rows += [(50, vector(rng, 8)), (100, [1.0] * 8), (100, [1.0] * 8), (150, None), (200, [None] * 8), (250, [math.nan] * 8)]
    rows += [(300, [math.inf] * 8), (None, vector(rng, 8)), (350, []), (400, []), (450, vector(rng, 3)), (500, [1e6] * 8)]
    assert found(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert found(spark, []) == []
