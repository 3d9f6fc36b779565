"""Vector codes against plain loops over rows, entries and components."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import vector_codes
from tidewell.llm.vector_codes import compress, dictionary_coded, nearest_entries


def plain(rows, parts, entries, rounds, scale):
    kept = [(k, [math.floor(x * scale) for x in v]) for k, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(first[0][1]) if first else 0
    if not width or width % parts:
        return [], [[] for _ in range(parts)]
    first = [v for _, v in first if len(v) == width][:entries]
    kept = [(k, v) for k, v in kept if len(v) == width]
    n = width // parts
    books = [[v[p * n :][:n] for v in first] for p in range(parts)]

    def apart(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def chosen(v):
        return [min((apart(v[p * n :][:n], e), i) for i, e in enumerate(books[p])) for p in range(parts)]

    for _ in range(rounds):
        found = [(v, chosen(v)) for _, v in kept]
        new = []
        for p in range(parts):
            own = [[v[p * n :][:n] for v, c in found if c[p][1] == i] for i in range(len(books[p]))]
            new.append([[sum(x) // len(vs) for x in zip(*vs)] if vs else old for vs, old in zip(own, books[p])])
        books = new
    out = [(k, [i for _, i in chosen(v)], sum(d for d, _ in chosen(v))) for k, v in kept]
    return sorted(out, key=repr), books


def check(spark, rows, parts=4, entries=8, rounds=3, scale=1024):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, v int, codes int").repartition(3)
    found, books = compress(df, parts=parts, entries=entries, rounds=rounds, scale=scale)
    expected, entries_expected = plain(rows, parts, entries, rounds, scale)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected
    assert [b.tolist() for b in books] == entries_expected


def vector(rng, n=8, among=1024):
    return [rng.randint(-among, among) / 1024 for _ in range(n)]


@pytest.mark.parametrize("block, gather", [(7, 3), (4096, 512)])
def test_against_plain_loops(spark, monkeypatch, block, gather):
    monkeypatch.setattr(vector_codes, "BLOCK_ROWS", block)
    monkeypatch.setattr(vector_codes, "GATHER_ROWS", gather)
    rng = random.Random(1)
    rows = [(i, vector(rng)) for i in range(60)] + [(i, vector(rng, among=2)) for i in range(60, 120)]  # many ties
    check(spark, rows + rows[:20])


def test_odd_rows(spark):
    rng = random.Random(2)
    rows = [(i, vector(rng)) for i in range(5)] + [(None, vector(rng)), (7, None), (8, [None] * 8), (9, [math.nan] * 8)]
    rows += [(10, [math.inf] + [0.0] * 7), (11, []), (12, vector(rng, 4)), (13, [20000.0, -20000.0] * 4), (3, vector(rng)), (3, vector(rng))]
    check(spark, rows)
    check(spark, [(-1, vector(rng, 6)), *rows])  # its length has no four equal parts
    check(spark, rows[:1])


def test_empty_table(spark):
    check(spark, [])
    check(spark, [(1, None)])


def test_numbers_without_distances_fail(spark):
    df = spark.createDataFrame([(1, [1e30, 0.0, 0.0, 0.0])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="is not below"):
        compress(df)


def test_dictionaries_give_exact_distances():
    rng = np.random.default_rng(3)
    for most in (3, 1000, (1 << 27) - 1):
        vectors, book = rng.integers(-most, most + 1, (700, 5)), rng.integers(-most, most + 1, (20, 5))
        values, places = dictionary_coded(vectors)
        assert (np.stack([v[p] for v, p in zip(values, places)], axis=1) == vectors).all()
        found, least = nearest_entries(values, places, book)
        apart = ((vectors[:, None, :].astype(object) - book[None, :, :]) ** 2).sum(axis=2)
        assert (found == apart.argmin(axis=1)).all() and (least == apart.min(axis=1)).all()


def test_other_columns_are_kept_in_place(spark):
    rng = random.Random(4)
    rows = [(i, vector(rng), i % 3 or None) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found, _ = compress(df, entries=4, keep=("label",))
    assert sorted((r["vec_id"], r["label"]) for r in found.collect()) == [(i, i % 3 or None) for i in range(30)]
