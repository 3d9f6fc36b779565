import random

import pytest
from pyspark.sql import functions as F

from tidewell.operators.identity import connected_components, one_pass_key, transitive_keys


def union_find(pairs):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {x: root(x) for x in parent}


def random_pairs(seed, nodes, count):
    rng = random.Random(seed)
    return [(f"n{rng.randrange(nodes):04d}", f"n{rng.randrange(nodes):04d}") for _ in range(count)]


CASES = {
    "empty": [],
    "chain": [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)],
    "hub_large": [("zz", f"n{i:03d}") for i in range(300)] + [("n007", "m")],
    "hub_small": [("aa", f"n{i:03d}") for i in range(300)] + [("n250", "zz"), ("zz", "zzz")],
    "sparse": random_pairs(1, 300, 200),
    "dense": random_pairs(2, 60, 300),
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("broadcast_rows", [500_000, 0])
def test_components_against_union_find(spark, no_auto_broadcast, case, broadcast_rows):
    if broadcast_rows == 0 and case not in ("hub_large", "hub_small", "sparse"):
        pytest.skip("the shuffled path is covered by the hubs")
    pairs = CASES[case]
    edges = spark.createDataFrame(pairs, "a string, b string")
    found = {r.node: r.root for r in connected_components(edges, broadcast_rows=broadcast_rows).collect()}
    want = union_find([(a, b) for a, b in pairs if a != b])
    assert found == want


def test_records_chain_across_email_and_phone(spark):
    rows = [
        ("S", "1", "a@x", "1"),
        ("W", "1", "a@x", "2"),
        ("W", "2", "b@x", "2"),
        ("W", "3", None, "1"),
        ("S", "4", "c@x", None),
        ("S", "5", None, None),
        ("W", "5", None, None),
    ]
    records = spark.createDataFrame(rows, "SRC_SYSTEM string, SRC_USER_ID string, EMAIL string, PHONE string")
    chained = {(r.SRC_SYSTEM, r.SRC_USER_ID): r.PERSON_KEY for r in transitive_keys(records).collect()}
    key = one_pass_key(F.col("EMAIL"), F.col("PHONE"), F.col("SRC_SYSTEM"), F.col("SRC_USER_ID"))
    single = {(r[0], r[1]): r.k for r in records.select("SRC_SYSTEM", "SRC_USER_ID", key.alias("k")).collect()}
    people = [chained[k] for k in (("S", "1"), ("W", "1"), ("W", "2"), ("W", "3"))]
    assert len(set(people)) == 1
    assert len(set(chained.values())) == 4
    assert single[("S", "1")] == single[("W", "1")] != single[("W", "2")]
    # no chain, no difference
    for k in (("S", "4"), ("S", "5"), ("W", "5")):
        assert chained[k] == single[k]


def test_identity_is_repeatable(spark):
    rng = random.Random(5)
    rows = [("S", str(i), f"e{rng.randrange(80)}", f"p{rng.randrange(80)}") for i in range(150)]
    schema = "SRC_SYSTEM string, SRC_USER_ID string, EMAIL string, PHONE string"
    first = transitive_keys(spark.createDataFrame(rows, schema)).collect()
    rng.shuffle(rows)
    again = transitive_keys(spark.createDataFrame(rows, schema).repartition(5)).collect()
    assert {(r.SRC_USER_ID, r.PERSON_KEY) for r in first} == {(r.SRC_USER_ID, r.PERSON_KEY) for r in again}
