"""The shuffled path of lookup must give what the broadcast path gives."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewell.operators.lookup import lookup


@pytest.fixture(scope="module")
def fact(spark):
    # a third of the rows has one key, a third has none, the rest is spread; some keys are unknown
    return spark.range(0, 3000, 1, 6).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None).otherwise(
            F.concat(F.lit("k"), (F.col("id") % 97).cast("string"))
        ).alias("key"),
    )


@pytest.fixture(scope="module")
def table(spark):
    keys = spark.range(80).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("code"), "id")
    more = spark.createDataFrame([("hot", 1000), (None, 1001)], "code string, id long")
    return keys.union(more).select("code", (F.col("id") * 10).alias("worth"))


def expected(fact, table, inner):
    worth = {r.code: r.worth for r in table.collect() if r.code is not None}
    rows = [(r.id, r.key, worth.get(r.key)) for r in fact.collect()]
    return Counter(r for r in rows if not inner or r[1] in worth)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("options", [{}, {"broadcast_rows": 0}, {"broadcast_bytes": 10}, {"broadcast_rows": 0, "hot_share": 2.0}])
def test_all_paths_agree(spark, no_auto_broadcast, fact, table, how, options):
    found = lookup(fact, table, {"code": F.col("key")}, {"worth": "worth"}, how=how, **options)
    assert found.columns == ["id", "key", "worth"]
    assert Counter(tuple(r) for r in found.collect()) == expected(fact, table, how == "inner")


def test_taken_column_may_replace_one_of_the_fact(spark, no_auto_broadcast, fact, table):
    for options in ({}, {"broadcast_rows": 0}):
        found = lookup(fact, table, {"code": F.col("key")}, {"key": "code"}, **options)
        known = {r.code for r in table.collect()}
        want = Counter((r.id, r.key if r.key in known else None) for r in fact.collect())
        assert Counter((r.id, r.key) for r in found.collect()) == want


def test_unknown_hot_key_stays_null(spark, no_auto_broadcast, fact, table):
    rest = table.where("code <> 'hot'")
    found = lookup(fact, rest, {"code": F.col("key")}, {"worth": "worth"}, broadcast_rows=0)
    assert found.where("key = 'hot' AND worth IS NULL").count() == 1000
    assert found.count() == 3000


def test_two_column_key(spark, no_auto_broadcast):
    fact = spark.range(100).selectExpr("id", "id % 2 AS a", "id % 5 AS b")
    table = spark.range(10).selectExpr("id % 2 AS x", "id % 5 AS y", "id AS v").where("v <> 3")
    for options in ({}, {"broadcast_rows": 0, "hot_share": 0.15}):
        found = lookup(fact, table, {"x": F.col("a"), "y": F.col("b")}, {"v": "v"}, **options)
        wrong = [r for r in found.collect() if r.v != (None if r.id % 10 == 3 else r.id % 10)]
        assert found.count() == 100 and wrong == []


def test_hot_and_missing_keys_do_not_share_a_task(spark, no_auto_broadcast, fact, table):
    """No partition of the shuffled join holds much more than its share."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = lookup(fact, table, {"code": F.col("key")}, {"worth": "worth"}, broadcast_rows=0)
        sizes = [r[1] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 3000 and max(sizes) < 1.25 * 3000 / 4
