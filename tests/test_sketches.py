"""Stored sketches within their bound, and buckets without an exchange."""

from pyspark.sql import functions as F

from tidewell.operators.sketches import add_sketches, distinct_estimates, error_bound
from tidewell.sources.bucketed import bucketed_refresh


def test_sketches_unite(spark, tmp_path):
    path = str(tmp_path)
    rows = spark.range(60_000).select(
        (F.col("id") % 20_000).cast("string").alias("person"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 6).cast("int")).alias("day"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("c"), (F.col("id") % 3).cast("string"))).alias("channel"),
    )
    for batch in range(3):
        load = rows.where(F.day("day") % 3 == batch)
        add_sketches(load, path, batch, F.col("day"), F.col("channel"), F.col("person"))
        add_sketches(load, path, batch, F.col("day"), F.col("channel"), F.col("person"))  # once more changes nothing
    exact = {(r.channel,): r.n for r in rows.groupBy("channel").agg(F.count_distinct("person").alias("n")).collect()}
    found = {tuple(r[:-1]): r.estimate for r in distinct_estimates(spark, path, ("CHANNEL",)).collect()}
    assert found.keys() == exact.keys() and all(abs(found[k] - n) <= error_bound() * n for k, n in exact.items())
    whole = distinct_estimates(spark, path).first().estimate
    assert abs(whole - 20_000) <= error_bound() * 20_000
    first = distinct_estimates(spark, path, where=F.col("DAY") == F.lit("2024-01-01").cast("date")).first().estimate
    assert abs(first - 10_000) <= error_bound() * 10_000
    assert spark.read.parquet(path).count() == len({(i % 6, i % 3) for i in range(6)})
    assert error_bound() < 0.03


def test_no_sketches(spark, tmp_path):
    assert distinct_estimates(spark, str(tmp_path), ("CHANNEL",)).isEmpty()
    assert distinct_estimates(spark, str(tmp_path)).first().estimate == 0


def test_bucketed_tables_join_without_exchange(spark, no_auto_broadcast):
    fact = spark.range(2000).select((F.col("id") % 97).cast("string").alias("k"), "id")
    table = spark.range(97).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("twice"))
    left, right = bucketed_refresh(fact, "bucketed_fact", "k", 6), bucketed_refresh(table, "bucketed_dim", "k", 6)
    try:
        joined = left.join(right, "k", "left")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert sorted(map(tuple, joined.collect())) == sorted((str(i % 97), i, 2 * (i % 97)) for i in range(2000))
        again = bucketed_refresh(fact.limit(5), "bucketed_fact", "k", 6)
        assert again.count() == 5
    finally:
        spark.sql("DROP TABLE bucketed_fact")
        spark.sql("DROP TABLE bucketed_dim")
