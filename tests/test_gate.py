"""Writes that refuse or hold back bad rows."""

import os

import pytest
from pyspark.sql import functions as F

from tidewell.sources.gate import Gate, QualityError, gated_refresh
from tidewell.sources.sinks import full_refresh

SCHEMA = "k string, n int, part int"
GOOD = [("a", 1, 0), ("b", 2, 1), ("c", None, 0)]


@pytest.fixture
def gate(spark):
    def make(**allowed):
        return Gate({"negative": F.col("n") < 0, "large": F.col("n") > 9}, ("k",), {k.replace("_", " "): v for k, v in allowed.items()})

    return make


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def write(spark, folder, data, gate, **kw):
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    return gated_refresh(df, f"{folder}/t", gate, f"{folder}/q", **kw)


def held(spark, folder):
    found = spark.read.parquet(f"{folder}/q")
    return rows(found.withColumn("broken_rules", F.array_sort("broken_rules")))


@pytest.mark.parametrize("partition_by", [(), ("part",)])
def test_sound_rows_are_swapped_in_as_written(spark, tmp_path, gate, partition_by):
    kept = write(spark, tmp_path, GOOD, gate(), partition_by=partition_by)
    assert rows(kept.select("k", "n", "part")) == sorted(GOOD, key=repr) and held(spark, tmp_path) == []
    assert sorted(os.listdir(tmp_path)) == ["q", "t"]
    stored = spark.read.parquet(f"{tmp_path}/t")
    assert sorted(stored.columns) == ["k", "n", "part"]
    again = write(spark, tmp_path, GOOD[:1], gate(), partition_by=partition_by)
    assert again.count() == 1


def test_a_table_beyond_its_limits_leaves_the_old_one(spark, tmp_path, gate):
    full_refresh(spark.createDataFrame(GOOD, SCHEMA), f"{tmp_path}/t")
    bad = [*GOOD, ("b", -1, 0), ("d", 10, 0), (None, -5, 0), (None, 3, 0)]
    with pytest.raises(QualityError, match="'negative' \\(1 too many\\)") as refused:
        write(spark, tmp_path, bad, gate(negative=1, large=1, k_filled=2, k_unique=2))
    assert refused.value.found == {"negative": 2, "large": 1, "k filled": 2, "k unique": 2}
    assert rows(spark.read.parquet(f"{tmp_path}/t")) == sorted(GOOD, key=repr)
    assert held(spark, tmp_path) == sorted(
        [("b", 2, 1, ["k unique"]), ("b", -1, 0, ["k unique", "negative"]), ("d", 10, 0, ["large"]),
         (None, -5, 0, ["k filled", "negative"]), (None, 3, 0, ["k filled"])],
        key=repr,
    )
    assert sorted(os.listdir(tmp_path)) == ["q", "t"]


@pytest.mark.parametrize("options", [{}, {"broadcast_rows": 0, "hot_share": 0.1}])
def test_within_its_limits_only_sound_rows_are_stored(spark, tmp_path, gate, no_auto_broadcast, options):
    many = [("hot", i, 0) for i in range(50)]
    kept = write(spark, tmp_path, [*GOOD, *many], gate(k_unique=50, large=40), **options)
    assert rows(kept) == sorted(GOOD, key=repr)
    assert len(held(spark, tmp_path)) == 50


def test_nothing_sound_and_nothing_at_all(spark, tmp_path, gate):
    assert rows(write(spark, tmp_path, [("a", -1, 0)], gate(negative=1))) == []
    assert rows(write(spark, tmp_path, [], gate(), partition_by=("part",))) == []
    assert spark.read.schema(SCHEMA).parquet(f"{tmp_path}/t").count() == 0


def test_no_rules(spark, tmp_path):
    assert rows(write(spark, tmp_path, GOOD, Gate())) == sorted(GOOD, key=repr)


def test_a_failed_write_leaves_the_old_table(spark, tmp_path, gate):
    write(spark, tmp_path, GOOD, gate())
    df = spark.createDataFrame(GOOD, SCHEMA).withColumn("n", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        gated_refresh(df, f"{tmp_path}/t", gate(), f"{tmp_path}/q")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 3 and sorted(os.listdir(tmp_path)) == ["q", "t"]
