"""Numbers that stay from build to build."""

import pytest
from pyspark.sql import functions as F

from tidewell.operators.stable_keys import with_stable_numbers
from tidewell.plans import gold
from tidewell.sources.sinks import stored_batches


def numbers(spark, keys, path, **options):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, number int").repartition(3)
    return {r["k"]: r["id"] for r in with_stable_numbers(df, "k", "id", path, **options).collect()}


@pytest.mark.parametrize("options", [{}, {"broadcast_rows": 0, "hot_share": 0.2}])
def test_known_keys_keep_their_numbers(spark, tmp_path, no_auto_broadcast, options):
    path = f"{tmp_path}/keys"
    assert numbers(spark, ["d", "b", None, "f", "b"], path, **options) == {"b": 1, "d": 2, "f": 3, None: None}
    assert numbers(spark, ["e", "d", "a", "f"], path, **options) == {"a": 4, "d": 2, "e": 5, "f": 3}
    assert numbers(spark, ["b", "d"], path, **options) == {"b": 1, "d": 2}
    assert stored_batches(spark, path) == [0, 1]  # nothing new, no batch
    assert numbers(spark, [], path, **options) == {}


def test_no_single_partition(spark, tmp_path, no_auto_broadcast):
    """A first build numbers as before."""
    df = spark.range(1000, numPartitions=4).select(F.format_string("%04d", "id").alias("k"))
    found = with_stable_numbers(df, "k", "n", f"{tmp_path}/keys", broadcast_rows=0)
    assert [r["n"] for r in found.sort("k").collect()] == list(range(1, 1001))
    assert "SinglePartition" not in found._jdf.queryExecution().executedPlan().toString()


def test_keys_must_be_text(spark, tmp_path):
    with pytest.raises(TypeError):
        with_stable_numbers(spark.range(3), "id", "n", f"{tmp_path}/keys")


def test_dimensions_keep_their_numbers(spark, tmp_path):
    def customers(*rows):
        schema = (
            "PERSON_KEY string, FULL_NAME string, EMAIL string, PHONE string, LOCALE string, SRC_SYSTEM string,"
            " SRC_USER_ID string, LAST_SEEN_UTC timestamp_ntz, MATCH_CONFIDENCE decimal(3,2)"
        )
        return spark.createDataFrame([(k, "N", None, None, None, "STORE", k, None, None) for k in rows], schema)

    path = f"{tmp_path}/keys"
    first = gold.dim_person(customers("m", "z"), path)
    assert {r["PERSON_KEY"]: r["PERSON_ID"] for r in first.collect()} == {"m": 1, "z": 2}
    second = gold.dim_person(customers("a", "m", "z"), path)
    assert {r["PERSON_KEY"]: r["PERSON_ID"] for r in second.collect()} == {"m": 1, "z": 2, "a": 3}
    assert first.columns == second.columns == gold.dim_person(customers("a")).columns
