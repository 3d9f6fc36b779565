import pytest
from pyspark.sql import functions as F

from tidewell.operators.numbering import number_rows
from tidewell.plans.gold import with_surrogate


def test_matches_the_window_form(spark):
    rows = spark.range(0, 5000, 1, 7).select(
        (F.col("id") * 7919 % 5003).alias("k"), F.when(F.col("id") % 10 != 0, F.col("id") % 3).alias("g")
    )
    found = number_rows(rows, ["g", "k"], "n").collect()
    want = sorted(((r.g is None, r.g, r.k) for r in found), key=lambda t: (t[0], t[1] or 0, t[2]))
    by_number = sorted(found, key=lambda r: r.n)
    assert [r.n for r in by_number] == list(range(1, 5001))
    assert [(r.g is None, r.g, r.k) for r in by_number] == want


def test_copies_of_one_row_spread_over_partitions(spark):
    rows = spark.range(0, 40000, 1, 16).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        numbered = number_rows(rows, ["k"], "n")
        assert numbered.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first() == (1, 40000, 40000)
        copies = numbered.where("k = 7").agg(F.min("n"), F.max("n"), F.count("*")).first()
        assert copies[1] - copies[0] + 1 == copies[2]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("rows", [[], [("a",)], [("b",), (None,), ("a",)]])
def test_small_inputs_and_null_key(spark, rows):
    df = spark.createDataFrame(rows, "code string")
    found = {r.code: r.id for r in with_surrogate(df, "code", "id").collect()}
    names = sorted(r[0] for r in rows if r[0])
    assert found == {**{n: i for i, n in enumerate(names, 1)}, **({None: None} if (None,) in rows else {})}
