from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewell.functions import scalars


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize(
    ("text", "expected"),
    [("337.81", 338), ("0.5", 1), ("-0.5", -1), ("2.4999", 2), (None, None)],
)
def test_number_rounds_halves_away_from_zero(spark, text, expected):
    assert value(spark, scalars.number(F.lit(text).cast("decimal(18,4)"))) == expected


def test_number_keeps_scale(spark):
    assert value(spark, scalars.number(F.lit("1.005").cast("decimal(18,4)"), 10, 2)) == Decimal("1.01")


@pytest.mark.parametrize(
    ("start", "end", "expected"),
    [
        ("2024-01-01 00:00:00.9", "2024-01-01 00:00:02.1", 2),
        ("2024-01-01 00:00:00.1", "2024-01-01 00:00:00.9", 0),
        ("2024-01-01 00:00:01.1", "2024-01-01 00:00:00.9", -1),
    ],
)
def test_seconds_count_boundaries(spark, start, end, expected):
    assert value(spark, scalars.seconds_between(ts(start), ts(end))) == expected


def test_days_count_midnights(spark):
    assert value(spark, scalars.days_between(ts("2024-01-01 23:59:59"), ts("2024-01-02 00:00:01"))) == 1
    assert value(spark, scalars.days_between(ts("2024-01-01 00:00:01"), ts("2024-01-01 23:59:59"))) == 0


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("HK 003", "Hk 003"),
        ("a_b-cD e.f", "A_B-Cd E.F"),
        ("new\tyork", "New\tYork"),
        ("x[y](z)", "X[Y](Z)"),
        ("o\\n|p", "O\\N|P"),
        ("", ""),
        (None, None),
    ],
)
def test_initcap_breaks_at_punctuation(spark, text, expected):
    assert value(spark, scalars.initcap(F.lit(text).cast("string"))) == expected


def test_zero_pad_never_cuts(spark):
    assert value(spark, scalars.zero_pad(F.lit(7), 6)) == "000007"
    assert value(spark, scalars.zero_pad(F.lit(1234567), 6)) == "1234567"


def test_greatest_is_null_if_any_is(spark):
    assert value(spark, scalars.greatest_or_null(F.lit(1), F.lit(3))) == 3
    assert value(spark, scalars.greatest_or_null(F.lit(1), F.lit(None).cast("int"))) is None


def test_ratio(spark):
    assert value(spark, scalars.ratio(F.lit(201), F.lit(200))) == Decimal("1.01")
    assert value(spark, scalars.ratio(F.lit(1), F.lit(0))) is None
    assert value(spark, scalars.ratio(F.lit(-100), F.lit(3))) == Decimal("-33.33")


def test_calendar_parts(spark):
    monday = ts("2025-10-13 22:15:16.789")
    assert value(spark, scalars.iso_weekday(monday)) == 1
    assert value(spark, scalars.iso_weekday(ts("2025-10-19 00:00:00"))) == 7
    assert value(spark, scalars.weekday_label(monday)) == "Mon"
    assert value(spark, scalars.start_of_day(monday)) == datetime(2025, 10, 13)
    assert value(spark, scalars.timestamp_text(monday)) == "2025-10-13 22:15:16"
    assert value(spark, scalars.day(datetime(2025, 10, 13, 9))) == date(2025, 10, 13)


def test_blank_to_null(spark):
    assert value(spark, scalars.blank_to_null(F.lit("   "))) is None
    assert value(spark, scalars.blank_to_null(F.lit(" x "))) == "x"


def test_sort_keys_put_missing_times_last(spark):
    rows = spark.createDataFrame(
        [("a", "2024-01-02"), ("b", None), ("c", "2024-01-01"), ("d", "2024-01-02")], "id string, t string"
    ).withColumn("t", F.col("t").cast("timestamp_ntz"))
    t, i = F.col("t"), F.col("id")
    first = [r.id for r in rows.orderBy(scalars.earliest_first(t, i)).collect()]
    last = [r.id for r in rows.orderBy(scalars.latest_first(t, i)).collect()]
    assert first == ["c", "a", "d", "b"]
    assert last == ["a", "d", "c", "b"]
