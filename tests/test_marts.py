"""Boundary values of the dashboard queries."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewell.operators import quality
from tidewell.plans import marts
from tidewell.settings import FRESHNESS_FLOORS

AS_OF = datetime(2025, 6, 30, 12)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_recency_boundaries(spark):
    days = [-3, 0, 7, 8, 30, 31, 90, 91, 400]
    rows = [(AS_OF - timedelta(days=d),) for d in days] + [(None,)]
    people = frame(spark, rows, "LAST_SEEN_TS timestamp_ntz")
    found = [tuple(r) for r in marts.recency_buckets(people, AS_OF).collect()]
    assert found == [("≤ 7 days", 3), ("8–30 days", 2), ("31–90 days", 2), ("> 90 days", 2)]


def snapshot(spark, ages):
    rows = [(None if a is None else AS_OF - timedelta(seconds=a),) for a in ages]
    return frame(spark, rows, "LAST_UPDATED_UTC timestamp_ntz")


def test_freshness_boundaries(spark):
    rows = snapshot(spark, [-10, 899, 900, 145600, 145601, None])
    found = [tuple(r) for r in marts.freshness_distribution(rows, AS_OF).collect()]
    third = Decimal("33.33")
    assert found == [("fresh", 2, third), ("stale", 2, third), ("expired", 2, third)]


def test_freshness_fills_gaps_and_floors(spark):
    rows = snapshot(spark, [1] * 30)
    assert [r.record_count for r in marts.freshness_distribution(rows, AS_OF).collect()] == [30, 0, 0]
    floored = marts.freshness_distribution(rows, AS_OF, FRESHNESS_FLOORS).collect()
    assert [r.record_count for r in floored] == [30, 15, 9]
    assert sum(r.percentage for r in floored) == pytest.approx(Decimal(100), abs=Decimal("0.02"))


def test_no_rows_at_all(spark):
    rows = snapshot(spark, [1]).where("false")
    assert [tuple(r) for r in marts.freshness_distribution(rows, AS_OF).collect()] == [
        ("fresh", 0, None), ("stale", 0, None), ("expired", 0, None),
    ]
    bridge = frame(spark, [("c", "p")], "SRC_CUSTOMER_ID string, PERSON_KEY string").where("false")
    assert tuple(marts.dedup_rate(bridge, bridge).first()) == (0, 0, 0)


def test_window_has_no_upper_end(spark):
    first = datetime(2025, 5, 31)
    rows = [(first - timedelta(microseconds=1), 1), (first, 2), (AS_OF + timedelta(days=9), 4)]
    fact = frame(spark, rows, "ORDER_TS timestamp_ntz, GROSS_AMOUNT int").withColumn("STATUS", F.lit("paid"))
    assert sum(r.revenue_aud for r in marts.daily_revenue(fact, AS_OF).collect()) == 6


def test_null_sorts_as_largest(spark):
    fact = frame(spark, [("a", 5), ("b", None), (None, 9)], "PRODUCT_ID string, GROSS_AMOUNT int").select(
        "*", F.lit("paid").alias("STATUS"), F.lit(AS_OF).cast("timestamp_ntz").alias("ORDER_TS")
    )
    assert [r.PRODUCT_ID for r in marts.top_products(fact, AS_OF).collect()] == ["b", None, "a"]


def test_source_without_unified_rows_keeps_nulls(spark):
    raw = frame(spark, [("A",), ("A",), ("B",)], "src_system string")
    unified = frame(spark, [("A",), ("b",)], "SRC_SYSTEM string")
    rows = [tuple(r) for r in marts.dedup_rate_by_source(raw, unified).collect()]
    assert rows == [("A", 2, 1, Decimal("50.00")), ("B", 1, None, None)]


def test_recent_orders_falls_back_to_all_orders(spark):
    """The newest orders name people nobody knows; the answer lies far behind them."""
    fact = spark.range(200).selectExpr(
        "TIMESTAMP_NTZ'2025-01-01 00:00:00' + make_dt_interval(0, CAST(id AS INT)) AS ORDER_TS",
        "CAST(id AS STRING) AS ORDER_ID_SRC",
        "CASE WHEN id < 20 THEN 'p' ELSE 'ghost' END AS PERSON_KEY",
        "'x' AS PRODUCT_ID",
        "id AS GROSS_AMOUNT",
    )
    people = frame(spark, [("p", "Pat")], "PERSON_KEY string, FULL_NAME string")
    products = frame(spark, [("x", "X")], "PRODUCT_ID string, PRODUCT_NAME string")
    for options in ({}, {"broadcast_rows": 0}):
        found = marts.recent_orders(fact, people, products, 3, **options).collect()
        assert [r.GROSS_AMOUNT for r in found] == [19, 18, 17]


def test_quality_reports(spark):
    df = frame(spark, [("a",), ("a",), ("b",), (None,)], "k string")
    found = {(r.key_value, r.row_count) for r in quality.key_violations(df, "t", "k").collect()}
    assert found == {("a", 2), (None, 1)}
    orphans = quality.orphan_keys(df.withColumn("j", F.lit(1)), "t", ["k", "j"]).collect()
    assert [(r.key_name, r.orphan_rows, r.row_count) for r in orphans] == [("k", 1, 4), ("j", 0, 4)]
    money = frame(spark, [("AUD", 1), ("HKY", 2), (None, 3)], "CURRENCY string, GROSS_AMOUNT int")
    flags = {r.currency: r.unknown_code for r in quality.currency_report(money).collect()}
    assert flags == {"AUD": False, "HKY": True, None: True}


def test_recent_orders_beyond_the_newest(spark):
    """None of the newest orders finds its customer, so all orders are looked up."""
    t = datetime(2024, 1, 1)
    rows = [(t + timedelta(minutes=i), str(i), "p" if i < 5 else f"gone{i}", "a", i) for i in range(60)]
    rows += [(t + timedelta(minutes=4), "4", "q", "a", 9)]  # a tie: the larger key first
    fact = spark.createDataFrame(rows, "ORDER_TS timestamp_ntz, ORDER_ID_SRC string, PERSON_KEY string, PRODUCT_ID string, GROSS_AMOUNT int")
    persons = spark.createDataFrame([("p", "Pia"), ("q", "Quy")], "PERSON_KEY string, FULL_NAME string")
    products = spark.createDataFrame([("a", "A")], "PRODUCT_ID string, PRODUCT_NAME string")
    found = [(r.FULL_NAME, r.GROSS_AMOUNT) for r in marts.recent_orders(fact, persons, products, 3).collect()]
    assert found == [("Quy", 9), ("Pia", 4), ("Pia", 3)]
