from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewell.functions import parsing


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def text(t):
    return F.lit(t).cast("string")


@pytest.mark.parametrize(
    ("t", "expected"),
    [
        ("A$71.35", "71.35"),
        ("AUD 320.08", "320.08"),
        ("$5.99", "5.99"),
        ("640.10", "640.10"),
        ("-5", "-5.00"),
        ("1,234.5", "1234.50"),
        ("free", None),
        ("1.2.3", None),
        ("1.234,56", None),
        ("(12.00)", None),
        ("1.5E3", None),
        ("12,34", None),
        ("A$1,234,567.5", "1234567.50"),
        ("-$5", "-5.00"),
        ("$-5", "-5.00"),
        ("--5", None),
        (".5", "0.50"),
        ("12 AUD", None),
        (None, None),
    ],
)
def test_money(spark, t, expected):
    got = value(spark, parsing.money(text(t)))
    assert got == (None if expected is None else Decimal(expected))


def test_currency(spark):
    assert value(spark, parsing.currency_in_amount(text(" hkd 1.5"))) == "HKD"
    assert value(spark, parsing.currency_in_amount(text("A$1.5"))) is None
    assert value(spark, parsing.currency(text("aud"), "CNY")) == "AUD"
    assert value(spark, parsing.currency(text(" "), "CNY")) == "CNY"
    assert value(spark, parsing.currency_mismatch(text("HKD 72.16"), F.lit("AUD"))) is True
    assert value(spark, parsing.currency_mismatch(text("72.16"), F.lit("AUD"))) is False


@pytest.mark.parametrize(
    ("t", "expected"),
    [
        ("17/02/2024 21:45", datetime(2024, 2, 17, 21, 45)),
        ("2024-02-18 03:04:05", datetime(2024, 2, 18, 3, 4, 5)),
        ("2024-02-19T23:59:58.000321Z", datetime(2024, 2, 19, 23, 59, 58, 321)),
        ("2024-02-20T17:06:09+00:00+11:00", datetime(2024, 2, 20, 17, 6, 9)),
        ("2024-02-20T17:06:09+11:00", datetime(2024, 2, 20, 6, 6, 9)),
        ("2024-02-20T17:06:09-0330", datetime(2024, 2, 20, 20, 36, 9)),
        ("1708450000", datetime(2024, 2, 20, 17, 26, 40)),
        (" 17/02/2024 21:45 ", datetime(2024, 2, 17, 21, 45)),
        ("2024-02-20T17:06:09+11", datetime(2024, 2, 20, 6, 6, 9)),
        ("2024-02-20T17:06:09 Europe/Paris", None),
        ("2024-02-20T17:06:09+1", None),
        ("32/13/2024 21:45", None),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_utc_time(spark, t, expected):
    assert value(spark, parsing.utc_time(text(t))) == expected


def test_local_zone_applies_to_zoneless_times_only(spark):
    zone = "Australia/Sydney"
    assert value(spark, parsing.utc_time(text("20/02/2024 18:00"), zone)) == datetime(2024, 2, 20, 7)
    assert value(spark, parsing.utc_time(text("2024-02-20T18:00:00Z"), zone)) == datetime(2024, 2, 20, 18)
    assert value(spark, parsing.utc_time(text("1708450000"), zone)) == datetime(2024, 2, 20, 17, 26, 40)


def test_result_does_not_depend_on_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # this wall-clock time does not exist in that zone
        assert value(spark, parsing.utc_time(text("10/03/2024 02:30"))) == datetime(2024, 3, 10, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_double_offset_is_flagged(spark):
    assert value(spark, parsing.time_is_ambiguous(text("2024-02-20T17:06:09+00:00+11:00"))) is True
    assert value(spark, parsing.time_is_ambiguous(text("2024-02-20T17:06:09+11:00"))) is False
    assert value(spark, parsing.time_is_ambiguous(text(None))) is False


def test_contacts(spark):
    assert value(spark, parsing.email(text(" Mira@Kosta.TEST "))) == "mira@kosta.test"
    assert value(spark, parsing.email(text("  "))) is None
    assert value(spark, parsing.phone(text("61355500188.0"))) == "61355500188"
    assert value(spark, parsing.phone(text("+61 355-500-188"))) == "61355500188"
    assert value(spark, parsing.phone(text(""))) is None
    assert value(spark, parsing.phone_kept_plus(text("+61 355.0"))) == "+613550"
    assert value(spark, parsing.person_name(text(" MIRA KOSTA "))) == "Mira Kosta"


@pytest.mark.parametrize(
    ("digits", "expected"), [("612", "AU"), ("447", "GB"), ("861", "CN"), ("852", "HK"), ("1", None), (None, None)]
)
def test_locale(spark, digits, expected):
    assert value(spark, parsing.locale(text(digits))) == expected


@pytest.mark.parametrize(
    ("mail", "phone", "expected"),
    [("e", "p", "1.00"), ("e", None, "0.90"), (None, "p", "0.80"), (None, None, "0.50")],
)
def test_match_confidence(spark, mail, phone, expected):
    assert value(spark, parsing.match_confidence(text(mail), text(phone))) == Decimal(expected)


def test_codes(spark):
    assert value(spark, parsing.product_code(text(" nv-33 "))) == "NV33"
    assert value(spark, parsing.product_code(text(" nv-33 "), keep_hyphen=True)) == "NV-33"
    words = {"PAID": "paid", "Completed": "paid", "Success": "paid", "VOID": "void", "Refund": "refunded"}
    for word, status in {**words, "Cancelled": "cancelled", " On Hold": "on hold"}.items():
        assert value(spark, parsing.order_status(text(word))) == status


@pytest.mark.parametrize("t", ["2024", "202402", "2024-02-20", "2024-02", "10:30:00", "2024-02-20T17:06:09 +"])
def test_incomplete_times_are_refused(spark, t):
    assert value(spark, parsing.utc_time(text(t))) is None
