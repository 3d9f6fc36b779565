"""Cleaning of raw text fields: money, times, contacts, product codes, status words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tidewell.functions.scalars import blank_to_null, equals_choice, starts_with_choice
from tidewell.settings import LOCALE_PREFIXES, STATUS_WORDS

_OFFSET = r"[+-]\d{2}(?::?\d{2})?"
_WALL = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?$"
# a sign, a currency code or symbol in front, thousands in threes, a decimal point
_AMOUNT = r"^(-?)\s*(?:[A-Za-z]{0,3}\s*[$€£¥]?)\s*(-?)((?:\d+|\d{1,3}(?:,\d{3})+)(?:\.\d*)?|\.\d+)$"


# --- money -------------------------------------------------------------------------------


def money(text: Column) -> Column:
    """``A$12.30``, ``AUD 12.30``, ``$1,200``, ``-5`` or a bare number -> decimal(18,2).

    Anything else, such as a comma for the decimal point or brackets for a minus, is NULL.
    """
    raw = F.trim(text)
    parts = [F.regexp_extract(raw, _AMOUNT, i) for i in (1, 2, 3)]
    digits = F.regexp_replace(F.concat(F.when(F.concat(*parts[:2]) == "-", "-").otherwise(""), parts[2]), ",", "")
    return F.when(raw.rlike(_AMOUNT) & (F.concat(*parts[:2]) != "--"), digits).try_cast(DecimalType(18, 2))


def currency_in_amount(text: Column) -> Column:
    """Three-letter code written in front of the amount, if any."""
    code = F.regexp_extract(F.upper(F.trim(text)), r"^([A-Z]{3})\s*[-0-9]", 1)
    return F.nullif(code, F.lit(""))


def currency(code: Column, default: str) -> Column:
    return F.coalesce(F.upper(blank_to_null(code)), F.lit(default))


def currency_mismatch(amount_text: Column, code: Column) -> Column:
    """True when the amount names another currency than the currency column."""
    return F.coalesce(currency_in_amount(amount_text) != code, F.lit(False))


# --- times -------------------------------------------------------------------------------


def utc_time(text: Column, local_zone: str = "UTC") -> Column:
    """Parse any of the raw time formats to UTC wall-clock time; NULL when none fits.

    Accepted: epoch seconds, ``dd/MM/yyyy HH:mm``, ``yyyy-MM-dd HH:mm:ss``, ISO with ``Z``,
    ISO with one offset (``+HH``, ``+HHMM``, ``+HH:MM``), ISO with two offsets (the first counts). Times without a zone are
    read in ``local_zone``. The work is done on zone-less timestamps throughout, so the
    result does not depend on the session time zone.
    """
    raw = F.trim(text)
    day_first = (F.length(raw) == 16) & (F.substring(raw, 3, 1) == "/") & (F.substring(raw, 6, 1) == "/")
    turned = F.concat_ws(
        "-", F.substring(raw, 7, 4), F.substring(raw, 4, 2), F.concat(F.left(raw, F.lit(2)), F.substring(raw, 11, 6))
    )
    iso = F.when(day_first, turned).otherwise(raw)
    body = F.regexp_replace(iso, rf"(Z|{_OFFSET}|{_OFFSET}{_OFFSET})$", "")
    # a bare number, a date, or a time with a zone's name would pass the cast as well
    wall = F.when(body.rlike(_WALL), body).try_cast("timestamp_ntz")

    # +HH or +HHMM of the first offset; the sign goes with both parts. Only real offsets are
    # cast: each failing try_cast raises and drops an exception, which costs more than the rest
    tail = F.substr(iso, F.length(body) + 1, F.length(iso))
    offset = F.replace(F.regexp_extract(tail, rf"^(Z|{_OFFSET})", 1), F.lit(":"), F.lit(""))
    sign = F.when(offset.startswith("+") | offset.startswith("-"), F.left(offset, F.lit(1)))
    hours = F.concat(sign, F.substring(offset, 2, 2)).cast("int")
    minutes = F.when(F.length(offset) == 5, F.concat(sign, F.substring(offset, 4, 2))).cast("int")
    shift = F.make_dt_interval(F.lit(0), F.coalesce(hours, F.lit(0)), F.coalesce(minutes, F.lit(0)))
    parsed = wall - shift
    if local_zone != "UTC":
        local = F.convert_timezone(F.lit(local_zone), F.lit("UTC"), wall)
        parsed = F.when(offset == "", local).otherwise(parsed)

    epoch = F.when(raw.rlike(r"^\d{9,11}$"), raw).cast("long")
    since_epoch = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=epoch)
    return F.coalesce(parsed, since_epoch)


def time_is_ambiguous(text: Column) -> Column:
    """True when a time carries two UTC offsets."""
    return F.coalesce(F.trim(text).rlike(rf"{_OFFSET}{_OFFSET}$"), F.lit(False))


# --- contacts ----------------------------------------------------------------------------


def email(text: Column) -> Column:
    return F.lower(blank_to_null(text))


def phone(text: Column) -> Column:
    """Digits only. A trailing ``.0`` left by a float column goes first."""
    whole = F.regexp_replace(F.trim(text), r"\.0+$", "")
    return F.nullif(F.regexp_replace(whole, r"[^0-9]", ""), F.lit(""))


def phone_kept_plus(text: Column) -> Column:
    """The dimension's rule: drop everything but digits and plus signs."""
    return F.regexp_replace(blank_to_null(text), "[^0-9+]", "")


def person_name(text: Column) -> Column:
    return F.initcap(blank_to_null(text))


def locale(phone_digits: Column) -> Column:
    return starts_with_choice(phone_digits, LOCALE_PREFIXES, None)


def match_confidence(email_norm: Column, phone_norm: Column) -> Column:
    return (
        F.when(email_norm.isNotNull() & phone_norm.isNotNull(), 1.0)
        .when(email_norm.isNotNull(), 0.9)
        .when(phone_norm.isNotNull(), 0.8)
        .otherwise(0.5)
        .cast(DecimalType(3, 2))
    )


# --- codes -------------------------------------------------------------------------------


def product_code(text: Column, keep_hyphen: bool = False) -> Column:
    code = F.upper(F.trim(text))
    return code if keep_hyphen else F.replace(code, F.lit("-"), F.lit(""))


def order_status(text: Column) -> Column:
    word = F.lower(F.trim(text))
    return equals_choice(word, STATUS_WORDS, word)
