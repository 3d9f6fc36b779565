"""Scalar semantics the queries rely on where Spark's defaults differ.

Each helper returns a plain Column built from JVM functions, so plans stay inside
whole-stage code generation and filters on them still push down.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Characters that start a new word for initcap, besides white space.
WORD_BREAKS = r"""!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>"""


def moment(value: datetime) -> Column:
    """A timestamp literal without time zone."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def day(value: datetime) -> Column:
    return F.lit(value.strftime("%Y-%m-%d")).cast("date")


def number(col: Column, precision: int = 38, scale: int = 0) -> Column:
    """Fixed-point cast, halves rounded away from zero (an integer cast would truncate)."""
    return col.cast(DecimalType(precision, scale))


def blank_to_null(col: Column) -> Column:
    return F.nullif(F.trim(col), F.lit(""))


def initcap(col: Column) -> Column:
    """Capitalise after white space *and* punctuation; Spark's own splits on spaces only."""
    words = F.split(col, rf"(?<=[\s{WORD_BREAKS}])")
    return F.array_join(
        F.transform(
            words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2))))
        ),
        "",
    )


def zero_pad(col: Column, width: int) -> Column:
    """Left-pad a number with zeros; never cut digits off a longer one."""
    text = col.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def greatest_or_null(*cols: Column) -> Column:
    """NULL when any input is NULL; Spark's greatest skips NULLs."""
    some_null = cols[0].isNull()
    for col in cols[1:]:
        some_null = some_null | col.isNull()
    return F.when(~some_null, F.greatest(*cols))


def seconds_between(start: Column, end: Column) -> Column:
    """Number of second boundaries crossed (fractions are cut on both sides first)."""
    return F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(start.cast("timestamp"))


def days_between(start: Column, end: Column) -> Column:
    """Number of midnights crossed."""
    return F.datediff(end.cast("date"), start.cast("date"))


def start_of_day(col: Column) -> Column:
    return F.date_trunc("day", col).cast("timestamp_ntz")


def iso_weekday(col: Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(col) + 1


def weekday_label(col: Column) -> Column:
    return F.date_format(col, "E")


def timestamp_text(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def ratio(numerator: Column, denominator: Column, scale: int = 2) -> Column:
    """Exact decimal quotient, rounded to six places and then to ``scale``; NULL for x / 0."""
    quotient = number(numerator, 38, 6) / F.nullif(number(denominator, 20), number(F.lit(0), 20))
    return F.round(quotient.cast(DecimalType(38, 6)), scale).cast(DecimalType(18, scale))


def starts_with_choice(col: Column, choices: Mapping[str, str], default: str | None) -> Column:
    """First matching prefix decides."""
    picked = None
    for prefix, value in choices.items():
        test = col.startswith(prefix)
        picked = F.when(test, value) if picked is None else picked.when(test, value)
    return picked.otherwise(F.lit(default))


def equals_choice(col: Column, choices: Mapping[str, str], default: Column) -> Column:
    picked = None
    for key, value in choices.items():
        picked = F.when(col == key, value) if picked is None else picked.when(col == key, value)
    return picked.otherwise(default)


def earliest_first(ts: Column, *ties: Column) -> Column:
    """Sort key: oldest first, missing times last, then the tie-breaks ascending."""
    return F.struct(ts.isNull(), ts, *ties)


def latest_first(ts: Column, *ties: Column) -> Column:
    """Sort key whose minimum is the newest row; missing times last, ties ascending."""
    return F.struct(ts.isNull(), -F.unix_micros(ts.cast("timestamp")), *ties)
