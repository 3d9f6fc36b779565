"""Surrogate keys that stay: a key once numbered keeps its number in all later builds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidewell.operators.lookup import lookup
from tidewell.operators.numbering import number_rows
from tidewell.session import stage
from tidewell.sources.sinks import put_batch, read_batches, stored_batches

KEYS = "business_key string, number long"


def with_stable_numbers(df: DataFrame, business_key: str, name: str, path: str, **lookup_options) -> DataFrame:
    """Add ``name``, the number of each business key in the key map at ``path``.

    Keys the map does not have are numbered in their order above its largest number, and become its
    next batch, which appears whole or not at all. On a new map the numbers are those of
    ``number_rows``. A NULL key has no number. The key must be text. Two builds must not add to one
    map at the same time.
    """
    if not isinstance(df.schema[business_key].dataType, StringType):
        raise TypeError(f"{business_key} must be text")
    spark = df.sparkSession
    known = read_batches(spark, path, KEYS)
    keys = df.select(F.col(business_key).alias("business_key")).where("business_key IS NOT NULL").distinct()
    new = stage(keys.join(known, "business_key", "left_anti"), "new-keys")
    if not new.isEmpty():
        largest = known.agg(F.max("number")).first()[0] or 0
        numbered = number_rows(new, ["business_key"], "number")
        batch = max(stored_batches(spark, path), default=-1) + 1
        put_batch(numbered.select("business_key", (F.col("number") + largest).alias("number")), path, batch)
    key_map = read_batches(spark, path, KEYS)
    return lookup(df, key_map, {"business_key": F.col(business_key)}, {name: "number"}, **lookup_options)
