"""One row per key, chosen by a sort key, in a single shuffle with map-side reduction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], sort_key: Column) -> DataFrame:
    """Keep the row with the smallest ``sort_key`` of each key (NULL is a key like any other).

    An aggregate instead of a row-number window: every task first reduces its own rows, so a
    key that owns a third of the input still sends one row per task to the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), sort_key).alias("__best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"__best.{c}") for c in df.columns])
