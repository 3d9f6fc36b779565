"""Dense global row numbers without pulling all rows into one partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.session import stage

_POSITION_BITS = 33  # layout of monotonically_increasing_id: partition above, position below


def number_rows(df: DataFrame, order_by: list[str], name: str) -> DataFrame:
    """Add ``name`` = 1..n in ascending order of ``order_by``, NULLs last.

    The rows are range-partitioned and sorted once, and stored with their partition and
    position. Only one count per partition is then needed to turn positions into global
    numbers. Storing first matters: range bounds are sampled, so a recomputed partition
    could otherwise hold other rows than the ones counted. ``order_by`` should identify a
    row; copies of one row are told apart by the input partition they come from, so that
    even a great many of them do not pile up in one partition.
    """
    order = [*[F.col(c).asc_nulls_last() for c in order_by], F.col("__origin").asc()]
    origin = df.withColumn("__origin", F.spark_partition_id())
    ranged = origin.repartitionByRange(*order).sortWithinPartitions(*order)
    place = ranged.select("*", F.monotonically_increasing_id().alias("__place"))
    stored = stage(
        place.select(
            *df.columns,
            F.shiftright("__place", _POSITION_BITS).alias("__part"),
            F.col("__place").bitwiseAND((1 << _POSITION_BITS) - 1).alias("__position"),
        ),
        "numbered",
    )
    # one row per partition, so this window sees a few thousand rows at the very most
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("__part")
        .agg(F.count("*").alias("__rows"))
        .select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    )
    numbered: Column = F.col("__before") + F.col("__position") + 1
    return stored.join(F.broadcast(offsets), "__part").select(
        *df.columns, numbered.cast("long").alias(name)
    )
