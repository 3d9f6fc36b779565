"""Stored distinct-count sketches: days are added one by one and united when asked, without a rescan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.sources.sinks import put_batch, read_batches

#: Sketches have 2**SIZE registers: a relative standard error of about 0.8 / 2**(SIZE / 2), here 0.65 %.
SIZE = 14
SKETCHES = "DAY date, CHANNEL string, SKETCH binary"


def add_sketches(rows: DataFrame, path: str, batch: int, day: Column, channel: Column, value: Column, size: int = SIZE) -> None:
    """Store one sketch of the values per day and channel of a batch; the same batch again replaces it."""
    keyed = rows.select(day.alias("DAY"), channel.alias("CHANNEL"), value.alias("VALUE")).where("VALUE IS NOT NULL")
    sketches = keyed.groupBy("DAY", "CHANNEL").agg(F.hll_sketch_agg("VALUE", F.lit(size)).alias("SKETCH"))
    put_batch(sketches, path, batch)


def distinct_estimates(spark: SparkSession, path: str, by: tuple[str, ...] = (), where: Column | None = None) -> DataFrame:
    """(``by``, estimate) of the distinct values in the sketches that ``where`` picks, by DAY, CHANNEL or neither."""
    sketches = read_batches(spark, path, SKETCHES)
    picked = sketches if where is None else sketches.where(where)
    united = picked.groupBy(*by).agg(F.hll_union_agg("SKETCH", F.lit(True)).alias("SKETCH"))
    return united.select(*by, F.coalesce(F.hll_sketch_estimate("SKETCH"), F.lit(0)).alias("estimate"))


def error_bound(size: int = SIZE, deviations: int = 4) -> float:
    """The share by which an estimate may be off, at so many standard errors."""
    return deviations * 0.8326 / 2 ** (size / 2)
