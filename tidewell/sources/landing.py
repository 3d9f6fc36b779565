"""Bronze: every source record as one VARIANT with its lineage."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.scalars import moment
from tidewell.sources.files import CORRUPT, RAW_FILES, RawFile, read_raw


def as_object(df: DataFrame) -> Column:
    """The whole row as one semi-structured object; NULL fields are left out.

    A record read as one VARIANT is that object already; a broken one is its text in CORRUPT.
    """
    if df.columns == ["data", CORRUPT]:
        broken = F.parse_json(F.to_json(F.struct(F.col(CORRUPT))))
        return F.when(F.col(CORRUPT).isNull(), F.col("data")).otherwise(broken)
    return F.parse_json(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))


def land(df: DataFrame, src_system: str, src_file: str, load_ts: datetime) -> DataFrame:
    return df.select(
        as_object(df).alias("data"),
        F.lit(src_system).alias("src_system"),
        F.lit(src_file).alias("src_file"),
        moment(load_ts).alias("load_ts"),
    )


def append_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Rows of all frames, duplicates kept."""
    return reduce(DataFrame.unionByName, frames)


def land_entity(
    spark: SparkSession,
    root: str,
    entity: str,
    load_ts: datetime,
    files: tuple[RawFile, ...] = RAW_FILES,
) -> DataFrame:
    """All exports of one entity in one landing frame."""
    frames = []
    for file in files:
        if file.entity != entity:
            continue
        df = read_raw(spark, root, file)
        if df is not None:
            frames.append(land(df, file.src_system, file.name, load_ts))
    return append_all(frames)


def _exact(text: Column, kind: str) -> Column:
    """The text of a floating-point number without an exponent; NULL if it has too many digits."""
    return text.try_cast(kind).try_cast("decimal(38,10)").cast("string")


def field(*paths: str, as_type: str = "string") -> Column:
    """First of the given object fields that is present and fits the type, else NULL.

    The same target field has another name in each export, and ``5`` may come as ``"5"``.
    A floating-point number becomes text without an exponent, as it would be written by hand.
    """

    def one(path: str) -> Column:
        value = F.try_variant_get("data", path, as_type)
        if as_type != "string":
            return value
        # the scan extracts every type that is asked of a path, for all rows: another cast than to text
        # fails on most values, and a failure costs more than the rest, so numbers are read from their text
        kind = F.schema_of_variant(F.try_variant_get("data", path, "variant"))
        read = F.when(kind == "FLOAT", _exact(value, "float")).otherwise(_exact(value, "double"))
        plain = F.regexp_replace(read, r"\.?0+$", "")
        floating = value.contains("E") & value.rlike(r"^-?\d(\.\d+)?E[+-]?\d+$") & kind.isin("DOUBLE", "FLOAT")
        return F.when(F.coalesce(floating, F.lit(False)), F.coalesce(plain, value)).otherwise(value)

    return F.coalesce(*[one(f"$.{p}") for p in paths])
