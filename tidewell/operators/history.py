"""A table's days as intervals: a row is stored once for all the days on which it did not change.

``open`` holds the rows of the last recorded day with the day each appeared; ``closed`` holds rows
that are gone, with the day they went, one batch per day on which any did. So storage grows with
changes, not with days. Rows are compared as wholes, by a digest of all their columns, and copies of
a row are one stored row with their number.

A day is there when its ``open`` rows are: they are written last, and closed rows of a later day are
not read. Recording the last day again replaces it; an earlier day cannot be recorded afterwards.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructType

from tidewell.session import stage
from tidewell.sources.sinks import drop_batch, put_batch, read_batches, stored_batches

#: Copies of one row that a task makes in one go.
COPIES = 10_000
_FIRST, _GONE, _COPIES, _DIGEST = "VALID_FROM", "VALID_TO", "COPIES", "__digest"


@dataclass(frozen=True)
class History:
    """The history at ``path`` of a table with these columns."""

    path: str
    schema: StructType

    def record(self, rows: DataFrame, day: date) -> None:
        """Store what the table is on this day."""
        spark, number = rows.sparkSession, _number(day)
        last = self._last(spark)
        if last is not None and last > number:
            raise ValueError(f"{day} cannot be recorded after {last}")
        columns = [F.col(f"`{c}`") for c in self.schema.names]
        now = rows.select(*columns).groupBy(*columns).agg(F.count("*").alias("__now"))
        now = stage(now.withColumn(_DIGEST, self._digest()), "snapshot-rows")
        before = self._before(spark, number).withColumn(_DIGEST, self._digest())
        old, new = before.alias("old"), now.alias("new")
        met = stage(old.join(new, _DIGEST, "full").select(
            *[F.coalesce(f"old.`{c}`", f"new.`{c}`").alias(c) for c in self.schema.names], _FIRST, _COPIES, "__now",
        ), "snapshot-changes")
        same = F.coalesce(F.col(_COPIES) == F.col("__now"), F.lit(False))
        gone = met.where(F.col(_COPIES).isNotNull() & ~same)
        put_batch(gone.select(*columns, _FIRST, F.lit(day).alias(_GONE), _COPIES), self._closed, number)
        first = F.when(same, F.col(_FIRST)).otherwise(F.lit(day)).alias(_FIRST)
        put_batch(met.where("__now IS NOT NULL").select(*columns, first, F.col("__now").alias(_COPIES)), self._open, number)
        for old_number in stored_batches(spark, self._open):
            if old_number < number:
                drop_batch(spark, self._open, old_number)

    def as_of(self, spark: SparkSession, day: date) -> DataFrame:
        """The rows of the last day recorded up to this one."""
        found = self.intervals(spark).where((F.col(_FIRST) <= F.lit(day)) & (F.col(_GONE).isNull() | (F.col(_GONE) > F.lit(day))))
        columns = [F.col(f"`{c}`") for c in self.schema.names]
        parts = found.select(*columns, F.explode(F.sequence(F.lit(0), F.col(_COPIES) - 1, F.lit(COPIES))).alias("__from"), _COPIES)
        copies = F.sequence(F.lit(1), F.least(F.lit(COPIES), F.col(_COPIES) - F.col("__from")))
        return parts.select(*columns, F.explode(copies).alias("__copy")).drop("__copy")

    def intervals(self, spark: SparkSession) -> DataFrame:
        """Every row with VALID_FROM, VALID_TO (the first day without it; NULL if it is there) and COPIES."""
        last = self._last(spark)
        opened = read_batches(spark, self._open, self._stored(_FIRST), None).where(F.col("batch") == F.lit(last))
        closed = read_batches(spark, self._closed, self._stored(_FIRST, _GONE), None if last is None else last + 1)
        return opened.withColumn(_GONE, F.lit(None).cast("date")).drop("batch").unionByName(closed.drop("batch"))

    # --- parts -------------------------------------------------------------------------------

    @property
    def _open(self) -> str:
        return f"{self.path}/open"

    @property
    def _closed(self) -> str:
        return f"{self.path}/closed"

    def _stored(self, *days: str) -> StructType:
        fields = StructType(list(self.schema.fields))
        for name in days:
            fields = fields.add(name, DateType())
        return fields.add(_COPIES, LongType())

    def _digest(self):
        whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in self.schema.names]), {"ignoreNullFields": "false"})
        return F.sha2(whole, 256)

    def _last(self, spark: SparkSession) -> int | None:
        return max(stored_batches(spark, self._open), default=None)

    def _before(self, spark: SparkSession, number: int) -> DataFrame:
        """The rows that were there before this day; if it is recorded already, what it closed is open again."""
        day = F.to_date(F.lit(str(number)), "yyyyMMdd")
        rows = self.intervals(spark).where((F.col(_FIRST) < day) & (F.col(_GONE).isNull() | (F.col(_GONE) >= day)))
        return rows.drop(_GONE)


def _number(day: date) -> int:
    return int(day.strftime("%Y%m%d"))
