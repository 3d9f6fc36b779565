"""Daily order rollups kept up to date: a changed order takes its old numbers back and adds its new ones.

``versions`` has every state an order was in, ``deltas`` the counts and amounts each batch of changes
adds per day, hour, status, channel and product, with the opposite sign for the states it replaces.
Counts and sums add up, so the rollup is the sum of the deltas; a batch of changes reads the earlier
states of its own orders and writes only the days these move from and to.

A batch is there when its ``versions`` are. Running the last batch again replaces it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.scalars import latest_first, ratio
from tidewell.session import stage
from tidewell.sources.sinks import put_batch, read_batches, stored_batches

KEYS = ("ORDER_DAY", "ORDER_HOUR", "STATUS", "CHANNEL_ID", "PRODUCT_ID")
DELTAS = (
    "ORDER_DAY date, ORDER_HOUR int, STATUS string, CHANNEL_ID string, PRODUCT_ID string, ORDERS long,"
    " GROSS_AMOUNT decimal(38,2), ORDER_MONTH date"
)
VERSIONS = (
    "ORDER_ID string, ORDER_TS timestamp_ntz, STATUS string, CHANNEL_ID string, PRODUCT_ID string,"
    " GROSS_AMOUNT decimal(38,2), DELETED boolean"
)


@dataclass(frozen=True)
class OrderRollup:
    path: str

    def add(self, changes: DataFrame, batch: int) -> None:
        """Take in changed orders, one row of VERSIONS each; of several rows of an order the latest time counts."""
        spark = changes.sparkSession
        later = [n for n in stored_batches(spark, self._versions) if n > batch]
        if later:
            raise ValueError(f"batch {batch} cannot be added: batch {later[-1]} rests on those before it")
        names = [f.split()[0] for f in VERSIONS.split(", ")]
        rows = changes.select(*[F.col(n).cast(kind).alias(n) for n, kind in (f.strip().split() for f in VERSIONS.split(", "))])
        others = [F.col(n) for n in names if n not in ("ORDER_ID", "ORDER_TS")]
        newest = F.min_by(F.struct(*names[1:]), latest_first(F.col("ORDER_TS"), *others)).alias("row")
        new = stage(rows.groupBy("ORDER_ID").agg(newest).select("ORDER_ID", "row.*"), "changed-orders")
        earlier = read_batches(spark, self._versions, VERSIONS, batch).join(new.select("ORDER_ID"), "ORDER_ID", "left_semi")
        state = F.max_by(F.struct(*names[1:]), "batch").alias("row")
        old = earlier.groupBy("ORDER_ID").agg(state).select("ORDER_ID", "row.*")
        signed = new.withColumn("__sign", F.lit(1)).unionByName(old.withColumn("__sign", F.lit(-1))).where("NOT coalesce(DELETED, false)")
        deltas = (
            signed.withColumns({"ORDER_DAY": F.to_date("ORDER_TS"), "ORDER_HOUR": F.hour("ORDER_TS")})
            .groupBy(*KEYS)
            .agg(
                F.sum("__sign").cast("long").alias("ORDERS"),
                F.sum(F.col("__sign") * F.col("GROSS_AMOUNT")).cast("decimal(38,2)").alias("GROSS_AMOUNT"),
            )
            .where("ORDERS <> 0 OR GROSS_AMOUNT <> 0")
        )
        dated = deltas.withColumn("ORDER_MONTH", F.trunc("ORDER_DAY", "MM"))
        put_batch(dated.repartition("ORDER_MONTH"), self._deltas, batch, ("ORDER_MONTH",))
        put_batch(new, self._versions, batch)

    def rows(self, spark: SparkSession, first_day: str | None = None) -> DataFrame:
        """Orders and amount per day, hour, status, channel and product, from ``first_day`` on."""
        committed = max(stored_batches(spark, self._versions), default=-1) + 1
        deltas = read_batches(spark, self._deltas, DELTAS, committed)
        if first_day is not None:  # months are folders
            day = F.lit(first_day).cast("date")
            deltas = deltas.where((F.col("ORDER_MONTH") >= F.trunc(day, "MM")) & (F.col("ORDER_DAY") >= day))
        sums = deltas.groupBy(*KEYS).agg(F.sum("ORDERS").alias("ORDERS"), F.sum("GROSS_AMOUNT").alias("GROSS_AMOUNT"))
        return sums.where("ORDERS <> 0")

    @property
    def _versions(self) -> str:
        return f"{self.path}/versions"

    @property
    def _deltas(self) -> str:
        return f"{self.path}/deltas"


def daily_revenue(rollup: DataFrame) -> DataFrame:
    """Paid orders, revenue and average per day, from rows of a rollup."""
    return (
        rollup.where("STATUS = 'paid'")
        .groupBy(F.col("ORDER_DAY").cast("timestamp_ntz").alias("order_day"))
        .agg(F.sum("ORDERS").alias("total_orders"), F.sum("GROSS_AMOUNT").alias("revenue_aud"))
        .withColumn("aov_aud", ratio(F.col("revenue_aud"), F.col("total_orders")))
        .orderBy(F.asc_nulls_last("order_day"))
    )


def status_mix(rollup: DataFrame) -> DataFrame:
    """Orders per status, from rows of a rollup."""
    by_status = rollup.groupBy("STATUS").agg(F.sum("ORDERS").alias("orders"))
    return by_status.orderBy(F.desc_nulls_first("orders"), F.asc_nulls_last("STATUS"))
