"""Current stock as state: the newest row of every source per product, kept while rows arrive in any order.

The state of a product is one row per source. A row that is newer than its source's, by the same rule
as in a build (then the smallest row id, quantity and price), takes its place, and the product's rows
are given out anew with the conflict and coverage they now have; older rows that come late change
nothing. Numbers travel as text, so that none is rounded on the way.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from tidewell.functions.scalars import moment
from tidewell.plans.silver import INVENTORY_COLUMNS, freshness
from tidewell.settings import Settings
from tidewell.sources.sinks import put_batch, read_batches

_ROW = "source string, updated string, row_id string, qty string, price string, currency string"
_OUT = f"product string, {_ROW}, conflict boolean, coverage int"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def _place(value, kind=str) -> tuple:
    """NULL first, as Spark orders."""
    return (value is not None, kind(value) if value is not None else None)


def newest_first(row: tuple) -> tuple:
    """Sort key of (updated, row_id, qty, price, currency): the newest row is the smallest."""
    updated, row_id, qty, price, currency = row
    return (updated is None, -int(updated or 0), _place(row_id), _place(qty, int), _place(price, Decimal), _place(currency))


class NewestRows(StatefulProcessor):
    def __init__(self, tolerance: float) -> None:
        self.tolerance = Decimal(str(tolerance))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getMapState("rows", "source string", _ROW.split(", ", 1)[1])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held, changed = {source[0]: tuple(row) for source, row in self.rows.iterator()}, set()
        for batch in rows:
            batch = batch.astype(object).where(batch.notna(), None)
            for source, *row in batch[[f.split()[0] for f in _ROW.split(", ")]].itertuples(index=False):
                if source not in held or newest_first(tuple(row)) < newest_first(held[source]):
                    held[source] = tuple(row)
                    changed.add(source)
        if not changed:
            return
        for source in changed:
            self.rows.updateValue((source,), held[source])
        amounts = [int(r[2]) for r in held.values() if r[2] is not None]
        prices = [Decimal(r[3]) for r in held.values() if r[3] is not None]
        conflict = len(set(amounts)) > 1 or bool(prices) and max(prices) - min(prices) > self.tolerance
        coverage = sum(source != "" for source in held)
        table = [(key[0], source, *row, conflict, coverage) for source, row in held.items()]
        yield pd.DataFrame(table, columns=[f.split()[0] for f in _OUT.split(", ")])

    def close(self) -> None:
        pass


@contextmanager
def _state_store(spark: SparkSession) -> Iterator[None]:
    """Map state needs the store that keeps it on disk."""
    old = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, old) if old else spark.conf.unset(_PROVIDER)


def keep_stock(arriving: DataFrame, out: str, settings: Settings) -> None:
    """Take in the parsed inventory rows that have arrived since the last run."""
    keyed = arriving.select(
        F.coalesce(F.concat(F.lit("="), "PRODUCT_ID"), F.lit("")).alias("product"),  # NULL is a product, too
        F.coalesce(F.concat(F.lit("="), "SRC_SYSTEM"), F.lit("")).alias("source"),
        F.unix_micros(F.col("LAST_UPDATED_UTC").cast("timestamp")).cast("string").alias("updated"),
        F.col("ROW_ID").cast("string").alias("row_id"),
        F.col("AVAILABLE_QTY").cast("string").alias("qty"),
        F.col("PRICE").cast("string").alias("price"),
        F.col("CURRENCY").alias("currency"),
    )
    found = keyed.groupBy("product").transformWithStateInPandas(
        NewestRows(settings.price_tolerance), StructType.fromDDL(_OUT), "Update", "None"
    )
    with _state_store(arriving.sparkSession):
        writer = found.writeStream.outputMode("update").trigger(availableNow=True)
        writer = writer.foreachBatch(lambda rows, batch: put_batch(rows, f"{out}/stock", batch))
        writer.option("checkpointLocation", f"{out}/stock-progress").start().awaitTermination()


def current_stock(spark: SparkSession, out: str, settings: Settings) -> DataFrame:
    """The inventory as ``unify_inventory`` gives it, from the rows last given out of each product."""
    rows = read_batches(spark, f"{out}/stock", _OUT)
    whole = F.struct("batch", F.struct("source", "updated", "row_id", "qty", "price", "currency", "conflict", "coverage").alias("row"))
    # a product has as many rows per batch as sources; those of its last batch are the current ones
    newest = rows.groupBy("product", "source").agg(F.max(whole).alias("last"))
    current = newest.select("product", "last.batch", "last.row.*")
    last = rows.groupBy("product").agg(F.max("batch").alias("batch"))
    current = current.join(last, ["product", "batch"], "left_semi")
    updated = F.timestamp_micros(F.col("updated").cast("long")).cast("timestamp_ntz")
    named = current.select(
        F.substring("product", 2, 1 << 30).alias("PRODUCT_ID"),
        F.col("qty").cast("bigint").alias("AVAILABLE_QTY"),
        F.col("price").cast("decimal(18,2)").alias("PRICE"),
        F.col("currency").alias("CURRENCY"),
        updated.alias("LAST_UPDATED_UTC"),
        F.substring("source", 2, 1 << 30).alias("SRC_SYSTEM"),
        F.col("conflict").alias("CONFLICT_FLAG"),
        F.col("coverage").alias("SOURCE_COVERAGE"),
        "product",
        "source",
    )
    named = named.withColumns(
        {
            "PRODUCT_ID": F.when(F.col("product") != "", F.col("PRODUCT_ID")),
            "SRC_SYSTEM": F.when(F.col("source") != "", F.col("SRC_SYSTEM")),
        }
    )
    flag = freshness(F.col("LAST_UPDATED_UTC"), moment(settings.as_of), ("fresh", "stale", "expired"))
    return named.withColumn("FRESHNESS_FLAG", flag).select(*INVENTORY_COLUMNS)
