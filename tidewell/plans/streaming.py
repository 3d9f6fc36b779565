"""Bronze and silver as streams: exports are taken in as they arrive, by the same functions as a build.

A source is the folder of its export's name, to which files are added. Each run takes in what has
come since the last one. A micro-batch is landed, and what was landed is read back and cleaned, both
stored under the number of the batch; a batch that is run again after a failure replaces what it had
stored. Views over all batches are then those of a build from all files.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tidewell.plans import silver
from tidewell.session import stage, use_utc
from tidewell.settings import Settings
from tidewell.sources.files import RAW_FILES, RawFile, read_csv, read_json
from tidewell.sources.landing import land
from tidewell.sources.sinks import put_batch, read_batches

BRONZE_SCHEMA = "data variant, src_system string, src_file string, load_ts timestamp_ntz"
#: Of each entity: what its landed records are cleaned by.
CLEANED: dict[str, Callable[[DataFrame, Settings], DataFrame]] = {
    "users": silver.customer_records,
    "orders": silver.parsed_orders,
    "inventory": silver.parsed_inventory,
}


def _arriving(spark: SparkSession, root: str, file: RawFile) -> DataFrame | None:
    """The stream of an export's records; None when an optional export is absent."""
    path = f"{root.rstrip('/')}/{file.path}"
    try:
        if file.path.endswith(".csv"):
            return read_csv(spark, path, file.columns, file.multi_line, stream=True)
        return read_json(spark, path, file.columns, lines=file.path.endswith(".jsonl"), stream=True)
    except AnalysisException as e:
        if file.optional and e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _place(out: str, layer: str, file: RawFile) -> str:
    return f"{out.rstrip('/')}/stream/{layer}/{file.entity}/{file.src_system}"


def take_in(
    spark: SparkSession, root: str, out: str, settings: Settings, files: tuple[RawFile, ...] = RAW_FILES
) -> None:
    """Land and clean what has arrived since the last run."""
    use_utc(spark)
    if settings.identity_mode != "one_pass":
        raise ValueError("records are keyed as they arrive, so by one pass; IdentityStore follows chains over batches")
    for file in files:
        arriving = _arriving(spark, root, file)
        if arriving is None:
            continue

        def store(landed: DataFrame, batch: int, file: RawFile = file) -> None:
            put_batch(landed, _place(out, "bronze", file), batch)
            stored = read_batches(landed.sparkSession, _place(out, "bronze", file), BRONZE_SCHEMA, batch + 1)
            own = stored.where(f"batch = {batch}").drop("batch")
            put_batch(CLEANED[file.entity](own, settings), _place(out, "silver", file), batch)

        landed = land(arriving, file.src_system, file.name, settings.as_of)
        writer = landed.writeStream.foreachBatch(store).trigger(availableNow=True)
        writer.option("checkpointLocation", _place(out, "progress", file)).start().awaitTermination()


def taken_in(
    spark: SparkSession, out: str, entity: str, settings: Settings, files: tuple[RawFile, ...] = RAW_FILES
) -> DataFrame:
    """All cleaned rows of an entity."""
    schema = CLEANED[entity](spark.createDataFrame([], BRONZE_SCHEMA), settings).schema
    own = [read_batches(spark, _place(out, "silver", f), schema).drop("batch") for f in files if f.entity == entity]
    return reduce(DataFrame.unionByName, own)


def views(
    spark: SparkSession, out: str, settings: Settings, files: tuple[RawFile, ...] = RAW_FILES
) -> dict[str, DataFrame]:
    """The silver views over everything taken in, as a build stores them."""
    use_utc(spark)
    records, parsed, stock = (taken_in(spark, out, entity, settings, files) for entity in CLEANED)
    references = stage(silver.customer_references(records), "customer-references")
    return {
        "vw_customer_unified": silver.unify_customers(records, settings),
        "vw_orders_clean": silver.clean_orders(parsed, references),
        "vw_inventory_unified": silver.unify_inventory(stock, settings),
    }
