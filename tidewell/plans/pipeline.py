"""The whole build: raw exports -> landing -> silver -> gold tables on storage."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators import quality
from tidewell.plans import gold, silver
from tidewell.session import staging, use_utc
from tidewell.settings import Settings
from tidewell.sources.files import RAW_FILES, RawFile
from tidewell.sources.gate import gated_refresh
from tidewell.sources.landing import append_all, land_entity
from tidewell.sources.sinks import append_snapshot, full_refresh

BRONZE = ("raw_users", "raw_orders", "raw_inventory")
SILVER = ("vw_customer_unified", "vw_orders_clean", "vw_inventory_unified")
GOLD = (
    "dim_person",
    "dim_product",
    "dim_channel",
    "fact_orders",
    "fact_inventory_snapshot",
    "bridge_person_identity_map",
)


def build_bronze(
    spark: SparkSession,
    source_root: str,
    out: str,
    settings: Settings,
    files: tuple[RawFile, ...] = RAW_FILES,
) -> dict[str, DataFrame]:
    return {
        f"raw_{entity}": full_refresh(
            land_entity(spark, source_root, entity, settings.as_of, files), f"{out}/bronze/raw_{entity}"
        )
        for entity in ("users", "orders", "inventory")
    }


def build_silver(
    bronze: dict[str, DataFrame],
    out: str,
    settings: Settings,
    extra_customers: Iterable[DataFrame] = (),
) -> dict[str, DataFrame]:
    """``extra_customers``: further customer records that already have the contract columns."""
    records = silver.customer_records(bronze["raw_users"], settings)
    for more in extra_customers:
        records = records.unionByName(more.select(*silver.CUSTOMER_COLUMNS))
    records = full_refresh(records, f"{out}/silver/customer_records")
    references = full_refresh(silver.customer_references(records), f"{out}/silver/customer_references")
    # parsed once: the lookup counts hot keys on it, then joins it
    parsed = full_refresh(silver.parsed_orders(bronze["raw_orders"], settings), f"{out}/silver/parsed_orders")
    stock = silver.parsed_inventory(bronze["raw_inventory"], settings)
    frames = {
        "vw_customer_unified": silver.unify_customers(records, settings),
        "vw_orders_clean": silver.clean_orders(parsed, references),
        "vw_inventory_unified": silver.unify_inventory(stock, settings),
    }
    return {name: full_refresh(df, f"{out}/silver/{name}") for name, df in frames.items()}


def build_gold(tables: dict[str, DataFrame], out: str, settings: Settings) -> dict[str, DataFrame]:
    """Gold tables from silver frames. Dimensions are stored before the facts look keys up."""
    customers, orders, inventory = (tables[n] for n in SILVER)

    def put(name: str, df: DataFrame, **kw) -> DataFrame:
        if settings.quality_limits is None:
            return full_refresh(df, f"{out}/gold/{name}", **kw)
        gate = gold.table_gate(name, settings.quality_limits.get(name, {}))
        return gated_refresh(df, f"{out}/gold/{name}", gate, f"{out}/quarantine/{name}", **kw)

    def keys(name: str) -> str | None:
        return f"{out}/keys/{name}" if settings.stable_keys else None

    persons = put("dim_person", gold.dim_person(customers, keys("dim_person")))
    products = put("dim_product", gold.dim_product(orders, inventory, keys("dim_product")))
    channels = put("dim_channel", gold.dim_channel(orders, inventory, customers, keys("dim_channel")))
    fact = gold.fact_orders(orders, persons, products, channels, settings)
    # rows are numbered in time order, so each task writes to few folders; sorted times within
    # a month let the reader skip row groups
    dated = fact.select("*", F.trunc("ORDER_TS", "MM").alias("ORDER_MONTH"))
    dated = dated.sortWithinPartitions("ORDER_MONTH", "ORDER_TS")
    fact = put("fact_orders", dated, partition_by=("ORDER_MONTH",))
    stock = gold.fact_inventory_snapshot(inventory, products, channels, settings)
    if settings.append_snapshots:
        stock = append_snapshot(stock, f"{out}/gold/fact_inventory_snapshot")
    else:
        stock = put("fact_inventory_snapshot", stock)
    bridge = put("bridge_person_identity_map", gold.bridge_person_identity(customers, settings))
    return dict(zip(GOLD, (persons, products, channels, fact, stock, bridge)))


QUALITY = ("key_violations", "orphan_keys", "bad_records", "parse_flags", "currencies")


def build_quality(tables: dict[str, DataFrame], out: str) -> dict[str, DataFrame]:
    """What the checks find in a finished build, stored beside it. Gates refuse rows, this does not."""
    landed = append_all(tables[n] for n in BRONZE)
    parsed = tables["vw_orders_clean"].sparkSession.read.parquet(f"{out}/silver/parsed_orders")
    found = {
        "key_violations": quality.all_key_violations(tables, gold.TABLE_KEYS),
        "orphan_keys": quality.orphan_keys(tables["fact_orders"], "fact_orders", ["PERSON_KEY", "PRODUCT_ID", "CHANNEL_ID"]),
        "bad_records": quality.bad_records(landed),
        "parse_flags": quality.parse_flags(parsed),
        "currencies": quality.currency_report(tables["vw_orders_clean"]),
    }
    return {name: full_refresh(df, f"{out}/quality/{name}") for name, df in found.items()}


def build(
    spark: SparkSession,
    source_root: str,
    out: str,
    settings: Settings,
    files: tuple[RawFile, ...] = RAW_FILES,
    extra_customers: Iterable[DataFrame] = (),
) -> dict[str, DataFrame]:
    """Run every layer and the checks, and return all stored tables by name."""
    use_utc(spark)
    with staging(spark):
        bronze = build_bronze(spark, source_root, out, settings, files)
        views = build_silver(bronze, out, settings, extra_customers)
        tables = {**bronze, **views, **build_gold(views, out, settings)}
        records = spark.read.parquet(f"{out}/silver/customer_records")
        ids = full_refresh(gold.person_source_ids(records), f"{out}/gold/person_source_ids")
        tables["person_source_ids"] = ids
        return {**tables, **build_quality(tables, out)}
