"""Gold: person, product and channel dimensions, order and inventory facts, identity bridge.

Builders take silver-contract frames and stay lazy, except for row numbering and the size
check of a lookup table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewell.functions.parsing import email, phone_kept_plus
from tidewell.functions.scalars import (
    blank_to_null,
    earliest_first,
    equals_choice,
    initcap,
    latest_first,
    moment,
    number,
    seconds_between,
    starts_with_choice,
    zero_pad,
)
from tidewell.operators.history import History
from tidewell.operators.lookup import Lookup, lookups
from tidewell.operators.numbering import number_rows
from tidewell.operators.stable_keys import with_stable_numbers
from tidewell.settings import (
    CATEGORY_DEFAULT,
    CATEGORY_PREFIXES,
    CHANNEL_TYPE_DEFAULT,
    CHANNEL_TYPES,
    Settings,
)
from tidewell.sources.gate import Gate

# Keys each table promises to keep unique and filled.
TABLE_KEYS = {
    "dim_person": ["PERSON_ID", "PERSON_KEY"],
    "dim_product": ["PRODUCT_ID_KEY", "PRODUCT_ID"],
    "dim_channel": ["CHANNEL_KEY", "CHANNEL_ID"],
}


def table_gate(name: str, allowed: dict[str, int]) -> Gate:
    """What rows of a gold table must fulfil to be stored in it."""
    rules = {"time filled": F.col("ORDER_TS").isNull(), "amount filled": F.col("GROSS_AMOUNT").isNull()}
    return Gate(rules if name == "fact_orders" else {}, tuple(TABLE_KEYS.get(name, ())), allowed)


def with_surrogate(df: DataFrame, business_key: str, name: str, key_map: str | None = None) -> DataFrame:
    """Dense number in business-key order; a NULL key stays without a number.

    With a key map, a folder that earlier builds have filled, known keys keep their numbers.
    """
    if key_map is not None:
        return with_stable_numbers(df, business_key, name, key_map)
    numbered = number_rows(df, [business_key], name)
    return numbered.withColumn(name, F.when(F.col(business_key).isNotNull(), F.col(name)))


# --- dimensions --------------------------------------------------------------------------


def person_rows(customers: DataFrame) -> DataFrame:
    """One row per person: first channel, latest attributes, any e-mail and phone.

    A single aggregation. E-mail and phone are the largest raw values, normalised after
    the choice.
    """
    columns = ("SRC_SYSTEM", "SRC_USER_ID", "FULL_NAME", "LOCALE", "MATCH_CONFIDENCE")
    seen, ties = F.col("LAST_SEEN_UTC"), [F.col(c) for c in columns]
    newest = F.struct("FULL_NAME", "LOCALE", "SRC_SYSTEM", "SRC_USER_ID", "LAST_SEEN_UTC", "MATCH_CONFIDENCE")
    persons = (
        customers.where("PERSON_KEY IS NOT NULL")
        .groupBy("PERSON_KEY")
        .agg(
            F.max("EMAIL").alias("EMAIL"),
            F.max("PHONE").alias("PHONE"),
            F.min_by("SRC_SYSTEM", earliest_first(seen, *ties)).alias("FIRST_CHANNEL"),
            F.min_by(newest, latest_first(seen, *ties)).alias("NEWEST"),
        )
    )
    return persons.select(
        "PERSON_KEY",
        email(F.col("EMAIL")).alias("EMAIL_NORM"),
        phone_kept_plus(F.col("PHONE")).alias("PHONE_NORM"),
        F.col("NEWEST.FULL_NAME"),
        F.col("NEWEST.LOCALE"),
        F.lower("FIRST_CHANNEL").alias("FIRST_SEEN_CHANNEL"),
        F.col("NEWEST.LAST_SEEN_UTC").alias("LAST_SEEN_TS"),
        F.lower("NEWEST.SRC_SYSTEM").alias("SRC_SYSTEM_LATEST"),
        F.col("NEWEST.SRC_USER_ID").alias("SRC_USER_ID_LATEST"),
        F.col("NEWEST.MATCH_CONFIDENCE"),
    )


def product_rows(orders: DataFrame, inventory: DataFrame) -> DataFrame:
    """Every product code seen, NULL included, with display name and category."""
    code = F.upper(F.trim("PRODUCT_ID")).alias("PRODUCT_ID")
    codes = orders.select(code).union(inventory.select(code)).distinct()
    return codes.select(
        "PRODUCT_ID",
        initcap(F.replace("PRODUCT_ID", F.lit("-"), F.lit(" "))).alias("PRODUCT_NAME"),
        starts_with_choice(F.col("PRODUCT_ID"), CATEGORY_PREFIXES, CATEGORY_DEFAULT).alias("CATEGORY"),
    )


def channel_rows(orders: DataFrame, inventory: DataFrame, customers: DataFrame) -> DataFrame:
    seen = [
        df.select(F.lower(blank_to_null(F.col(c))).alias("CHANNEL_ID"))
        for df, c in ((orders, "SOURCE"), (inventory, "SRC_SYSTEM"), (customers, "SRC_SYSTEM"))
    ]
    channels = reduce(DataFrame.union, seen).distinct().where("CHANNEL_ID IS NOT NULL")
    return channels.select(
        "CHANNEL_ID",
        initcap(F.col("CHANNEL_ID")).alias("CHANNEL_NAME"),
        equals_choice(F.col("CHANNEL_ID"), CHANNEL_TYPES, F.lit(CHANNEL_TYPE_DEFAULT)).alias("CHANNEL_TYPE"),
    )


def dim_person(customers: DataFrame, key_map: str | None = None) -> DataFrame:
    return with_surrogate(person_rows(customers), "PERSON_KEY", "PERSON_ID", key_map)


def dim_product(orders: DataFrame, inventory: DataFrame, key_map: str | None = None) -> DataFrame:
    return with_surrogate(product_rows(orders, inventory), "PRODUCT_ID", "PRODUCT_ID_KEY", key_map)


def dim_channel(
    orders: DataFrame, inventory: DataFrame, customers: DataFrame, key_map: str | None = None
) -> DataFrame:
    return with_surrogate(channel_rows(orders, inventory, customers), "CHANNEL_ID", "CHANNEL_KEY", key_map)


# --- facts and bridge --------------------------------------------------------------------


def order_measures(orders: DataFrame, exact_amounts: bool = False) -> DataFrame:
    """Order rows with quantity and amount as fixed-point numbers (whole units by default)."""
    amount = number(F.col("GROSS_AMOUNT"), 38, 2) if exact_amounts else number(F.col("GROSS_AMOUNT"))
    return orders.withColumns({"QTY": number(F.col("QTY")), "GROSS_AMOUNT": amount})


def resolve_order_keys(
    orders: DataFrame,
    persons: DataFrame | None = None,
    products: DataFrame | None = None,
    channels: DataFrame | None = None,
    **lookup_options,
) -> DataFrame:
    """Replace the keys of orders by those found in the given dimensions; NULL if absent.

    The product code is compared as it is in the order, so a code in another case or with
    blanks finds nothing; the channel is compared in lower case, not trimmed.
    """
    wanted = []
    if persons is not None:
        wanted.append(Lookup(persons, {"PERSON_KEY": F.col("PERSON_KEY")}, {"PERSON_KEY": "PERSON_KEY"}))
    if products is not None:
        wanted.append(Lookup(products, {"PRODUCT_ID": F.col("PRODUCT_ID")}, {"PRODUCT_ID": "PRODUCT_ID"}))
    if channels is not None:
        wanted.append(Lookup(channels, {"CHANNEL_ID": F.lower("SOURCE")}, {"CHANNEL_ID": "CHANNEL_ID"}))
    return lookups(orders, wanted, **lookup_options) if wanted else orders


def fact_orders(
    orders: DataFrame,
    persons: DataFrame,
    products: DataFrame,
    channels: DataFrame,
    settings: Settings,
    **lookup_options,
) -> DataFrame:
    keyed = resolve_order_keys(orders, persons, products, channels, **lookup_options)
    measured = order_measures(keyed, settings.exact_amounts)
    first = ["ORDER_TS", "ORDER_ID_SRC", "SOURCE"]
    numbered = number_rows(measured, [*first, *(c for c in measured.columns if c not in first)], "ORDER_NO")
    return numbered.select(
        F.concat(F.lit("ORD_"), zero_pad(F.col("ORDER_NO"), 6)).alias("ORDER_KEY"),
        "ORDER_ID_SRC",
        "PERSON_KEY",
        "PRODUCT_ID",
        "CHANNEL_ID",
        "ORDER_TS",
        "QTY",
        "GROSS_AMOUNT",
        "CURRENCY",
        "STATUS",
    )


def fact_inventory_snapshot(
    inventory: DataFrame,
    products: DataFrame,
    channels: DataFrame,
    settings: Settings,
    **lookup_options,
) -> DataFrame:
    now = moment(settings.as_of)
    code, source = F.upper(F.trim("PRODUCT_ID")), F.lower(F.trim("SRC_SYSTEM"))
    wanted = [
        Lookup(products, {"PRODUCT_ID": code}, {"PRODUCT_ID": "PRODUCT_ID"}),
        Lookup(channels, {"CHANNEL_ID": source}, {"CHANNEL_ID": "CHANNEL_ID"}),
    ]
    rows = lookups(inventory, wanted, **lookup_options)
    return rows.select(
        now.alias("SNAPSHOT_TS"),
        "PRODUCT_ID",
        "CHANNEL_ID",
        F.col("AVAILABLE_QTY").alias("AVAIL_QTY"),
        number(F.col("PRICE"), 10, 2).alias("PRICE"),
        "CURRENCY",
        number(seconds_between(F.col("LAST_UPDATED_UTC"), now)).alias("SYNC_DELAY_SEC"),
        "LAST_UPDATED_UTC",
        F.col("FRESHNESS_FLAG").alias("STATUS"),
        "CONFLICT_FLAG",
        "SOURCE_COVERAGE",
    )


#: Columns of the inventory snapshot that say when it was taken; the rest is its history.
TAKEN = ("SNAPSHOT_TS", "SYNC_DELAY_SEC")
_HISTORY = (
    "PRODUCT_ID string, CHANNEL_ID string, AVAIL_QTY long, PRICE decimal(10,2), CURRENCY string,"
    " LAST_UPDATED_UTC timestamp_ntz, STATUS string, CONFLICT_FLAG boolean, SOURCE_COVERAGE int"
)


def inventory_history(spark: SparkSession, path: str) -> History:
    return History(path, StructType.fromDDL(_HISTORY))


def record_inventory(history: History, snapshot: DataFrame, settings: Settings) -> None:
    history.record(snapshot.drop(*TAKEN), settings.as_of.date())


def inventory_as_of(spark: SparkSession, history: History, settings: Settings) -> DataFrame:
    """The snapshot as it was taken on the day of ``as_of``, at that time."""
    now = moment(settings.as_of)
    rows = history.as_of(spark, settings.as_of.date())
    delay = number(seconds_between(F.col("LAST_UPDATED_UTC"), now))
    dated = rows.select("*", now.alias("SNAPSHOT_TS"), delay.alias("SYNC_DELAY_SEC"))
    first = [f.split()[0] for f in _HISTORY.replace("(10,2)", "").split(", ")]
    return dated.select("SNAPSHOT_TS", *first[:5], "SYNC_DELAY_SEC", *first[5:])


def bridge_person_identity(customers: DataFrame, settings: Settings) -> DataFrame:
    return customers.select(
        "PERSON_KEY",
        "SRC_SYSTEM",
        F.col("SRC_USER_ID").alias("SRC_CUSTOMER_ID"),
        "MATCH_CONFIDENCE",
        moment(settings.as_of).alias("LOADED_AT"),
    )


def person_source_ids(records: DataFrame) -> DataFrame:
    """Every id a person has had in a source; the bridge holds the latest of each source only."""
    return records.where("SRC_USER_ID IS NOT NULL").select("PERSON_KEY", "SRC_SYSTEM", "SRC_USER_ID").distinct()
