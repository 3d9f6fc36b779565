"""Silver: cleaned customers, orders and inventory from the landing frames.

Output columns are the contract the gold layer reads; any frame with these columns will do
in place of the ones built here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions import parsing
from tidewell.functions.scalars import (
    latest_first,
    moment,
    seconds_between,
)
from tidewell.operators.identity import one_pass_key, transitive_keys
from tidewell.operators.latest import first_per_key
from tidewell.operators.lookup import lookup
from tidewell.session import stage
from tidewell.settings import FRESH_BELOW_SECONDS, STALE_UP_TO_SECONDS, Settings
from tidewell.sources.landing import field

CUSTOMER_COLUMNS = (
    "PERSON_KEY", "FULL_NAME", "EMAIL", "PHONE", "LOCALE", "SRC_SYSTEM", "SRC_USER_ID",
    "LAST_SEEN_UTC", "MATCH_CONFIDENCE",
)
ORDER_COLUMNS = (
    "ORDER_ID_SRC", "SOURCE", "ORDER_TS", "PERSON_KEY", "PRODUCT_ID", "QTY", "GROSS_AMOUNT",
    "CURRENCY", "STATUS",
)
INVENTORY_COLUMNS = (
    "PRODUCT_ID", "AVAILABLE_QTY", "PRICE", "CURRENCY", "LAST_UPDATED_UTC", "SRC_SYSTEM",
    "FRESHNESS_FLAG", "CONFLICT_FLAG", "SOURCE_COVERAGE",
)


def _source_time(text: Column, settings: Settings) -> Column:
    """Parse times, reading zone-less ones in the zone set for their source."""
    parsed = parsing.utc_time(text)
    for source, zone in settings.local_zones.items():
        parsed = F.when(F.col("src_system") == source, parsing.utc_time(text, zone)).otherwise(parsed)
    return parsed


# --- customers ---------------------------------------------------------------------------


def customer_records(raw_users: DataFrame, settings: Settings) -> DataFrame:
    """One cleaned row per source record, with its person key."""
    fields = raw_users.select(
        "src_system",
        field("crm_id", "user_id", "wa_id").alias("id"),
        field("name", "full_name").alias("name"),
        field("email_address", "email").alias("email"),
        field("tel", "phone_number", "phone").alias("phone"),
        field("updated_at", "created_local", "last_seen", "created_at").alias("seen"),
        F.to_json("data").alias("record"),
    )
    cleaned = fields.select(
        parsing.person_name(F.col("name")).alias("FULL_NAME"),
        parsing.email(F.col("email")).alias("EMAIL"),
        parsing.phone(F.col("phone")).alias("PHONE"),
        F.col("src_system").alias("SRC_SYSTEM"),
        F.col("id").alias("SRC_USER_ID"),
        _source_time(F.col("seen"), settings).alias("LAST_SEEN_UTC"),
        # a record that names nobody is a person of its own; only its exact copies join it
        F.when(F.col("id").isNull(), F.sha2("record", 256)).alias("RECORD"),
    )
    records = cleaned.withColumns(
        {
            "LOCALE": parsing.locale(F.col("PHONE")),
            "MATCH_CONFIDENCE": parsing.match_confidence(F.col("EMAIL"), F.col("PHONE")),
        }
    )
    if settings.identity_mode == "transitive":
        keyed = transitive_keys(records, record="RECORD")
    else:
        keyed = records.withColumn(
            "PERSON_KEY",
            one_pass_key(
                F.col("EMAIL"), F.col("PHONE"), F.col("SRC_SYSTEM"), F.col("SRC_USER_ID"), F.col("RECORD")
            ),
        )
    return keyed.select(*CUSTOMER_COLUMNS)


def unify_customers(records: DataFrame, settings: Settings) -> DataFrame:
    """One row per person and source, the latest record; or every record."""
    if settings.customer_grain == "record":
        return records
    # every column takes part, so equal input gives equal rows in whatever order it comes
    newest = latest_first(
        F.col("LAST_SEEN_UTC"), *(F.col(c) for c in ("SRC_USER_ID", "FULL_NAME", "EMAIL", "PHONE", "MATCH_CONFIDENCE"))
    )
    return first_per_key(records, ["PERSON_KEY", "SRC_SYSTEM"], newest)


# --- orders ------------------------------------------------------------------------------


def parsed_orders(raw_orders: DataFrame, settings: Settings) -> DataFrame:
    """Cleaned order rows, still carrying the customer reference of their source."""
    fields = raw_orders.select(
        F.col("src_system"),
        field("txn_id", "order_id", "bookingRef").alias("id"),
        field("time_local", "order_ts", "bookingDate").alias("time"),
        field("customerEmail").alias("email"),
        field("crm_id", "user_id").alias("customer"),
        field("sku", "product_id", "productCode").alias("product"),
        field("units", "qty", "pax").alias("qty"),
        field("gross_amount_aud", "total", "amount").alias("amount"),
        parsing.currency(field("currency"), settings.default_currency).alias("code"),
        field("status", "bookingStatus").alias("status"),
    )
    amount, time = F.col("amount"), F.col("time")
    return fields.select(
        F.col("id").alias("ORDER_ID_SRC"),
        F.col("src_system").alias("SOURCE"),
        _source_time(time, settings).alias("ORDER_TS"),
        parsing.time_is_ambiguous(time).alias("TS_AMBIGUOUS"),
        F.when(F.col("src_system") == "OTA", parsing.email(F.col("email")))
        .otherwise(F.col("customer"))
        .alias("CUSTOMER_REF"),
        parsing.product_code(F.col("product"), settings.keep_hyphen).alias("PRODUCT_ID"),
        F.col("qty").try_cast("bigint").alias("QTY"),
        parsing.money(amount).alias("GROSS_AMOUNT"),
        F.col("code").alias("CURRENCY"),
        parsing.currency_in_amount(amount).alias("CURRENCY_IN_AMOUNT"),
        parsing.currency_mismatch(amount, F.col("code")).alias("CURRENCY_MISMATCH"),
        parsing.order_status(F.col("status")).alias("STATUS"),
    )


def customer_references(records: DataFrame) -> DataFrame:
    """What an order may name its customer by, per order source: unique (SOURCE, REF).

    A reference that several persons have had goes to the one seen last.
    """
    by_id = records.select(
        F.col("SRC_SYSTEM").alias("SOURCE"), F.col("SRC_USER_ID").alias("REF"), "PERSON_KEY", "LAST_SEEN_UTC"
    )
    by_email = records.select(
        F.lit("OTA").alias("SOURCE"), F.col("EMAIL").alias("REF"), "PERSON_KEY", "LAST_SEEN_UTC"
    )
    return (
        by_id.where("SOURCE <> 'OTA'")
        .unionByName(by_email)
        .where("REF IS NOT NULL")
        .groupBy("SOURCE", "REF")
        .agg(F.min_by("PERSON_KEY", latest_first(F.col("LAST_SEEN_UTC"), F.col("PERSON_KEY"))).alias("PERSON_KEY"))
    )


def clean_orders(parsed: DataFrame, references: DataFrame, **lookup_options) -> DataFrame:
    """Orders with the person they belong to; NULL when the reference is unknown."""
    found = lookup(
        parsed,
        references,
        {"SOURCE": F.col("SOURCE"), "REF": F.col("CUSTOMER_REF")},
        {"PERSON_KEY": "PERSON_KEY"},
        **lookup_options,
    )
    return found.select(*ORDER_COLUMNS)


# --- inventory ---------------------------------------------------------------------------


def parsed_inventory(raw_inventory: DataFrame, settings: Settings) -> DataFrame:
    fields = raw_inventory.select(
        F.col("src_system"),
        field("sku", "product_id", "productCode").alias("product"),
        field("stock_level", "QTY_AVAILABLE", "availability").alias("qty"),
        field("price", "PRICE_AUD").alias("price"),
        field("currency").alias("code"),
        field("last_sync_local", "lastUpdate", "LAST_PUSH_EPOCH").alias("updated"),
        field("partner_product_id").alias("row_id"),
    )
    return fields.select(
        parsing.product_code(F.col("product"), settings.keep_hyphen).alias("PRODUCT_ID"),
        F.col("qty").try_cast("bigint").alias("AVAILABLE_QTY"),
        parsing.money(F.col("price")).alias("PRICE"),
        parsing.currency(F.col("code"), settings.default_currency).alias("CURRENCY"),
        _source_time(F.col("updated"), settings).alias("LAST_UPDATED_UTC"),
        F.col("src_system").alias("SRC_SYSTEM"),
        F.col("row_id").alias("ROW_ID"),
    )


def latest_inventory(parsed: DataFrame) -> DataFrame:
    """Newest row per product and source. Equal times: smallest row id, quantity, price."""
    newest = latest_first(
        F.col("LAST_UPDATED_UTC"), F.col("ROW_ID"), F.col("AVAILABLE_QTY"), F.col("PRICE")
    )
    return first_per_key(parsed, ["PRODUCT_ID", "SRC_SYSTEM"], newest)


def freshness(updated: Column, now: Column, labels: tuple[str, str, str]) -> Column:
    """Age class of a row; a missing time counts as expired, a future one as fresh."""
    age = seconds_between(updated, now)
    fresh, stale, expired = labels
    return (
        F.when(age < FRESH_BELOW_SECONDS, fresh).when(age <= STALE_UP_TO_SECONDS, stale).otherwise(expired)
    )


def _conflict(low_qty: Column, high_qty: Column, low_price: Column, high_price: Column, tolerance: float):
    return F.coalesce(low_qty != high_qty, F.lit(False)) | F.coalesce(
        (high_price - low_price) > F.lit(tolerance).cast("decimal(18,2)"), F.lit(False)
    )


def unify_inventory(parsed: DataFrame, settings: Settings) -> DataFrame:
    """Inventory rows with freshness, cross-source conflict and source coverage."""
    latest = latest_inventory(parsed)
    qty, price = F.col("AVAILABLE_QTY"), F.col("PRICE")
    if settings.inventory_grain == "latest":
        # one row per source is left of each product, so these groups stay tiny
        product = Window.partitionBy("PRODUCT_ID")
        rows = latest.select(
            "*",
            _conflict(
                F.min(qty).over(product),
                F.max(qty).over(product),
                F.min(price).over(product),
                F.max(price).over(product),
                settings.price_tolerance,
            ).alias("CONFLICT_FLAG"),
            F.count("SRC_SYSTEM").over(product).cast("int").alias("SOURCE_COVERAGE"),
        )
    else:
        code = F.coalesce(F.concat(F.lit("="), "PRODUCT_ID"), F.lit(""))  # keeps NULL joinable
        per_product = latest.groupBy(code.alias("CODE")).agg(
            _conflict(F.min(qty), F.max(qty), F.min(price), F.max(price), settings.price_tolerance).alias(
                "CONFLICT_FLAG"
            ),
            F.count_distinct("SRC_SYSTEM").cast("int").alias("SOURCE_COVERAGE"),
        )
        rows = lookup(
            parsed,
            stage(per_product, "per-product"),  # its size is measured before the join reads it
            {"CODE": code},
            {"CONFLICT_FLAG": "CONFLICT_FLAG", "SOURCE_COVERAGE": "SOURCE_COVERAGE"},
        )
    flag = freshness(F.col("LAST_UPDATED_UTC"), moment(settings.as_of), ("fresh", "stale", "expired"))
    return rows.withColumn("FRESHNESS_FLAG", flag).select(*INVENTORY_COLUMNS)

