"""The dashboard queries over silver and gold frames.

Sorting follows the original rules: NULL counts as largest, so it comes last ascending and
first descending. Tie-breaks are added, which also keeps a sort from putting all rows with
one leading value into one partition.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.scalars import (
    days_between,
    day,
    greatest_or_null,
    iso_weekday,
    moment,
    ratio,
    start_of_day,
    timestamp_text,
    weekday_label,
)
from tidewell.operators.lookup import Lookup, lookups
from tidewell.plans.silver import freshness
from tidewell.session import stage
from tidewell.settings import FRESHNESS_LABELS, RECENCY_BEYOND, RECENCY_BUCKETS

WINDOW_DAYS = 30
TOP_K = 10


def _distinct(name: str, approximate: bool) -> Column:
    return F.approx_count_distinct(name) if approximate else F.count_distinct(name)


def _share_lost(raw: Column, unified: Column) -> Column:
    return ratio(100 * (raw - unified), raw)


# --- customers ---------------------------------------------------------------------------


def dedup_rate(bridge: DataFrame, persons: DataFrame, approximate: bool = False) -> DataFrame:
    """Source customers against unified people; equal ids of two sources count once."""
    none = F.lit(None).cast("bigint")
    raw = bridge.agg(_distinct("SRC_CUSTOMER_ID", approximate).alias("raw_customers"), none.alias("unified_customers"))
    unified = persons.agg(none.alias("raw_customers"), _distinct("PERSON_KEY", approximate).alias("unified_customers"))
    n, u = F.col("raw_customers"), F.col("unified_customers")
    both = raw.union(unified).agg(F.max(n).alias("raw_customers"), F.max(u).alias("unified_customers"))
    return both.withColumn(
        "dedup_rate_pct", F.when(n == 0, F.lit(0).cast("decimal(18,2)")).otherwise(_share_lost(n, u))
    )


def customers_per_channel(bridge: DataFrame, approximate: bool = False) -> DataFrame:
    return (
        bridge.groupBy(F.lower("SRC_SYSTEM").alias("channel"))
        .agg(_distinct("PERSON_KEY", approximate).alias("unique_customers"))
        .orderBy(F.desc_nulls_first("unique_customers"), F.asc_nulls_last("channel"))
    )


def customers_per_source(customers: DataFrame) -> DataFrame:
    return customers.groupBy(F.col("SRC_SYSTEM").alias("src_system")).agg(
        F.count("*").alias("unified_customers")
    )


def dedup_rate_by_source(raw_users: DataFrame, customers: DataFrame) -> DataFrame:
    """Landing rows against unified rows per source; a source without the latter keeps NULLs."""
    raw = raw_users.groupBy("src_system").agg(F.count("*").alias("raw_customers"))
    n, u = F.col("raw_customers"), F.col("unified_customers")
    return (
        raw.join(customers_per_source(customers), "src_system", "left")
        .withColumn("dedup_rate_pct", _share_lost(n, u))
        .orderBy(F.asc_nulls_last("src_system"))
    )


def recency_buckets(persons: DataFrame, as_of: datetime) -> DataFrame:
    """People by days since last seen; times in the future count as recent."""
    age = days_between(F.col("LAST_SEEN_TS"), day(as_of))
    bucket, rank = None, None
    for i, (limit, label) in enumerate(RECENCY_BUCKETS):
        test = age <= limit
        bucket = F.when(test, label) if bucket is None else bucket.when(test, label)
        is_label = F.col("active_bucket") == label
        rank = F.when(is_label, i) if rank is None else rank.when(is_label, i)
    return (
        persons.where("LAST_SEEN_TS IS NOT NULL")
        .groupBy(bucket.otherwise(RECENCY_BEYOND).alias("active_bucket"))
        .agg(F.count("*").alias("customer_count"))
        .orderBy(rank.otherwise(len(RECENCY_BUCKETS)))
    )


def users_by_locale(persons: DataFrame) -> DataFrame:
    return (
        persons.groupBy("LOCALE")
        .agg(F.count("*").alias("users"))
        .orderBy(F.desc_nulls_first("users"), F.asc_nulls_last("LOCALE"))
    )


# --- inventory ---------------------------------------------------------------------------


def inventory_detail(
    snapshot: DataFrame, products: DataFrame, channels: DataFrame, as_of: datetime, **lookup_options
) -> DataFrame:
    names = {"P_ID": "PRODUCT_ID", "PRODUCT_NAME": "PRODUCT_NAME", "CATEGORY": "CATEGORY"}
    wanted = [
        Lookup(products, {"PRODUCT_ID": F.col("PRODUCT_ID")}, names),
        Lookup(channels, {"CHANNEL_ID": F.col("CHANNEL_ID")}, {"SOURCE_CHANNEL": "CHANNEL_NAME"}),
    ]
    rows = lookups(snapshot, wanted, **lookup_options)
    updated = F.col("LAST_UPDATED_UTC")
    return rows.select(
        F.col("P_ID").alias("PRODUCT_ID"),
        "PRODUCT_NAME",
        "CATEGORY",
        "SOURCE_CHANNEL",
        "AVAIL_QTY",
        "PRICE",
        "CURRENCY",
        ratio(F.col("SYNC_DELAY_SEC"), F.lit(3600)).alias("SYNC_DELAY_HOURS"),
        freshness(updated, moment(as_of), ("Fresh", "Stale", "Expired")).alias("FRESHNESS_STATUS"),
        timestamp_text(updated).alias("LAST_UPDATED_UTC"),
        timestamp_text(F.col("SNAPSHOT_TS")).alias("SNAPSHOT_TS"),
    ).orderBy(
        *[F.asc_nulls_last(c) for c in ("PRODUCT_ID", "SOURCE_CHANNEL", "LAST_UPDATED_UTC", "AVAIL_QTY", "PRICE")]
    )


def freshness_distribution(
    snapshot: DataFrame, as_of: datetime, floors: dict[str, int] | None = None
) -> DataFrame:
    """Rows per age class with share of all, every class present.

    ``floors`` lifts small counts to a minimum, as the old chart did (``FRESHNESS_FLOORS``);
    without it, and for classes it does not name, the counts are the true ones.
    """
    floors = floors or {}
    labels = FRESHNESS_LABELS
    found = snapshot.groupBy(
        freshness(F.col("LAST_UPDATED_UTC"), moment(as_of), labels).alias("freshness_status")
    ).agg(F.count("*").alias("found"))
    # back to one row, a column per class: missing classes and the total come for free
    wide = found.agg(
        *[F.sum(F.when(F.col("freshness_status") == c, F.col("found"))).alias(c) for c in labels]
    ).select(*[greatest_or_null(F.coalesce(c, F.lit(0)), F.lit(floors.get(c, 0))).alias(c) for c in labels])
    pairs = ", ".join(f"{i}, '{c}', {c}" for i, c in enumerate(labels))
    long = wide.selectExpr(
        " + ".join(labels) + " AS total", f"stack({len(labels)}, {pairs}) AS (rank, freshness_status, record_count)"
    )
    return long.orderBy("rank").select(
        "freshness_status",
        "record_count",
        ratio(100 * F.col("record_count"), F.col("total")).alias("percentage"),
    )


# --- orders ------------------------------------------------------------------------------


def _recent(fact: DataFrame, as_of: datetime) -> DataFrame:
    """The last 30 days; later orders pass. Skips month folders where the fact has them."""
    first_day = F.date_sub(day(as_of), WINDOW_DAYS)
    if "ORDER_MONTH" in fact.columns:
        fact = fact.where(F.col("ORDER_MONTH") >= F.trunc(first_day, "MM"))
    return fact.where(F.col("ORDER_TS") >= first_day.cast("timestamp_ntz"))


def _recent_paid(fact: DataFrame, as_of: datetime) -> DataFrame:
    return _recent(fact, as_of).where(F.col("STATUS") == "paid")


def daily_revenue(fact: DataFrame, as_of: datetime) -> DataFrame:
    return (
        _recent_paid(fact, as_of)
        .groupBy(start_of_day(F.col("ORDER_TS")).alias("order_day"))
        .agg(F.count("*").alias("total_orders"), F.sum("GROSS_AMOUNT").alias("revenue_aud"))
        .withColumn("aov_aud", ratio(F.col("revenue_aud"), F.col("total_orders")))
        .orderBy(F.asc_nulls_last("order_day"))
    )


def daily_orders_by_channel(fact: DataFrame, as_of: datetime) -> DataFrame:
    return (
        _recent_paid(fact, as_of)
        .groupBy(start_of_day(F.col("ORDER_TS")).alias("order_day"), F.col("CHANNEL_ID").alias("channel"))
        .agg(F.count("*").alias("orders"))
        .orderBy(F.asc_nulls_last("order_day"), F.asc_nulls_last("channel"))
    )


def top_products(fact: DataFrame, as_of: datetime, k: int = TOP_K) -> DataFrame:
    return (
        _recent_paid(fact, as_of)
        .groupBy("PRODUCT_ID")
        .agg(F.count("*").alias("orders"), F.sum("GROSS_AMOUNT").alias("revenue_aud"))
        .orderBy(F.desc_nulls_first("revenue_aud"), F.asc_nulls_last("PRODUCT_ID"))
        .limit(k)
    )


def status_mix(fact: DataFrame, as_of: datetime) -> DataFrame:
    return (
        _recent(fact, as_of)
        .groupBy("STATUS")
        .agg(F.count("*").alias("orders"))
        .orderBy(F.desc_nulls_first("orders"), F.asc_nulls_last("STATUS"))
    )


def hour_dow_heatmap(fact: DataFrame, as_of: datetime) -> DataFrame:
    ts = F.col("ORDER_TS")
    return (
        _recent_paid(fact, as_of)
        .groupBy(
            iso_weekday(ts).alias("dow_iso"),
            weekday_label(ts).alias("dow_label"),
            F.hour(ts).alias("hour_of_day"),
        )
        .agg(F.count("*").alias("orders"))
        .orderBy("dow_iso", "hour_of_day")
    )


def recent_orders(
    fact: DataFrame, persons: DataFrame, products: DataFrame, k: int = TOP_K, **lookup_options
) -> DataFrame:
    """The ``k`` newest orders whose customer and product are known, with their names.

    The newest orders that have both keys are looked up first, a few more than asked for.
    When enough of them find their dimension rows these are the answer, since every other
    order is older; otherwise all orders are looked up.
    """

    person_key, product_id = F.col("PERSON_KEY"), F.col("PRODUCT_ID")
    wanted = [
        Lookup(persons, {"PERSON_KEY": person_key}, {"FULL_NAME": "FULL_NAME"}, "inner"),
        Lookup(products, {"PRODUCT_ID": product_id}, {"PRODUCT_NAME": "PRODUCT_NAME"}, "inner"),
    ]

    def named(orders: DataFrame) -> DataFrame:
        return lookups(orders, wanted, **lookup_options)

    # the last columns make the cut total: rows that agree in all of them look the same
    newest = [F.desc_nulls_first(c) for c in ("ORDER_TS", "ORDER_ID_SRC", "PERSON_KEY", "PRODUCT_ID", "GROSS_AMOUNT")]
    keyed = fact.where("PERSON_KEY IS NOT NULL AND PRODUCT_ID IS NOT NULL").select(
        "ORDER_TS", "ORDER_ID_SRC", "PERSON_KEY", "PRODUCT_ID", "GROSS_AMOUNT"
    )
    first = stage(named(stage(keyed.orderBy(*newest).limit(10 * k), "newest-orders")), "named-orders")
    found = first if first.count() >= k else named(keyed)
    return (
        found.orderBy(*newest)
        .limit(k)
        .select("ORDER_TS", "FULL_NAME", "PRODUCT_NAME", "GROSS_AMOUNT")
    )
