"""The silver contracts expressed over the test tables (orders, lineitem, customer, events ...)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tidewell.functions.scalars import equals_choice
from tidewell.plans import gold, silver
from tidewell.session import stage, use_utc
from tidewell.settings import Settings

ORDERS_AS_OF = datetime(2001, 8, 2)
EVENTS_AS_OF = datetime(2024, 1, 30, 23, 58)
EVENT_ORDERS_AS_OF = datetime(2024, 1, 31)

SOURCE_OF_PRIORITY = {
    "1-URGENT": "WEBSITE",
    "2-HIGH": "WEBSITE",
    "3-MEDIUM": "STORE",
    "4-NOT SPECIFIED": "STORE",
    "5-LOW": "OTA",
}
SOURCE_OF_EVENT = {"click": "website", "view": "ota", "purchase": "store", "signup": "partner"}
STATUS_OF_ORDER = {"F": "paid", "O": "cancelled", "P": "refunded"}

_stored: dict[tuple[str, str, str], DataFrame] = {}


def half(key: str) -> Column:
    return F.expr(f"{key} div 2")


def product_of_part(part: Column) -> Column:
    """Codes of three families; every seventh is written in lower case with blanks around."""
    family = F.when(part % 10 == 0, "SYD-").when(part % 10 == 1, "TAS-").otherwise("K-")
    code = F.concat(family, part.cast("string"))
    return F.when(part % 7 == 0, F.concat(F.lit(" "), F.lower(code), F.lit(" "))).otherwise(code)


class Tables:
    """Lazy contract frames over one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = use_utc(spark)
        self.folder = folder.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def stored(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A frame several queries of this session share, written once."""
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _stored:
            _stored[key] = stage(make(), name)
        return _stored[key]

    # --- silver contracts ----------------------------------------------------------------

    def source_customers(self) -> DataFrame:
        """Who ordered through which source, and when last: one row per source and customer."""
        source = equals_choice(F.col("o_orderpriority"), SOURCE_OF_PRIORITY, F.lit(None))
        seen = (
            self.read("orders")
            .groupBy(source.alias("SRC_SYSTEM"), F.col("o_custkey").alias("c_custkey"))
            .agg(F.max("o_orderdate").alias("seen"))
        )
        nation = self.read("nation").withColumnRenamed("n_nationkey", "c_nationkey")
        return seen.join(self.read("customer"), "c_custkey").join(nation, "c_nationkey")

    def customers(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.source_customers().select(
            F.concat(F.lit("P"), half("c_custkey").cast("string")).alias("PERSON_KEY"),
            F.col("c_name").alias("FULL_NAME"),
            F.when(key % 13 == 0, "")
            .otherwise(F.concat(F.lit(" "), F.col("c_name"), F.lit("@Example.com ")))
            .alias("EMAIL"),
            F.concat(F.lit("+61 "), key.cast("string")).alias("PHONE"),
            F.col("n_name").alias("LOCALE"),
            "SRC_SYSTEM",
            F.concat_ws("_", "SRC_SYSTEM", key.cast("string")).alias("SRC_USER_ID"),
            F.when(key % 11 != 0, F.col("seen")).alias("LAST_SEEN_UTC"),
            F.when(key % 13 == 0, 0.8).otherwise(1.0).cast(DecimalType(3, 2)).alias("MATCH_CONFIDENCE"),
        )

    def orders(self) -> DataFrame:
        lines = (
            self.read("lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(F.min("l_partkey").alias("part"), F.sum("l_quantity").alias("qty"))
        )
        key = F.col("o_custkey")
        return (
            self.read("orders")
            .join(lines, "o_orderkey", "left")
            .select(
                F.col("o_orderkey").cast("string").alias("ORDER_ID_SRC"),
                equals_choice(F.col("o_orderpriority"), SOURCE_OF_PRIORITY, F.lit(None)).alias("SOURCE"),
                F.col("o_orderdate").alias("ORDER_TS"),
                F.when(key % 19 != 0, F.concat(F.lit("P"), half("o_custkey").cast("string"))).alias(
                    "PERSON_KEY"
                ),
                product_of_part(F.col("part")).alias("PRODUCT_ID"),
                F.col("qty").cast("bigint").alias("QTY"),
                F.col("o_totalprice").cast(DecimalType(18, 2)).alias("GROSS_AMOUNT"),
                F.when(key % 17 == 0, "HKY").when(key % 13 == 0, "CNY").otherwise("AUD").alias("CURRENCY"),
                equals_choice(F.col("o_orderstatus"), STATUS_OF_ORDER, F.lit(None)).alias("STATUS"),
            )
        )

    def stock(self) -> DataFrame:
        """Inventory rows before the newest per product and source is chosen."""
        k = F.get_json_object("props", "$.k").cast("int")
        return self.read("events").select(
            F.concat(F.lit("K-"), k.cast("string")).alias("PRODUCT_ID"),
            k.cast("bigint").alias("AVAILABLE_QTY"),
            F.col("value").cast(DecimalType(18, 2)).alias("PRICE"),
            F.lit("AUD").alias("CURRENCY"),
            F.col("ts").alias("LAST_UPDATED_UTC"),
            equals_choice(F.col("event_type"), SOURCE_OF_EVENT, F.lit(None)).alias("SRC_SYSTEM"),
            F.col("event_id").alias("ROW_ID"),
        )

    def inventory(self, settings: Settings | None = None) -> DataFrame:
        return silver.unify_inventory(self.stock(), settings or self.stock_settings())

    def event_orders(self) -> DataFrame:
        """Events seen as orders: unlike the orders table they have a time of day."""
        return self.read("events").select(
            F.col("ts").alias("ORDER_TS"),
            F.when(F.col("event_type") == "purchase", "paid").otherwise("other").alias("STATUS"),
        )

    @staticmethod
    def order_settings(**changes) -> Settings:
        return Settings(as_of=ORDERS_AS_OF, **changes)

    @staticmethod
    def stock_settings(**changes) -> Settings:
        return Settings(as_of=EVENTS_AS_OF, **{"price_tolerance": 300.0, **changes})

    # --- gold ----------------------------------------------------------------------------

    def silver_inventory(self) -> DataFrame:
        return self.stored("vw_inventory_unified", self.inventory)

    def silver_orders(self) -> DataFrame:
        return self.stored("vw_orders_clean", self.orders)

    def silver_customers(self) -> DataFrame:
        return self.stored("vw_customer_unified", self.customers)

    def persons(self) -> DataFrame:
        return self.stored("person_rows", lambda: gold.person_rows(self.silver_customers()))

    def products(self) -> DataFrame:
        return self.stored(
            "product_rows", lambda: gold.product_rows(self.silver_orders(), self.silver_inventory())
        )

    def channels(self) -> DataFrame:
        return self.stored(
            "channel_rows",
            lambda: gold.channel_rows(self.silver_orders(), self.silver_inventory(), self.silver_customers()),
        )

    def keyed_orders(self, *dims: str) -> DataFrame:
        """Order measures with the keys found in the named dimensions."""
        found = {d: getattr(self, d)() for d in dims}
        orders = self.silver_orders() if dims else self.orders()
        return gold.order_measures(gold.resolve_order_keys(orders, **found))

    def snapshot(self) -> DataFrame:
        return gold.fact_inventory_snapshot(
            self.silver_inventory(), self.products(), self.channels(), self.stock_settings()
        )
