"""Readers for the sellers' raw exports: CSV, JSON and Parquet."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.sources.corrupt import CORRUPT
from tidewell.sources.json_arrays import read_json_array


@dataclass(frozen=True)
class RawFile:
    """One export: where it lies, whom it comes from, which columns it has."""

    entity: str
    src_system: str
    path: str
    columns: tuple[str, ...] = ()  # empty: take the columns found in the file
    optional: bool = False
    multi_line: bool = False  # CSV: quoted fields may hold line breaks; such a file is one task's

    @property
    def name(self) -> str:
        return self.path.rsplit("/", 1)[-1]


#: Array files beyond this size are read by many tasks.
WHOLE_ARRAY_BYTES = 64 * 1024 * 1024

# The exports and their headers.
RAW_FILES = (
    RawFile(
        "users", "STORE", "users/users_store.csv",
        ("crm_id", "name", "tel", "email_address", "created_local", "store_code", "status", "source"),
    ),
    RawFile(
        "users", "WEBSITE", "users/users_website.csv",
        ("user_id", "email", "phone_number", "full_name", "created_at", "updated_at",
         "marketing_opt_in", "source"),
    ),
    RawFile("users", "WHATSAPP", "users/users_whatsapp.json", optional=True),
    RawFile(
        "orders", "STORE", "orders/orders_store.csv",
        ("txn_id", "time_local", "crm_id", "sku", "units", "gross_amount_aud", "status",
         "payment_method", "source"),
    ),
    RawFile(
        "orders", "WEBSITE", "orders/orders_website.csv",
        ("order_id", "order_ts", "user_id", "product_id", "qty", "total", "currency", "status", "source"),
    ),
    RawFile(
        "orders", "OTA", "orders/orders_ota.csv",
        ("bookingRef", "bookingDate", "customerEmail", "productCode", "pax", "amount", "currency",
         "bookingStatus", "source"),
    ),
    RawFile(
        "inventory", "STORE", "inventory/inventory_store.csv",
        ("sku", "stock_level", "price", "currency", "last_sync_local", "source"),
    ),
    RawFile(
        "inventory", "PARTNER", "inventory/inventory_partner.csv",
        ("partner_product_id", "product_id", "QTY_AVAILABLE", "PRICE_AUD", "LAST_PUSH_EPOCH", "source"),
    ),
    RawFile(
        "inventory", "OTA", "inventory/inventory_ota.json",
        ("productCode", "availability", "price", "currency", "lastUpdate", "source"),
    ),
)


def read_csv(
    spark: SparkSession, path: str, columns: tuple[str, ...] = (), multi_line: bool = False, stream: bool = False
) -> DataFrame:
    """All columns as text: guessing types would turn phone numbers into floats.

    A quote inside a quoted field is written twice. With declared columns, rows of another
    width come with their text in CORRUPT. ``stream``: of a folder, as files are added; needs declared columns.
    """
    reader = (spark.readStream if stream else spark.read).option("header", True).option("escape", '"').option("multiLine", multi_line)
    if columns:
        schema = ", ".join(f"`{c}` STRING" for c in (*columns, CORRUPT))
        reader = reader.schema(schema).option("enforceSchema", False).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.csv(path)


def read_json(
    spark: SparkSession, path: str, columns: tuple[str, ...] = (), lines: bool = False, stream: bool = False
) -> DataFrame:
    """Array files by default, one task each; ``lines`` for one object per line, which can be split.

    Declared columns are read as VARIANT, so ``5`` and ``"5"`` both survive as written.
    Without them every record is one VARIANT, column ``data``, and nothing is guessed. What
    does not parse comes with its text in CORRUPT. ``stream``: of a folder, as files are added.
    """
    reader = (spark.readStream if stream else spark.read).option("multiLine", not lines).option("columnNameOfCorruptRecord", CORRUPT)
    if columns:
        fields = [f"`{c}` VARIANT" for c in columns]
        return reader.schema(", ".join([*fields, f"{CORRUPT} STRING"])).json(path)
    whole = reader.option("singleVariantColumn", "data").schema(f"data VARIANT, {CORRUPT} STRING").json(path)
    is_array = F.coalesce(F.schema_of_variant("data").startswith("ARRAY"), F.lit(False))
    items = F.when(is_array, F.expr("try_variant_get(data, '$', 'array<variant>')")).otherwise(F.array("data"))
    return whole.select(F.explode_outer(items).alias("data"), CORRUPT)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _bytes_of(spark: SparkSession, path: str) -> int:
    """Size of a file, or of all files of a folder; their content is not read."""
    return spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0


def read_raw(spark: SparkSession, root: str, file: RawFile) -> DataFrame | None:
    """The rows of one export; None when an optional export is absent."""
    path = f"{root.rstrip('/')}/{file.path}"
    try:
        if file.path.endswith(".csv"):
            return read_csv(spark, path, file.columns, file.multi_line)
        if file.path.endswith(".jsonl"):
            return read_json(spark, path, file.columns, lines=True)
        if file.path.endswith(".json"):
            large = _bytes_of(spark, path) > WHOLE_ARRAY_BYTES
            return read_json_array(spark, path, file.columns) if large else read_json(spark, path, file.columns)
        return read_parquet(spark, path)
    except AnalysisException as e:
        if file.optional and e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
