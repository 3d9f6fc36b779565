"""Raw exports in the sellers' own formats, derived from the test tables.

They carry the quirks of the real files (float phones, shouting names, blank fields, five
time formats, currency inside amounts, hyphenated codes), so the whole build can run on
data that grows with the tables.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.scalars import equals_choice
from tidewell.registry.contract import Tables
from tidewell.sources.files import RAW_FILES

# Spark writes one JSON object per line, in a folder.
EXPORT_FILES = tuple(
    replace(f, path=f.path.replace(".json", ".jsonl")) if f.path.endswith(".json") else f for f in RAW_FILES
)


def _users(t: Tables, source: str) -> DataFrame:
    # joined once for the exports of all sources
    return t.stored("export_users", t.source_customers).where(F.col("SRC_SYSTEM") == source)


def users_store(t: Tables) -> DataFrame:
    return _users(t, "STORE").selectExpr(
        "concat('st_', c_custkey) AS crm_id",
        "CASE WHEN c_custkey % 2 = 0 THEN upper(c_name) ELSE c_name END AS name",
        "CASE WHEN c_custkey % 9 <> 0 THEN concat('61', lpad(c_custkey, 9, '0'), '.0') END AS tel",
        "CASE WHEN c_custkey % 13 <> 0 THEN concat('user', c_custkey div 2, '@example.com') END AS email_address",
        "CASE WHEN c_custkey % 5 = 0 THEN date_format(seen, 'yyyy-MM-dd HH:mm:ss')"
        " ELSE date_format(seen, 'dd/MM/yyyy HH:mm') END AS created_local",
        "'SYD01' AS store_code",
        "'Active' AS status",
        "CASE WHEN c_custkey % 3 = 0 THEN 'store' ELSE 'Store' END AS source",
    )


def users_website(t: Tables) -> DataFrame:
    return _users(t, "WEBSITE").selectExpr(
        "concat('web_', c_custkey) AS user_id",
        "CASE WHEN c_custkey % 17 <> 0 THEN concat(' User', c_custkey div 2, '@Example.com ') END AS email",
        "CASE WHEN c_custkey % 4 = 0 THEN concat('+61', lpad(c_custkey, 9, '0'))"
        " ELSE concat('61', lpad(c_custkey, 9, '0'), '.0') END AS phone_number",
        "CASE WHEN c_custkey % 23 <> 0 THEN c_name END AS full_name",
        "'2000-01-01 00:00:00' AS created_at",
        "CASE WHEN c_custkey % 3 = 0 THEN date_format(seen, 'yyyy-MM-dd HH:mm:ss')"
        " ELSE date_format(seen, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\") END AS updated_at",
        "'n' AS marketing_opt_in",
        "'Website' AS source",
    )


def users_whatsapp(t: Tables) -> DataFrame:
    """Its columns are declared nowhere; phones come as numbers."""
    return _users(t, "OTA").selectExpr(
        "concat('wa_', c_custkey) AS wa_id",
        "lower(c_name) AS name",
        "CASE WHEN c_custkey % 7 <> 0 THEN 61000000000 + c_custkey END AS phone",
        "date_format(seen, 'yyyy-MM-dd HH:mm:ss') AS last_seen",
    )


def _orders(t: Tables, source: str) -> DataFrame:
    return t.stored("export_orders", lambda: _all_orders(t)).where(F.col("SOURCE") == source)


def _all_orders(t: Tables) -> DataFrame:
    """Orders with what the exports of their sources need, joined once for all of them."""
    return (
        t.orders()
        .join(
            t.read("orders").selectExpr("CAST(o_orderkey AS STRING) AS ORDER_ID_SRC", "o_orderkey", "o_custkey"),
            "ORDER_ID_SRC",
        )
        .selectExpr(
            "*",
            # minutes spread the day; codes come in about fifty
            "ORDER_TS + make_dt_interval(0, 0, CAST(o_orderkey % 1440 AS INT)) AS at",
            "CAST(regexp_extract(PRODUCT_ID, '([0-9]+)', 1) AS INT) % 50 AS code",
        )
    )


def orders_store(t: Tables) -> DataFrame:
    return _orders(t, "STORE").selectExpr(
        "concat('S-', ORDER_ID_SRC) AS txn_id",
        "date_format(at, 'dd/MM/yyyy HH:mm') AS time_local",
        "concat('st_', o_custkey) AS crm_id",
        "concat('K', lpad(code, 3, '0')) AS sku",
        "QTY AS units",
        "GROSS_AMOUNT AS gross_amount_aud",
        "CASE WHEN STATUS = 'paid' THEN 'PAID' ELSE 'VOID' END AS status",
        "'card' AS payment_method",
        "'Store' AS source",
    )


def orders_website(t: Tables) -> DataFrame:
    return _orders(t, "WEBSITE").selectExpr(
        "concat('W-', ORDER_ID_SRC) AS order_id",
        "date_format(at, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\") AS order_ts",
        "concat('web_', o_custkey) AS user_id",
        "concat('K', lpad(code, 3, '0')) AS product_id",
        "QTY AS qty",
        "GROSS_AMOUNT AS total",
        "CURRENCY AS currency",
        "CASE WHEN STATUS = 'paid' THEN 'Completed' ELSE 'Cancelled' END AS status",
        "'Website' AS source",
    )


def orders_ota(t: Tables) -> DataFrame:
    return _orders(t, "OTA").selectExpr(
        "concat('O-', ORDER_ID_SRC) AS bookingRef",
        "concat(date_format(at, \"yyyy-MM-dd'T'HH:mm:ss\"), '+00:00+11:00') AS bookingDate",
        "CASE WHEN o_custkey % 19 = 0 THEN concat('ghost', o_custkey, '@example.com')"
        " ELSE concat(' USER', o_custkey div 2, '@example.com ') END AS customerEmail",
        "concat('k-', lpad(code, 3, '0')) AS productCode",
        "QTY AS pax",
        "CASE WHEN o_custkey % 3 = 0 THEN concat('HKD ', GROSS_AMOUNT)"
        " WHEN o_custkey % 3 = 1 THEN concat('AUD ', GROSS_AMOUNT) ELSE CAST(GROSS_AMOUNT AS STRING) END AS amount",
        "'AUD' AS currency",
        "CASE WHEN STATUS = 'paid' THEN 'Success' ELSE 'Refund' END AS bookingStatus",
        "'OTA' AS source",
    )


# Every event type is stock of one source; types not named are OTA stock.
STOCK_OF_EVENT = {"purchase": "STORE", "signup": "PARTNER"}


def _stock(t: Tables, source: str) -> DataFrame:
    return (
        t.read("events")
        .where(equals_choice(F.col("event_type"), STOCK_OF_EVENT, F.lit("OTA")) == source)
        .selectExpr(
            "event_id",
            "ts",
            "user_id % 10 AS stock",
            "CAST(get_json_object(props, '$.k') AS INT) % 50 AS code",
            "CAST(CAST(value AS DECIMAL(18, 2)) AS STRING) AS amount",
        )
    )


def inventory_store(t: Tables) -> DataFrame:
    return _stock(t, "STORE").selectExpr(
        "concat('K', lpad(code, 3, '0')) AS sku",
        "stock AS stock_level",
        "amount AS price",
        "'AUD' AS currency",
        "date_format(ts, 'dd/MM/yyyy HH:mm') AS last_sync_local",
        "'Store' AS source",
    )


def inventory_partner(t: Tables) -> DataFrame:
    return _stock(t, "PARTNER").selectExpr(
        "concat('P', event_id) AS partner_product_id",
        "concat('K', lpad(code, 3, '0')) AS product_id",
        "stock AS QTY_AVAILABLE",
        "concat('A$', amount) AS PRICE_AUD",
        "unix_seconds(CAST(ts AS TIMESTAMP)) AS LAST_PUSH_EPOCH",
        "'Partner' AS source",
    )


def inventory_ota(t: Tables) -> DataFrame:
    return _stock(t, "OTA").selectExpr(
        "concat('K-', lpad(code, 3, '0')) AS productCode",
        "stock",
        "event_id",
        "CASE WHEN event_id % 2 = 0 THEN concat('$', amount) ELSE amount END AS price",
        "CASE WHEN event_id % 3 = 0 THEN 'aud' ELSE 'AUD' END AS currency",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\") AS lastUpdate",
        "'OTA' AS source",
    ).selectExpr(
        "productCode",
        # a number in some rows, a text in others
        "CASE WHEN event_id % 2 = 0 THEN parse_json(CAST(stock AS STRING))"
        " ELSE parse_json(concat('\"', stock, '\"')) END AS availability",
        "price",
        "currency",
        "lastUpdate",
        "source",
    )


_EXPORTS = {
    "users/users_store.csv": users_store,
    "users/users_website.csv": users_website,
    "users/users_whatsapp.jsonl": users_whatsapp,
    "orders/orders_store.csv": orders_store,
    "orders/orders_website.csv": orders_website,
    "orders/orders_ota.csv": orders_ota,
    "inventory/inventory_store.csv": inventory_store,
    "inventory/inventory_partner.csv": inventory_partner,
    "inventory/inventory_ota.jsonl": inventory_ota,
}


def write_exports(t: Tables, root: str) -> str:
    for path, make in _EXPORTS.items():
        writer = make(t).write.mode("overwrite")
        if path.endswith(".csv"):
            writer.option("header", True).csv(f"{root}/{path}")
        else:
            writer.json(f"{root}/{path}")
    return root
