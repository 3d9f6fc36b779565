"""One callable per query: (spark, folder of the test tables) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.functions import parsing, scalars
from tidewell.operators import quality, rollups
from tidewell.operators.identity import one_pass_key, transitive_keys
from tidewell.operators.identity_store import IdentityStore
from tidewell.operators.numbering import number_rows
from tidewell.operators.rollups import OrderRollup
from tidewell.operators.sketches import add_sketches, distinct_estimates, error_bound
from tidewell.plans import gold, marts, pipeline, silver, stock_state, streaming
from tidewell.registry.contract import (
    EVENT_ORDERS_AS_OF,
    EVENTS_AS_OF,
    ORDERS_AS_OF,
    Tables,
)
from tidewell.registry.raw_exports import EXPORT_FILES, write_exports
from tidewell.session import shared_folder, stage
from tidewell.settings import FRESHNESS_FLOORS, Settings
from tidewell.sources.bucketed import bucketed_refresh
from tidewell.sources.files import CORRUPT, RawFile, read_csv, read_json
from tidewell.sources.gate import Gate, QualityError, gated_refresh
from tidewell.sources.json_arrays import read_json_array
from tidewell.sources.landing import append_all, field, land, land_entity
from tidewell.sources.sinks import append_snapshot, full_refresh

Query = Callable[[SparkSession, str], DataFrame]

SCALARS_AT = datetime(2024, 1, 15, 12, 0, 0, 900000)

_registered: dict[str, Callable[[Tables], DataFrame]] = {}


def register(make: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    _registered[make.__name__] = make
    return make


def all_queries() -> dict[str, Query]:
    def bind(make: Callable[[Tables], DataFrame]) -> Query:
        return lambda spark, folder: make(Tables(spark, folder))

    return {name: bind(make) for name, make in _registered.items()}


def _new_folder(t: Tables, name: str) -> str:
    app = t.spark.sparkContext.applicationId
    return f"{shared_folder(t.spark)}/{app}/{name}-{uuid.uuid4().hex}"


# --- order marts -------------------------------------------------------------------------


@register
def daily_revenue(t: Tables) -> DataFrame:
    return marts.daily_revenue(t.keyed_orders(), ORDERS_AS_OF)


@register
def daily_revenue_exact(t: Tables) -> DataFrame:
    """The same with cents kept."""
    return marts.daily_revenue(gold.order_measures(t.orders(), exact_amounts=True), ORDERS_AS_OF)


@register
def daily_orders_by_channel(t: Tables) -> DataFrame:
    return marts.daily_orders_by_channel(t.keyed_orders("channels"), ORDERS_AS_OF)


@register
def top_products(t: Tables) -> DataFrame:
    return marts.top_products(t.keyed_orders("products"), ORDERS_AS_OF)


@register
def status_mix(t: Tables) -> DataFrame:
    return marts.status_mix(t.keyed_orders(), ORDERS_AS_OF)


@register
def hour_dow_heatmap(t: Tables) -> DataFrame:
    return marts.hour_dow_heatmap(t.event_orders(), EVENT_ORDERS_AS_OF)


@register
def recent_orders(t: Tables) -> DataFrame:
    return marts.recent_orders(t.keyed_orders("persons", "products"), t.persons(), t.products())


# --- scalar semantics --------------------------------------------------------------------


@register
def scalar_semantics(t: Tables) -> DataFrame:
    """Every scalar rule on every event row."""
    ts, value, user = F.col("ts"), F.col("value"), F.col("user_id")
    at = scalars.moment(SCALARS_AT)
    k = F.get_json_object("props", "$.k").cast("bigint")
    code = F.concat_ws("-", "event_type", k.cast("string"), F.lit("aB.cD"))
    return t.read("events").select(
        "event_id",
        scalars.seconds_between(ts, at).alias("age_seconds"),
        scalars.days_between(ts, at).cast("bigint").alias("age_days"),
        scalars.start_of_day(ts).alias("day_start"),
        F.to_date(ts).alias("day"),
        F.hour(ts).cast("bigint").alias("hour_of_day"),
        scalars.iso_weekday(ts).cast("bigint").alias("dow_iso"),
        scalars.weekday_label(ts).alias("dow_label"),
        scalars.timestamp_text(ts).alias("ts_text"),
        scalars.number(value).alias("whole"),
        scalars.number(value, 10, 2).alias("cents"),
        scalars.initcap(code).alias("capitalised"),
        scalars.zero_pad(F.col("event_id"), 3).alias("padded"),
        scalars.greatest_or_null(F.nullif(user % 3, F.lit(0)), k % 2).alias("greatest"),
        scalars.ratio(k, user % 4).alias("quotient"),
        scalars.blank_to_null(F.when(user % 2 == 0, "  ").otherwise(F.concat(F.lit(" "), "event_type"))).alias(
            "text_or_null"
        ),
        (ts >= F.date_sub(scalars.day(SCALARS_AT), 3).cast("timestamp_ntz")).alias("in_window"),
    )


# --- dimensions, facts, bridge -----------------------------------------------------------


@register
def dim_person(t: Tables) -> DataFrame:
    return gold.dim_person(t.customers())


@register
def dim_product(t: Tables) -> DataFrame:
    return gold.dim_product(t.silver_orders(), t.silver_inventory())


@register
def dim_channel(t: Tables) -> DataFrame:
    return gold.dim_channel(t.silver_orders(), t.silver_inventory(), t.silver_customers())


@register
def surrogate_key_distributed(t: Tables) -> DataFrame:
    orders = t.read("orders").select("o_orderdate", "o_orderkey")
    return number_rows(orders, ["o_orderdate", "o_orderkey"], "rn")


@register
def stable_surrogate_keys(t: Tables) -> DataFrame:
    """Person numbers after two builds; the first one knew the customers of one source only."""
    key_map, customers = _new_folder(t, "person-keys"), t.silver_customers()
    gold.dim_person(customers.where("SRC_SYSTEM = 'STORE'"), key_map)
    return gold.dim_person(customers, key_map).select("PERSON_KEY", "PERSON_ID")


@register
def fact_orders(t: Tables) -> DataFrame:
    return gold.fact_orders(t.silver_orders(), t.persons(), t.products(), t.channels(), t.order_settings())


@register
def fact_inventory_snapshot(t: Tables) -> DataFrame:
    return t.snapshot()


@register
def person_source_ids(t: Tables) -> DataFrame:
    return gold.person_source_ids(t.customers())


@register
def bridge_person_identity(t: Tables) -> DataFrame:
    return gold.bridge_person_identity(t.customers(), t.order_settings())


# --- customer and inventory marts --------------------------------------------------------


@register
def dedup_rate(t: Tables) -> DataFrame:
    bridge = gold.bridge_person_identity(t.silver_customers(), t.order_settings())
    return marts.dedup_rate(bridge, t.persons())


@register
def customers_per_channel(t: Tables) -> DataFrame:
    return marts.customers_per_channel(gold.bridge_person_identity(t.customers(), t.order_settings()))


@register
def customers_per_source(t: Tables) -> DataFrame:
    return marts.customers_per_source(silver.unify_customers(t.customers(), t.order_settings()))


@register
def customer_unified(t: Tables) -> DataFrame:
    return silver.unify_customers(t.customers(), t.order_settings())


@register
def dedup_rate_by_source(t: Tables) -> DataFrame:
    raw = t.silver_customers()
    return marts.dedup_rate_by_source(
        raw.withColumnRenamed("SRC_SYSTEM", "src_system"), silver.unify_customers(raw, t.order_settings())
    )


@register
def recency_buckets(t: Tables) -> DataFrame:
    return marts.recency_buckets(gold.person_rows(t.customers()), ORDERS_AS_OF)


@register
def users_by_locale(t: Tables) -> DataFrame:
    return marts.users_by_locale(gold.person_rows(t.customers()))


@register
def inventory_detail(t: Tables) -> DataFrame:
    return marts.inventory_detail(t.snapshot(), t.products(), t.channels(), EVENTS_AS_OF)


@register
def freshness_distribution(t: Tables) -> DataFrame:
    return marts.freshness_distribution(t.snapshot(), EVENTS_AS_OF)


@register
def freshness_distribution_floored(t: Tables) -> DataFrame:
    return marts.freshness_distribution(t.snapshot(), EVENTS_AS_OF, FRESHNESS_FLOORS)


@register
def freshness_distribution_reordered(t: Tables) -> DataFrame:
    """Floors in another order, and for two of the classes only."""
    return marts.freshness_distribution(t.snapshot(), EVENTS_AS_OF, {"expired": 100000, "fresh": 3})


# --- landing and cleaning ----------------------------------------------------------------


@register
def bronze_landing(t: Tables) -> DataFrame:
    """Two sources in one landing frame; NULL fields leave no key in the object."""
    orders = t.read("orders").selectExpr(
        "o_orderkey", "CASE WHEN o_custkey % 3 <> 0 THEN o_custkey END AS cust", "o_orderstatus AS status"
    )
    events = t.read("events").selectExpr("event_id", "event_type AS status")
    landed = append_all(
        [
            land(orders, "STORE", "orders", ORDERS_AS_OF),
            land(events, "WEBSITE", "events", EVENTS_AS_OF),
        ]
    )
    return landed.select(
        "src_system",
        "src_file",
        "load_ts",
        field("o_orderkey", "event_id", as_type="bigint").alias("id"),
        field("cust", as_type="bigint").alias("cust"),
        field("status").alias("status"),
        F.to_json("data").contains("cust").alias("has_cust_key"),
    )


@register
def variant_extract(t: Tables) -> DataFrame:
    """One field as number, as text and as junk; junk gives NULL instead of an error."""
    rows = t.read("events").selectExpr(
        "event_id",
        "CASE event_id % 3 WHEN 0 THEN props"
        " WHEN 1 THEN concat('{\"k\": \"', get_json_object(props, '$.k'), '\"}')"
        " ELSE concat('{\"k\": \"$', get_json_object(props, '$.k'), '.50\"}') END AS doc",
    )
    data = rows.select("event_id", F.parse_json("doc").alias("data"))
    return data.select(
        "event_id",
        field("k", as_type="int").alias("as_int"),
        field("k").alias("as_text"),
        parsing.money(field("absent", "k")).alias("as_money"),
    )


@register
def money_parse(t: Tables) -> DataFrame:
    exact = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    kind = F.col("o_orderkey") % 6
    text = (
        F.when(kind == 0, F.concat(F.lit("AUD "), exact))
        .when(kind == 1, F.concat(F.lit("A$"), exact))
        .when(kind == 2, F.concat(F.lit("$"), exact))
        .when(kind == 3, F.concat(F.lit(" hkd -"), exact))
        .when(kind == 4, exact)
        .otherwise("n/a")
    )
    code = parsing.currency(F.when(F.col("o_custkey") % 2 == 0, " aud ").otherwise(""), "CNY")
    rows = t.read("orders").select("o_orderkey", text.alias("text"), code.alias("code"))
    amount = F.col("text")
    return rows.select(
        "o_orderkey",
        parsing.money(amount).alias("amount"),
        parsing.currency_in_amount(amount).alias("code_in_amount"),
        F.col("code").alias("currency"),
        parsing.currency_mismatch(amount, F.col("code")).alias("mismatch"),
    )


@register
def money_parse_strict(t: Tables) -> DataFrame:
    """Amounts that only look like one are refused; thousands in threes are read."""
    key = F.col("o_orderkey")
    text = (
        F.when(key % 4 == 0, "1.234,56")
        .when(key % 4 == 1, F.concat(F.lit("("), key.cast("string"), F.lit(".00)")))
        .when(key % 4 == 2, F.concat(F.lit("A$1,000,"), F.lpad((key % 1000).cast("string"), 3, "0"), F.lit(".25")))
        .otherwise("1.5E3")
    )
    return t.read("orders").select("o_orderkey", parsing.money(text).alias("amount"))


@register
def timestamp_offsets(t: Tables) -> DataFrame:
    """Short offsets count; a time with anything else behind it is refused."""
    rows = t.read("events").selectExpr(
        "event_id",
        """concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
           CASE event_id % 3 WHEN 0 THEN '+11' WHEN 1 THEN '-0330' ELSE ' Europe/Paris' END) AS text""",
    )
    return rows.select("event_id", parsing.utc_time(F.col("text")).alias("utc"))


@register
def timestamp_parse(t: Tables) -> DataFrame:
    """Each event time written in one of seven formats, and parsed back."""
    rows = t.read("events").selectExpr(
        "event_id",
        """CASE event_id % 7
           WHEN 0 THEN date_format(ts, 'dd/MM/yyyy HH:mm')
           WHEN 1 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
           WHEN 2 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss')
           WHEN 3 THEN CAST(unix_seconds(CAST(ts AS TIMESTAMP)) AS STRING)
           WHEN 4 THEN concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), '+00:00+11:00')
           WHEN 5 THEN concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), '-05:30')
           ELSE 'yesterday' END AS text""",
    )
    text = F.col("text")
    return rows.select(
        "event_id",
        parsing.utc_time(text).alias("utc"),
        parsing.utc_time(text, "Australia/Brisbane").alias("utc_from_brisbane"),
        parsing.time_is_ambiguous(text).alias("ambiguous"),
    )


@register
def contact_normalise(t: Tables) -> DataFrame:
    rows = t.read("customer").selectExpr(
        "c_custkey",
        "CASE WHEN c_custkey % 13 = 0 THEN '  ' ELSE concat(' ', upper(c_name), '@Example.com ') END AS email",
        "CASE c_custkey % 4 WHEN 0 THEN concat('+61 ', c_custkey) WHEN 1 THEN concat('44', c_custkey, '.0')"
        " WHEN 2 THEN concat('+852-', c_custkey) ELSE '' END AS phone",
        "upper(c_mktsegment) AS name",
    )
    cleaned = rows.select(
        "c_custkey",
        parsing.email(F.col("email")).alias("email"),
        parsing.phone(F.col("phone")).alias("phone"),
        parsing.phone_kept_plus(F.col("phone")).alias("phone_kept_plus"),
        parsing.person_name(F.col("name")).alias("name"),
    )
    return cleaned.withColumns(
        {
            "locale": parsing.locale(F.col("phone")),
            "confidence": parsing.match_confidence(F.col("email"), F.col("phone")),
        }
    )


@register
def product_code_normalise(t: Tables) -> DataFrame:
    text = F.concat(F.lit(" "), F.lower("p_brand"), F.lit("-"), F.col("p_partkey").cast("string"), F.lit(" "))
    return t.read("part").select(
        "p_partkey",
        parsing.product_code(text).alias("code"),
        parsing.product_code(text, keep_hyphen=True).alias("code_with_hyphen"),
    )


@register
def status_normalise(t: Tables) -> DataFrame:
    word = F.expr(
        "CASE o_orderkey % 7 WHEN 0 THEN 'PAID' WHEN 1 THEN 'Completed' WHEN 2 THEN 'Success'"
        " WHEN 3 THEN 'VOID' WHEN 4 THEN ' Cancelled ' WHEN 5 THEN 'Refund' ELSE o_orderstatus END"
    )
    return t.read("orders").select("o_orderkey", parsing.order_status(word).alias("status"))


@register
def inventory_latest(t: Tables) -> DataFrame:
    return silver.latest_inventory(t.stock())


@register
def inventory_unified(t: Tables) -> DataFrame:
    return t.inventory()


@register
def inventory_conflict(t: Tables) -> DataFrame:
    """Products by conflict flag, under a tolerance of 300."""
    return t.inventory().groupBy("PRODUCT_ID").agg(F.max("CONFLICT_FLAG").alias("CONFLICT_FLAG"))


@register
def source_coverage(t: Tables) -> DataFrame:
    """Coverage with every inventory row kept, not only the newest per source."""
    rows = t.inventory(t.stock_settings(inventory_grain="all"))
    return rows.groupBy("PRODUCT_ID", "SOURCE_COVERAGE").agg(F.count("*").alias("row_count"))


@register
def order_person_lookup(t: Tables) -> DataFrame:
    """Each order's person, found by source and customer id; OTA orders by e-mail."""
    records = t.silver_customers().withColumn("EMAIL", parsing.email(F.col("EMAIL")))
    by_mail = F.concat(F.lit("customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"), F.lit("@example.com"))
    priority = F.col("o_orderpriority")
    source = scalars.equals_choice(
        priority, {"1-URGENT": "WEBSITE", "2-HIGH": "WEBSITE", "5-LOW": "OTA"}, F.lit("STORE")
    )
    ref = F.when(source == "OTA", by_mail).otherwise(F.concat_ws("_", source, F.col("o_custkey").cast("string")))
    null = F.lit(None)
    parsed = t.read("orders").select(
        F.col("o_orderkey").cast("string").alias("ORDER_ID_SRC"),
        source.alias("SOURCE"),
        F.col("o_orderdate").alias("ORDER_TS"),
        ref.alias("CUSTOMER_REF"),
        null.cast("string").alias("PRODUCT_ID"),
        null.cast("bigint").alias("QTY"),
        null.cast("decimal(18,2)").alias("GROSS_AMOUNT"),
        null.cast("string").alias("CURRENCY"),
        null.cast("string").alias("STATUS"),
    )
    found = silver.clean_orders(parsed, t.stored("references", lambda: silver.customer_references(records)))
    return found.select("ORDER_ID_SRC", "SOURCE", "PERSON_KEY")


# --- identity ----------------------------------------------------------------------------


def _contacts(t: Tables) -> DataFrame:
    """Customers in chains of eight: e-mails pair 2k with 2k+1, phones pair 2k+1 with 2k+2."""
    return t.source_customers().selectExpr(
        "SRC_SYSTEM",
        "CAST(c_custkey AS STRING) AS SRC_USER_ID",
        "CASE WHEN c_custkey % 13 <> 0 THEN concat('e', c_custkey div 2) END AS EMAIL",
        "CASE WHEN c_custkey % 8 NOT IN (0, 7) THEN concat('', (c_custkey + 1) div 2) END AS PHONE",
    )


@register
def identity_one_pass(t: Tables) -> DataFrame:
    key = one_pass_key(F.col("EMAIL"), F.col("PHONE"), F.col("SRC_SYSTEM"), F.col("SRC_USER_ID"))
    return _contacts(t).select("SRC_SYSTEM", "SRC_USER_ID", key.alias("PERSON_KEY"))


@register
def identity_components(t: Tables) -> DataFrame:
    records = t.stored("contacts", lambda: _contacts(t))
    return transitive_keys(records).select("SRC_SYSTEM", "SRC_USER_ID", "PERSON_KEY")


@register
def identity_incremental(t: Tables) -> DataFrame:
    """The same people when the customers come in three batches."""
    records = t.stored("contacts", lambda: _contacts(t))
    store = IdentityStore(_new_folder(t, "identity"))
    for batch in range(3):
        store.add(records.where(F.col("SRC_USER_ID").cast("long") % 3 == batch), batch)
    return store.keys(records).select("SRC_SYSTEM", "SRC_USER_ID", "PERSON_KEY")


# --- quality -----------------------------------------------------------------------------


@register
def key_violations(t: Tables) -> DataFrame:
    """Order lines are not unique in the test data; the dimension keys must be."""
    lines = t.read("lineitem").selectExpr("concat(l_orderkey, '/', l_linenumber) AS LINE")
    tables = {"lineitem": lines, "dim_person": t.persons(), "dim_product": t.products()}
    keys = {"lineitem": ["LINE"], "dim_person": ["PERSON_KEY"], "dim_product": ["PRODUCT_ID"]}
    return quality.all_key_violations(tables, keys)


@register
def quality_gate(t: Tables) -> DataFrame:
    """Order lines written through a gate: those that pass, and those it holds back by the rules they break."""
    lines = t.read("lineitem").selectExpr(
        "CASE WHEN l_linenumber <> 7 THEN concat(l_orderkey, '/', l_linenumber) END AS LINE", "l_quantity"
    )
    gate = Gate({"quantity": F.col("l_quantity") > 45}, unique=("LINE",), allowed={})
    folder = _new_folder(t, "gated")
    try:  # the first build is refused and leaves no table, only what was found
        gated_refresh(lines, f"{folder}/lines", gate, f"{folder}/refused")
    except QualityError as refused:
        gate = replace(gate, allowed=refused.found)
    kept = gated_refresh(lines, f"{folder}/lines", gate, f"{folder}/quarantine")
    held = t.spark.read.parquet(f"{folder}/quarantine").withColumn("rules", F.array_join(F.array_sort("broken_rules"), ", "))
    rows = kept.withColumn("rules", F.lit("")).unionByName(held.drop("broken_rules"))
    return rows.groupBy("rules").agg(F.count("*").alias("row_count"), F.sum("l_quantity").cast("bigint").alias("quantity"))


@register
def orphan_keys(t: Tables) -> DataFrame:
    fact = t.keyed_orders("persons", "products", "channels")
    return quality.orphan_keys(fact, "fact_orders", ["PERSON_KEY", "PRODUCT_ID", "CHANNEL_ID"])


@register
def currency_check(t: Tables) -> DataFrame:
    return quality.currency_report(t.orders())


# --- sources and sinks -------------------------------------------------------------------


@register
def csv_source(t: Tables) -> DataFrame:
    """Customers written as CSV and read back as text; blank fields come back NULL."""
    path = _new_folder(t, "csv")
    t.read("customer").selectExpr(
        "c_custkey AS ID",
        "CASE WHEN c_custkey % 5 <> 0 THEN concat(c_name, ', \"', c_mktsegment, '\"') END AS name",
        "concat(c_custkey, '.0') AS tel",
    ).write.option("header", True).option("escape", '"').csv(path)
    return read_csv(t.spark, path, ("ID", "name", "tel")).drop(CORRUPT)


@register
def bad_records(t: Tables) -> DataFrame:
    """Rows too wide or too narrow, and broken JSON, land with their text and are counted."""
    root, at = _new_folder(t, "broken"), ORDERS_AS_OF
    rows = t.read("customer").selectExpr(
        "concat(c_custkey, CASE c_custkey % 10 WHEN 0 THEN ',a,b' WHEN 1 THEN '' ELSE ',a' END) AS `id,name`"
    )
    rows.write.option("header", True).option("sep", "\u0001").csv(f"{root}/customers.csv")
    t.read("events").selectExpr("CASE WHEN event_id % 7 = 0 THEN '{\"k\":' ELSE props END").write.text(f"{root}/events.jsonl")
    t.read("events").selectExpr("CASE WHEN event_id % 5 = 0 THEN '[1,' ELSE props END").write.text(f"{root}/free.jsonl")
    files = (
        RawFile("x", "STORE", "customers.csv", ("id", "name")),
        RawFile("x", "OTA", "events.jsonl", ("k",)),
        RawFile("x", "WHATSAPP", "free.jsonl"),
    )
    return quality.bad_records(land_entity(t.spark, root, "x", at, files))


@register
def numeric_parquet_landing(t: Tables) -> DataFrame:
    """Phones and amounts that come as floating-point numbers keep all their digits."""
    root = _new_folder(t, "numbers")
    rows = t.read("customer").selectExpr(
        "c_custkey", "CAST(61000000000 + c_custkey AS DOUBLE) AS tel", "c_custkey * 1000003 + 0.25D AS amount"
    )
    rows.write.parquet(f"{root}/numbers.parquet")
    landed = land_entity(t.spark, root, "x", ORDERS_AS_OF, (RawFile("x", "STORE", "numbers.parquet"),))
    return landed.select(
        field("c_custkey", as_type="bigint").alias("c_custkey"),
        parsing.phone(field("tel")).alias("phone"),
        parsing.money(field("amount")).alias("amount"),
    )


@register
def json_source(t: Tables) -> DataFrame:
    """Events written as JSON lines and read back with fields of mixed type."""
    path = _new_folder(t, "json")
    t.read("events").selectExpr(
        "event_id", "CASE WHEN event_id % 2 = 0 THEN parse_json(props) ELSE parse_json('\"none\"') END AS props"
    ).write.json(path)
    rows = read_json(t.spark, path, ("event_id", "props"), lines=True)
    return rows.selectExpr(
        "variant_get(event_id, '$', 'bigint') AS event_id",
        "try_variant_get(props, '$.k', 'int') AS k",
        "CASE WHEN schema_of_variant(props) = 'STRING' THEN variant_get(props, '$', 'string') END AS text",
    )


#: Events of one array: some 200 MB, more than a task reads at once.
ARRAY_ROWS = 1_500_000


@register
def json_array_split(t: Tables) -> DataFrame:
    """Events written as large JSON arrays, two at least, with braces and quotes in their texts, and read in pieces.

    One task sorts and writes an array, so there are more of them, not longer ones, when there are more events.
    """
    path, events = _new_folder(t, "json-arrays"), t.read("events")
    files = max(2, -(-events.count() // ARRAY_ROWS))
    records = events.select(
        (F.col("event_id") % files).alias("file"),
        F.col("event_id").alias("place"),
        F.to_json(
            F.struct(
                "event_id",
                F.struct("user_id", F.struct("event_type").alias("of")).alias("inner"),
                F.concat(F.lit('}],"\\'), "props").alias("text"),
            )
        ).alias("value"),
    )
    first = Window.partitionBy("file").orderBy("place")
    lines = records.withColumn("value", F.concat(F.when(F.row_number().over(first) == 1, "[").otherwise(","), "value"))
    ends = records.groupBy("file").agg((F.max("place") + 1).alias("place"), F.lit("]").alias("value"))
    placed = lines.unionByName(ends).repartitionByRange(files, "file").sortWithinPartitions("file", "place")
    placed.select("file", "value").write.partitionBy("file").text(path)
    rows = read_json_array(t.spark, path, ("event_id", "inner", "text"))
    return rows.selectExpr(
        "variant_get(event_id, '$', 'bigint') AS event_id",
        "variant_get(inner, '$.user_id', 'bigint') AS user_id",
        "variant_get(inner, '$.of.event_type', 'string') AS event_type",
        "variant_get(text, '$', 'string') AS text",
    )


@register
def full_refresh_sink(t: Tables) -> DataFrame:
    """A table replaced by a second build holds the second build only."""
    path = _new_folder(t, "refreshed")
    full_refresh(t.read("nation").selectExpr("n_nationkey AS id", "n_name AS name"), path)
    return full_refresh(t.read("customer").selectExpr("c_custkey AS id", "c_name AS name"), path)


@register
def snapshot_append(t: Tables) -> DataFrame:
    """Two days of snapshots, the second one built twice."""
    path = _new_folder(t, "snapshots")
    for days in (0, 1, 1):
        settings = Settings(as_of=EVENTS_AS_OF + timedelta(days=days))
        snap = gold.fact_inventory_snapshot(t.silver_inventory(), t.products(), t.channels(), settings)
        kept = append_snapshot(snap, path)
    return kept.groupBy("SNAPSHOT_DATE").agg(
        F.count("*").alias("row_count"), F.sum("SYNC_DELAY_SEC").alias("delay"), F.max("SNAPSHOT_TS").alias("at")
    )


@register
def snapshot_history(t: Tables) -> DataFrame:
    """The same days, stored as intervals and read back day by day."""
    days = [Settings(as_of=EVENTS_AS_OF + timedelta(days=n)) for n in (0, 1)]
    history = gold.inventory_history(t.spark, _new_folder(t, "history"))
    for settings in (*days, days[-1]):
        snap = gold.fact_inventory_snapshot(t.silver_inventory(), t.products(), t.channels(), settings)
        gold.record_inventory(history, snap, settings)
    kept = append_all(gold.inventory_as_of(t.spark, history, settings) for settings in days)
    return kept.groupBy(F.to_date("SNAPSHOT_TS").alias("SNAPSHOT_DATE")).agg(
        F.count("*").alias("row_count"), F.sum("SYNC_DELAY_SEC").alias("delay"), F.max("SNAPSHOT_TS").alias("at")
    )


def _order_changes(t: Tables) -> DataFrame:
    channel = F.lower("SOURCE").alias("CHANNEL_ID")
    orders = t.silver_orders().select(F.col("ORDER_ID_SRC").alias("ORDER_ID"), "ORDER_TS", "STATUS", channel, "PRODUCT_ID", "GROSS_AMOUNT")
    return orders.withColumn("DELETED", F.lit(False))


def _order_rollup(t: Tables) -> DataFrame:
    """Orders as they came, with some days, statuses and amounts that were corrected later, and some that were no orders."""
    orders, number = _order_changes(t), F.col("ORDER_ID").cast("long")
    rollup = OrderRollup(_new_folder(t, "rollup"))
    first = orders.withColumns(
        {
            "ORDER_TS": F.when(number % 5 == 0, F.col("ORDER_TS") - F.expr("INTERVAL 40 DAYS")).otherwise(F.col("ORDER_TS")),
            "STATUS": F.when(number % 7 == 0, "paid").otherwise(F.col("STATUS")),
            "GROSS_AMOUNT": F.when(number % 11 == 0, 1).otherwise(F.col("GROSS_AMOUNT")),
        }
    )
    wrong = orders.where(number % 13 == 0).withColumn("ORDER_ID", F.concat(F.lit("x"), "ORDER_ID"))
    rollup.add(first.unionByName(wrong), 0)
    rollup.add(orders.where((number % 5 == 0) | (number % 7 == 0)).unionByName(wrong.withColumn("DELETED", F.lit(True))), 1)
    rollup.add(orders.where(number % 11 == 0), 2)
    return rollup.rows(t.spark, str((ORDERS_AS_OF - timedelta(days=marts.WINDOW_DAYS)).date()))


@register
def rollup_daily_revenue(t: Tables) -> DataFrame:
    """Revenue in cents per day from a rollup that took corrections in."""
    return rollups.daily_revenue(_order_rollup(t))


@register
def rollup_status_mix(t: Tables) -> DataFrame:
    return rollups.status_mix(_order_rollup(t))


@register
def distinct_sketches(t: Tables) -> DataFrame:
    """Customers per channel by stored sketches of each day, beside the exact number."""
    path, orders = _new_folder(t, "sketches"), t.silver_orders().where("PERSON_KEY IS NOT NULL")
    channel, person = F.lower("SOURCE"), F.col("PERSON_KEY")
    for batch in range(3):  # months come in three loads
        load = orders.where(F.month("ORDER_TS") % 3 == batch)
        add_sketches(load, path, batch, F.to_date("ORDER_TS"), channel, person)
    exact = orders.groupBy(channel.alias("CHANNEL")).agg(F.count_distinct("PERSON_KEY").alias("customers"))
    found = distinct_estimates(t.spark, path, ("CHANNEL",)).withColumnRenamed("CHANNEL", "c")
    off = F.abs(F.col("estimate") - F.col("customers"))
    joined = exact.join(found, F.col("CHANNEL").eqNullSafe(F.col("c")))
    within = off <= F.greatest(F.lit(1.0), F.col("customers") * error_bound())
    return joined.select(F.col("CHANNEL").alias("channel"), "customers", within.alias("within_bound"))


@register
def bucketed_order_persons(t: Tables) -> DataFrame:
    """Orders and people joined by their buckets."""
    name = f"t_{uuid.uuid4().hex}"
    fact = bucketed_refresh(t.silver_orders().where("PERSON_KEY IS NOT NULL"), f"{name}_orders", "PERSON_KEY", 8)
    persons = bucketed_refresh(t.persons(), f"{name}_persons", "PERSON_KEY", 8)
    joined = fact.join(persons.hint("merge"), "PERSON_KEY")
    return joined.groupBy("LOCALE").agg(F.count("*").alias("orders"), F.sum("GROSS_AMOUNT").alias("amount"))


# --- the whole build from raw exports ----------------------------------------------------

RAW_AS_OF = ORDERS_AS_OF
_built: dict[tuple[str, str, str], dict[str, DataFrame]] = {}


def _exports(t: Tables) -> str:
    """The folder of the exports derived from the test tables; written once per session."""
    key = (t.spark.sparkContext.applicationId, t.folder, "exports")
    if key not in _built:
        _built[key] = {"root": write_exports(t, _new_folder(t, "exports"))}
    return _built[key]["root"]


def _raw_build(t: Tables, mode: str = "one_pass") -> dict[str, DataFrame]:
    """Every layer from the exports; once per session."""
    key = (t.spark.sparkContext.applicationId, t.folder, mode)
    if key not in _built:
        settings = Settings(as_of=RAW_AS_OF, identity_mode=mode)
        _built[key] = pipeline.build(t.spark, _exports(t), _new_folder(t, "build"), settings, EXPORT_FILES)
    return _built[key]


@register
def raw_to_gold_landing(t: Tables) -> DataFrame:
    tables = _raw_build(t)
    counts = [
        tables[n].groupBy("src_system", "src_file").agg(F.count("*").alias("row_count")).withColumn("entity", F.lit(n))
        for n in ("raw_users", "raw_orders", "raw_inventory")
    ]
    return append_all(counts)


@register
def raw_to_gold_customers(t: Tables) -> DataFrame:
    return _raw_build(t)["vw_customer_unified"]


@register
def raw_to_gold_dim_person(t: Tables) -> DataFrame:
    return _raw_build(t)["dim_person"]


@register
def raw_to_gold_persons_transitive(t: Tables) -> DataFrame:
    """People found when chains of shared contacts are followed, with their source records."""
    bridge = _raw_build(t, "transitive")["bridge_person_identity_map"]
    return bridge.select("PERSON_KEY", "SRC_SYSTEM")


@register
def raw_to_gold_dim_product(t: Tables) -> DataFrame:
    return _raw_build(t)["dim_product"]


@register
def raw_to_gold_fact_orders(t: Tables) -> DataFrame:
    return _raw_build(t)["fact_orders"]


@register
def raw_to_gold_fact_inventory(t: Tables) -> DataFrame:
    """As of the end of the events, so that all freshness classes occur."""
    built, settings = _raw_build(t), Settings(as_of=EVENTS_AS_OF)
    stock = silver.unify_inventory(silver.parsed_inventory(built["raw_inventory"], settings), settings)
    return gold.fact_inventory_snapshot(stock, built["dim_product"], built["dim_channel"], settings)


@register
def raw_to_gold_daily_revenue(t: Tables) -> DataFrame:
    return marts.daily_revenue(_raw_build(t)["fact_orders"], RAW_AS_OF)


def _streamed(t: Tables) -> dict[str, DataFrame]:
    """Silver views of the same exports taken in as streams; once per session."""
    key = (t.spark.sparkContext.applicationId, t.folder, "streamed")
    if key not in _built:
        out, settings = _new_folder(t, "stream"), Settings(as_of=RAW_AS_OF)
        root = _exports(t)
        streaming.take_in(t.spark, root, out, settings, EXPORT_FILES)
        streaming.take_in(t.spark, root, out, settings, EXPORT_FILES)  # nothing new
        _built[key] = streaming.views(t.spark, out, settings, EXPORT_FILES)
    return _built[key]


@register
def streaming_customers(t: Tables) -> DataFrame:
    return _streamed(t)["vw_customer_unified"]


@register
def streaming_fact_orders(t: Tables) -> DataFrame:
    settings = Settings(as_of=RAW_AS_OF)
    # gold reads each view several times, so they are stored first, as in a build
    views = {name: stage(view, name) for name, view in _streamed(t).items()}
    return pipeline.build_gold(views, _new_folder(t, "stream-gold"), settings)["fact_orders"]


@register
def streaming_inventory(t: Tables) -> DataFrame:
    """The inventory kept as state while its rows arrive file by file, in no order."""
    path, settings = _new_folder(t, "stock"), t.stock_settings()
    stock = t.stock().withColumn("ROW_ID", F.lpad(F.col("ROW_ID").cast("string"), 20, "0"))
    stock.repartition(6, F.xxhash64("ROW_ID")).write.parquet(f"{path}/in")
    arriving = t.spark.readStream.schema(stock.schema).option("maxFilesPerTrigger", 2).parquet(f"{path}/in")
    stock_state.keep_stock(arriving, path, settings)
    return stock_state.current_stock(t.spark, path, settings)
