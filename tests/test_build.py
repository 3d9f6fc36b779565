"""The whole build on the invented exports, value by value."""

import os
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from raw_fixture import AS_OF, write_raw
from tidewell.operators import quality
from tidewell.plans import gold, marts, pipeline, silver
from tidewell.plans.catalog import publish
from tidewell.session import staging
from tidewell.settings import Settings
from tidewell.sources.files import RAW_FILES, RawFile, read_csv, read_raw
from tidewell.sources.landing import land_entity
from tidewell.sources.sinks import append_snapshot, full_refresh, full_refresh_table


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    return write_raw(str(tmp_path_factory.mktemp("raw")))


@pytest.fixture(scope="module")
def out(tmp_path_factory):
    return str(tmp_path_factory.mktemp("out"))


@pytest.fixture(scope="module")
def tables(spark, raw, out):
    return pipeline.build(spark, raw, out, Settings(as_of=AS_OF))


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


# --- landing -----------------------------------------------------------------------------


def test_landing_keeps_every_row_with_lineage(tables):
    rows = tables["raw_users"].groupBy("src_system", "src_file").count().collect()
    assert {tuple(r) for r in rows} == {("STORE", "users_store.csv", 5), ("WEBSITE", "users_website.csv", 4)}
    assert tables["raw_users"].schema["data"].dataType.simpleString() == "variant"
    assert {r.load_ts for r in tables["raw_orders"].collect()} == {AS_OF}


def test_null_fields_leave_no_key(tables):
    rows = by(tables["raw_users"].select(F.to_json("data").alias("j"), F.expr("data:crm_id::string").alias("id")), "id")
    assert "email_address" not in rows["a2"].j and "email_address" in rows["a1"].j
    assert '"name":"Odo, the 3rd"' in rows["K-77"].j


def test_json_types_survive(tables):
    kinds = tables["raw_inventory"].where("src_system = 'OTA'").select(
        F.expr("schema_of_variant(data:availability)").alias("k")
    )
    assert sorted(r.k for r in kinds.collect()) == ["BIGINT", "BIGINT", "STRING"]


def test_optional_export(spark, raw, tmp_path):
    whatsapp = next(f for f in RAW_FILES if f.src_system == "WHATSAPP")
    assert read_raw(spark, raw, whatsapp) is None
    with pytest.raises(AnalysisException):
        read_raw(spark, str(tmp_path), RAW_FILES[0])
    full = write_raw(str(tmp_path / "full"), whatsapp=True)
    st = Settings(as_of=AS_OF)
    records = by(silver.customer_records(land_entity(spark, full, "users", AS_OF), st), "SRC_SYSTEM", "SRC_USER_ID")
    pia = records[("WHATSAPP", "q9")]
    assert (pia.FULL_NAME, pia.PHONE, pia.LOCALE, pia.LAST_SEEN_UTC) == (
        "Pia Ro", "61355500177", "AU", datetime(2024, 5, 2),
    )


def test_parquet_export(spark, tmp_path):
    spark.sql("SELECT 'a1' AS crm_id, 'ANN' AS name, NULL AS tel").write.parquet(str(tmp_path / "u.parquet"))
    landed = land_entity(spark, str(tmp_path), "users", AS_OF, (RawFile("users", "STORE", "u.parquet"),))
    assert landed.select(F.to_json("data")).first()[0] == '{"crm_id":"a1","name":"ANN"}'


def test_build_leaves_no_intermediate_tables(spark, raw, tmp_path):
    with staging(spark) as folder:
        gold.dim_channel(*[spark.sql("SELECT 'a' AS SOURCE, 'b' AS SRC_SYSTEM")] * 3).collect()
        assert os.listdir(folder)
    assert not os.path.exists(folder)


def test_wrong_header_is_refused(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path / "x.csv"), ("a", "b")).collect()


# --- silver ------------------------------------------------------------------------------


def test_customers(tables):
    rows = by(tables["vw_customer_unified"], "SRC_SYSTEM", "SRC_USER_ID")
    assert set(rows) == {
        ("STORE", "a1"), ("STORE", "a2"), ("STORE", "K-77"), ("STORE", "a4"),
        ("WEBSITE", "m1"), ("WEBSITE", "m2"), ("WEBSITE", "m3"), ("WEBSITE", "m4"),
    }
    mira = rows[("STORE", "a1")]
    assert (mira.FULL_NAME, mira.EMAIL, mira.PHONE, mira.LOCALE) == ("Mira Kosta", "mira@kosta.test", "61355500101", "AU")
    assert mira.LAST_SEEN_UTC == datetime(2024, 5, 3, 11, 25)
    assert mira.PERSON_KEY == rows[("WEBSITE", "m1")].PERSON_KEY
    assert rows[("STORE", "a2")].PERSON_KEY != rows[("WEBSITE", "m2")].PERSON_KEY
    confidence = {k[1]: r.MATCH_CONFIDENCE for k, r in rows.items()}
    assert confidence["a1"] == 1 and confidence["a2"] == Decimal("0.8") and confidence["a4"] == Decimal("0.5")
    assert [rows[("WEBSITE", k)].LOCALE for k in ("m3", "m4")] == ["GB", "HK"]


def test_transitive_identity_joins_by_phone(spark, tables):
    st = Settings(as_of=AS_OF, identity_mode="transitive")
    rows = by(silver.customer_records(tables["raw_users"], st), "SRC_USER_ID")
    assert rows["a2"].PERSON_KEY == rows["m2"].PERSON_KEY
    assert len({r.PERSON_KEY for r in rows.values()}) == 6


def test_record_grain_keeps_all(tables):
    st = Settings(as_of=AS_OF, customer_grain="record")
    assert silver.unify_customers(silver.customer_records(tables["raw_users"], st), st).count() == 9


def test_orders(tables):
    rows = by(tables["vw_orders_clean"], "ORDER_ID_SRC")
    people = by(tables["vw_customer_unified"], "SRC_USER_ID")
    assert rows["B61"].PERSON_KEY == people["m1"].PERSON_KEY
    assert rows["B62"].PERSON_KEY is None and rows["T53"].PERSON_KEY is None
    assert rows["B63"].PERSON_KEY == people["m4"].PERSON_KEY
    assert rows["B61"].ORDER_TS == datetime(2024, 5, 20, 11, 2, 33)
    assert {k: r.STATUS for k, r in rows.items()} == {
        "T51": "paid", "T52": "void", "T53": "paid", "E81": "cancelled", "E82": "paid", "E83": "paid",
        "B61": "paid", "B62": "refunded", "B63": "paid",
    }
    assert {k: r.CURRENCY for k, r in rows.items() if r.CURRENCY != "AUD"} == {"E82": "AUX", "E83": "CNY"}
    assert rows["B62"].GROSS_AMOUNT == 93 and rows["B63"].PRODUCT_ID == "NV35"
    assert rows["E83"].PRODUCT_ID is None


def test_parsed_orders_flag_amounts_and_times(tables):
    parsed = by(silver.parsed_orders(tables["raw_orders"], Settings(as_of=AS_OF)), "ORDER_ID_SRC")
    assert parsed["B62"].CURRENCY_MISMATCH and parsed["B62"].CURRENCY_IN_AMOUNT == "HKD"
    assert not parsed["B61"].CURRENCY_MISMATCH and parsed["B61"].TS_AMBIGUOUS and not parsed["E81"].TS_AMBIGUOUS


def test_local_zone_per_source(tables):
    st = Settings(as_of=AS_OF, local_zones={"STORE": "Australia/Sydney"})
    parsed = by(silver.parsed_orders(tables["raw_orders"], st), "ORDER_ID_SRC")
    assert parsed["T51"].ORDER_TS == datetime(2024, 5, 2, 22, 12)
    assert parsed["E82"].ORDER_TS == datetime(2024, 5, 10, 21, 30, 5, 640000)


def test_hyphens_may_stay(tables):
    st = Settings(as_of=AS_OF, keep_hyphen=True)
    parsed = by(silver.parsed_orders(tables["raw_orders"], st), "ORDER_ID_SRC")
    assert parsed["B61"].PRODUCT_ID == "NV-33" and parsed["E82"].PRODUCT_ID == "NV33"


def test_inventory(tables):
    rows = by(tables["vw_inventory_unified"], "PRODUCT_ID", "SRC_SYSTEM")
    assert len(rows) == 7
    store = rows[("NV33", "STORE")]
    assert (store.AVAILABLE_QTY, store.PRICE, store.FRESHNESS_FLAG) == (3, Decimal("64.25"), "fresh")
    # equal times: the smaller quantity wins
    assert rows[("QB77", "STORE")].AVAILABLE_QTY == 4
    assert rows[("QB77", "OTA")].AVAILABLE_QTY == 4 and rows[("QB77", "OTA")].PRICE == 55
    flags = {k: (r.FRESHNESS_FLAG, r.CONFLICT_FLAG, r.SOURCE_COVERAGE) for k, r in rows.items()}
    assert flags[("NV33", "PARTNER")] == ("fresh", True, 3)
    assert flags[("QB77", "OTA")] == ("stale", False, 3)
    assert flags[("QB77", "PARTNER")] == ("expired", False, 3)
    assert flags[("SYD901", "OTA")] == ("expired", False, 1)


def test_inventory_all_rows(tables):
    st = Settings(as_of=AS_OF, inventory_grain="all")
    rows = silver.unify_inventory(silver.parsed_inventory(tables["raw_inventory"], st), st)
    assert rows.count() == 9
    assert rows.select("PRODUCT_ID", "CONFLICT_FLAG", "SOURCE_COVERAGE").distinct().count() == 3


# --- gold --------------------------------------------------------------------------------


def test_dim_person(tables):
    rows = by(tables["dim_person"], "SRC_USER_ID_LATEST")
    mira = rows["m1"]
    assert (mira.FIRST_SEEN_CHANNEL, mira.SRC_SYSTEM_LATEST, mira.PHONE_NORM) == ("store", "website", "61355500109")
    keys = sorted(r.PERSON_KEY for r in rows.values())
    assert {r.PERSON_KEY: r.PERSON_ID for r in rows.values()} == {k: i for i, k in enumerate(keys, 1)}


def test_person_without_key_or_time(spark):
    schema = (
        "PERSON_KEY string, FULL_NAME string, EMAIL string, PHONE string, LOCALE string, SRC_SYSTEM string,"
        " SRC_USER_ID string, LAST_SEEN_UTC timestamp_ntz, MATCH_CONFIDENCE decimal(3,2)"
    )
    t = datetime(2025, 1, 1)
    one = Decimal(1)
    rows = [
        (None, "x", None, None, None, "S", "0", t, one),
        ("p", "late", " ", "+1-2", None, "S", "1", None, one),
        ("p", "tie", "b@X ", None, None, "W", "2", t, one),
        ("p", "tie2", "A@x", None, "AU", "S", "2", t, one),
        ("q", "none", "", "", None, "S", "3", None, one),
    ]
    people = by(gold.person_rows(spark.createDataFrame(rows, schema)), "PERSON_KEY")
    p, q = people["p"], people["q"]
    # largest raw e-mail, then normalised; blanks sort below letters, capitals below small ones
    assert (p.EMAIL_NORM, p.PHONE_NORM, p.FULL_NAME, p.FIRST_SEEN_CHANNEL) == ("b@x", "+12", "tie2", "s")
    assert (q.EMAIL_NORM, q.PHONE_NORM, q.LAST_SEEN_TS) == (None, None, None)
    assert set(people) == {"p", "q"}


def test_dim_product_and_channel(tables):
    products = by(tables["dim_product"], "PRODUCT_ID")
    assert {k: r.CATEGORY for k, r in products.items()} == {
        "SYD901": "City Tour", "TAS902": "Island Tour", "NV33": "General", "NV35": "General",
        "QB77": "General", None: "General",
    }
    assert products[None].PRODUCT_ID_KEY is None and products[None].PRODUCT_NAME is None
    assert products["NV33"].PRODUCT_ID_KEY == 1 and products["NV33"].PRODUCT_NAME == "Nv33"
    channels = {(r.CHANNEL_ID, r.CHANNEL_NAME, r.CHANNEL_TYPE, r.CHANNEL_KEY) for r in tables["dim_channel"].collect()}
    assert channels == {
        ("ota", "Ota", "Online", 1), ("partner", "Partner", "Partner", 2),
        ("store", "Store", "Offline", 3), ("website", "Website", "Online", 4),
    }


def test_fact_orders(tables):
    rows = by(tables["fact_orders"], "ORDER_ID_SRC")
    order = sorted(rows.values(), key=lambda r: (r.ORDER_TS, r.ORDER_ID_SRC))
    assert [r.ORDER_KEY for r in order] == [f"ORD_{i:06d}" for i in range(1, 10)]
    assert rows["T51"].GROSS_AMOUNT == 213 and rows["T53"].GROSS_AMOUNT == 41
    assert rows["T51"].CHANNEL_ID == "store" and rows["E83"].PRODUCT_ID is None
    assert rows["T53"].ORDER_MONTH == date(2024, 4, 1)


def test_exact_amounts(tables):
    orders = gold.order_measures(tables["vw_orders_clean"], exact_amounts=True)
    assert by(orders, "ORDER_ID_SRC")["T51"].GROSS_AMOUNT == Decimal("212.50")


def test_order_keys_follow_the_join_rules(spark, tables):
    orders = spark.createDataFrame(
        [("1", " store", "qb77", "nobody"), ("2", "STORE", " QB77", None), ("3", "Store", "QB77", None)],
        "ORDER_ID_SRC string, SOURCE string, PRODUCT_ID string, PERSON_KEY string",
    )
    rows = by(
        gold.resolve_order_keys(orders, tables["dim_person"], tables["dim_product"], tables["dim_channel"]),
        "ORDER_ID_SRC",
    )
    assert [(r.CHANNEL_ID, r.PRODUCT_ID, r.PERSON_KEY) for r in (rows["1"], rows["2"], rows["3"])] == [
        (None, None, None), ("store", None, None), ("store", "QB77", None),
    ]


def test_every_source_id_finds_its_person(tables):
    ids = by(tables["person_source_ids"], "SRC_SYSTEM", "SRC_USER_ID")
    assert len(ids) == 9 and ids[("STORE", "a5")].PERSON_KEY == ids[("WEBSITE", "m1")].PERSON_KEY


def test_facts_keep_the_row_count(tables):
    assert tables["fact_orders"].count() == tables["vw_orders_clean"].count()
    assert tables["fact_inventory_snapshot"].count() == tables["vw_inventory_unified"].count()
    assert tables["bridge_person_identity_map"].count() == tables["vw_customer_unified"].count()


def test_snapshot_values(tables):
    rows = by(tables["fact_inventory_snapshot"], "PRODUCT_ID", "CHANNEL_ID")
    r = rows[("NV33", "ota")]
    assert (r.SYNC_DELAY_SEC, r.STATUS, r.SNAPSHOT_TS) == (350, "fresh", AS_OF)
    assert rows[("SYD901", "ota")].SYNC_DELAY_SEC is None


def test_keys_hold(tables):
    # the row of orders without a product code has no number, by design
    found = quality.all_key_violations(tables, gold.TABLE_KEYS).collect()
    assert {(r.table_name, r.key_name, r.key_value) for r in found} == {
        ("dim_product", "PRODUCT_ID_KEY", None), ("dim_product", "PRODUCT_ID", None),
    }


def test_build_ends_with_its_checks(tables):
    assert {(r.table_name, r.key_name) for r in tables["key_violations"].collect()} == {
        ("dim_product", "PRODUCT_ID_KEY"), ("dim_product", "PRODUCT_ID"),
    }
    assert {r.src_file: r.bad_rows for r in tables["bad_records"].collect()} == dict.fromkeys(
        ["users_store.csv", "users_website.csv", "orders_store.csv", "orders_website.csv", "orders_ota.csv",
         "inventory_store.csv", "inventory_partner.csv", "inventory_ota.json"], 0
    )
    assert {r.SOURCE: r.currency_mismatches for r in tables["parse_flags"].collect()} == {"STORE": 0, "WEBSITE": 0, "OTA": 1}
    assert {r.key_name: r.orphan_rows for r in tables["orphan_keys"].collect()}["PERSON_KEY"] == 2
    assert "AUX" in {r.currency for r in tables["currencies"].collect() if r.unknown_code}


def test_rebuild_gives_the_same(spark, raw, tables, tmp_path):
    again = pipeline.build(spark, raw, str(tmp_path), Settings(as_of=AS_OF))
    for name in pipeline.GOLD:
        assert again[name].exceptAll(tables[name]).count() == 0, name


# --- marts on the built tables -----------------------------------------------------------


def test_order_marts(tables):
    fact = tables["fact_orders"]
    days = {r.order_day.day: (r.total_orders, r.revenue_aud, r.aov_aud) for r in marts.daily_revenue(fact, AS_OF).collect()}
    assert days == {
        3: (1, 213, Decimal("213.00")), 10: (2, 258, Decimal("129.00")), 14: (1, 150, Decimal("150.00")),
        20: (1, 78, Decimal("78.00")),
    }
    top = [(r.PRODUCT_ID, r.orders, r.revenue_aud) for r in marts.top_products(fact, AS_OF, 2).collect()]
    assert top == [("NV33", 2, 334), ("SYD901", 1, 213)]
    mix = {r.STATUS: r.orders for r in marts.status_mix(fact, AS_OF).collect()}
    assert mix == {"paid": 5, "void": 1, "cancelled": 1, "refunded": 1}
    newest = marts.recent_orders(fact, tables["dim_person"], tables["dim_product"], 3).collect()
    assert [(r.FULL_NAME, r.PRODUCT_NAME) for r in newest] == [
        ("Mira Kosta", "Nv33"), ("Lin Quay", "Nv35"), ("Tom Udal", "Nv33"),
    ]


def test_customer_marts(tables):
    bridge, people = tables["bridge_person_identity_map"], tables["dim_person"]
    assert tuple(marts.dedup_rate(bridge, people).first()) == (8, 7, Decimal("12.50"))
    rates = marts.dedup_rate_by_source(tables["raw_users"], tables["vw_customer_unified"]).collect()
    assert [tuple(r) for r in rates] == [("STORE", 5, 4, Decimal("20.00")), ("WEBSITE", 4, 4, Decimal("0.00"))]
    estimate = marts.dedup_rate(bridge, people, approximate=True).first().unified_customers
    assert abs(estimate - 7) <= 1
    locales = [(r.LOCALE, r.users) for r in marts.users_by_locale(people).collect()]
    assert locales == [("AU", 4), ("GB", 1), ("HK", 1), (None, 1)]


def test_inventory_detail(tables):
    rows = marts.inventory_detail(
        tables["fact_inventory_snapshot"], tables["dim_product"], tables["dim_channel"], AS_OF
    ).collect()
    assert [(r.PRODUCT_ID, r.SOURCE_CHANNEL) for r in rows[:3]] == [("NV33", "Ota"), ("NV33", "Partner"), ("NV33", "Store")]
    assert rows[0].SYNC_DELAY_HOURS == Decimal("0.10") and rows[0].FRESHNESS_STATUS == "Fresh"
    assert rows[0].LAST_UPDATED_UTC == "2024-05-20 09:24:10"


# --- sinks -------------------------------------------------------------------------------


def test_refresh_may_read_its_own_table(spark, tmp_path):
    path = str(tmp_path / "t")
    stored = full_refresh(spark.range(3), path)
    assert sorted(r.id for r in full_refresh(stored.where("id > 0"), path).collect()) == [1, 2]
    assert os.listdir(tmp_path) == ["t"]


def test_failed_refresh_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    full_refresh(spark.range(3), path)
    with pytest.raises(Exception, match="(?i)raise|USER_RAISED"):
        full_refresh(spark.range(5).select(F.when(F.col("id") > 2, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id")), path)
    assert spark.read.parquet(path).count() == 3


def test_refresh_drops_old_partitions_in_dynamic_mode(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        full_refresh(spark.sql("SELECT 1 AS v, 'a' AS p UNION ALL SELECT 2, 'b'"), path, ("p",))
        assert [tuple(r) for r in full_refresh(spark.sql("SELECT 3 AS v, 'c' AS p"), path, ("p",)).collect()] == [(3, "c")]
        spark.sql("CREATE DATABASE IF NOT EXISTS scratch")
        full_refresh_table(spark.sql("SELECT 1 AS v, 'a' AS p"), "scratch.p", ("p",))
        assert full_refresh_table(spark.sql("SELECT 3 AS v, 'c' AS p"), "scratch.p", ("p",)).count() == 1
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_empty_partitioned_table_reads_back(spark, tmp_path):
    empty = spark.range(3).selectExpr("id", "id % 2 AS p").where("id < 0")
    assert full_refresh(empty, str(tmp_path / "e"), ("p",)).count() == 0


def test_refresh_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS scratch")
    full_refresh_table(spark.range(3), "scratch.t")
    assert full_refresh_table(spark.range(2), "scratch.t").count() == 2


def test_snapshots_add_up_by_day(spark, raw, tmp_path):
    out = str(tmp_path)
    for days in (0, 1, 1):
        st = Settings(as_of=AS_OF + timedelta(days=days), append_snapshots=True)
        tables = pipeline.build_gold(
            pipeline.build_silver(pipeline.build_bronze(spark, raw, out, st), out, st), out, st
        )
    counts = tables["fact_inventory_snapshot"].groupBy("SNAPSHOT_DATE").count().collect()
    assert {(r.SNAPSHOT_DATE.day, r["count"]) for r in counts} == {(20, 7), (21, 7)}


def test_append_snapshot_keeps_other_days(spark, tmp_path):
    row = "SELECT TIMESTAMP_NTZ'{}' AS SNAPSHOT_TS, {} AS v"
    for ts, v in (("2025-01-01 10:00:00", 1), ("2025-01-02 10:00:00", 2), ("2025-01-01 12:00:00", 3)):
        kept = append_snapshot(spark.sql(row.format(ts, v)), str(tmp_path / "s"))
    assert sorted(r.v for r in kept.collect()) == [2, 3]


def test_published_tables_answer_sql(spark, tables, out):
    names = publish(spark, out)
    assert "star.fact_orders" in names and "gold.dim_person" in names
    sql = """SELECT o.ORDER_TS, p.FULL_NAME, pr.PRODUCT_NAME, o.GROSS_AMOUNT
             FROM gold.fact_orders o JOIN gold.dim_person p ON o.PERSON_KEY = p.PERSON_KEY
             JOIN gold.dim_product pr ON o.PRODUCT_ID = pr.PRODUCT_ID ORDER BY o.ORDER_TS DESC LIMIT 3"""
    assert [r.FULL_NAME for r in spark.sql(sql).collect()] == ["Mira Kosta", "Lin Quay", "Tom Udal"]
    assert spark.sql("SELECT count(*) FROM raw.raw_users WHERE data:status::string = 'Active'").first()[0] == 4


def test_publish_spares_managed_tables(spark, tables, out):
    spark.sql("CREATE DATABASE IF NOT EXISTS raw")
    spark.sql("DROP TABLE IF EXISTS raw.raw_users")
    spark.sql("CREATE TABLE raw.raw_users USING parquet AS SELECT 1 AS mine")
    with pytest.raises(ValueError, match="raw_users"):
        publish(spark, out)
    assert spark.table("raw.raw_users").first().mine == 1
    spark.sql("DROP TABLE raw.raw_users")
    publish(spark, out)


def test_records_that_name_nobody_stay_apart(spark):
    rows = [(f'{{"name":"{n}","last_seen":"2024-01-0{i} 00:00:00"}}',) for i, n in ((1, "x"), (2, "y"), (2, "y"))]
    raw = spark.createDataFrame(rows, "j string").select(F.parse_json("j").alias("data"), F.lit("WHATSAPP").alias("src_system"))
    for mode in ("one_pass", "transitive"):
        keys = [r.PERSON_KEY for r in silver.customer_records(raw, Settings(as_of=AS_OF, identity_mode=mode)).collect()]
        assert None not in keys and len(set(keys)) == 2


def test_reference_goes_to_the_newest_record(spark):
    rows = [("STORE", "1", None, "old", datetime(2024, 1, 1)), ("STORE", "1", None, "new", datetime(2025, 1, 1)), ("STORE", "1", None, "aaa", None)]
    records = spark.createDataFrame(rows, "SRC_SYSTEM string, SRC_USER_ID string, EMAIL string, PERSON_KEY string, LAST_SEEN_UTC timestamp_ntz")
    assert [r.PERSON_KEY for r in silver.customer_references(records).collect()] == ["new"]


def test_row_order_does_not_matter(spark):
    schema = ", ".join(f"{c} string" for c in silver.CUSTOMER_COLUMNS[:7]) + ", LAST_SEEN_UTC timestamp_ntz, MATCH_CONFIDENCE decimal(3,2)"
    t, one = datetime(2025, 1, 1), Decimal(1)
    people = [("p", n, "e", "1", "AU", "S", "7", t, one) for n in ("Bob", "Ann", "Cy")]
    orders = [("7", "STORE", t, None, None, q, Decimal(q), "AUD", "paid") for q in (1, 2, 3)]
    order_schema = "ORDER_ID_SRC string, SOURCE string, ORDER_TS timestamp_ntz, PERSON_KEY string, PRODUCT_ID string, QTY bigint, GROSS_AMOUNT decimal(18,2), CURRENCY string, STATUS string"
    found = []
    for step in (1, -1):
        df = spark.createDataFrame(people[::step], schema).repartition(2)
        st = Settings(as_of=AS_OF)
        persons = gold.person_rows(df)
        fact = spark.createDataFrame(orders[::step], order_schema).repartition(3 if step > 0 else 1)
        none = spark.sql("SELECT 'x' AS PERSON_KEY, 'x' AS PRODUCT_ID, 'x' AS CHANNEL_ID")
        keyed = gold.fact_orders(fact, none, none, none, st)
        found.append((silver.unify_customers(df, st).collect(), persons.collect(), sorted((r.ORDER_KEY, r.QTY) for r in keyed.collect())))
    assert found[0] == found[1] and found[0][1][0].FULL_NAME == "Ann"


def test_broken_rows_are_kept(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n1,2\n1,2,3\n"p\nq",5\n7\n')
    file = RawFile("x", "STORE", "x.csv", ("a", "b"), multi_line=True)
    landed = land_entity(spark, str(tmp_path), "x", AS_OF, (file,))
    objects = sorted(r.j for r in landed.select(F.to_json("data").alias("j")).collect())
    assert objects == [
        '{"_corrupt_record":"1,2,3","a":"1","b":"2"}', '{"_corrupt_record":"7","a":"7"}', '{"a":"1","b":"2"}', '{"a":"p\\nq","b":"5"}',
    ]
    assert [tuple(r) for r in quality.bad_records(landed).collect()] == [("STORE", "x.csv", 4, 2)]


def test_parse_flags(spark, tables):
    parsed = silver.parsed_orders(tables["raw_orders"], Settings(as_of=AS_OF))
    assert {tuple(r) for r in quality.parse_flags(parsed).collect()} == {("STORE", 3, 0, 0), ("WEBSITE", 3, 0, 0), ("OTA", 3, 1, 3)}


def test_settings_refuse_unknown_choices():
    with pytest.raises(ValueError):
        Settings(as_of=AS_OF, identity_mode="fuzzy")
