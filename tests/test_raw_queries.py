"""How the queries over raw exports and arrays grow with their tables."""

import glob
import json

import pytest
from pyspark.sql import functions as F

from tidewell.registry import queries, raw_exports
from tidewell.registry.contract import Tables
from tidewell.session import shared_folder
from tidewell.sources.landing import field


def test_text_fields_are_read_as_text(spark, tmp_path):
    """Of a path the scan takes its text and its kind only; floating-point numbers keep all digits."""
    texts = ['{"a": 6.1e10}', '{"a": "6.1E10"}', '{"a": 1e300}', '{"a": 1.25e-5}', '{"a": 7}', '{"b": "x"}', '{"a": null, "b": 1.5e8}', '{"a": {"c": 1}}']
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string").select("id", F.parse_json("text").alias("data"))
    single = spark.range(8, 9).selectExpr("CAST(id AS INT) AS id", "to_variant_object(named_struct('a', CAST(1.1e10 AS FLOAT))) AS data")
    rows.union(single).write.parquet(f"{tmp_path}/landed")
    found = spark.read.parquet(f"{tmp_path}/landed").select("id", field("a", "b").alias("value"))
    assert [r.value for r in sorted(found.collect())] == [
        "61000000000", "6.1E10", "1.0E300", "0.0000125", "7", "x", "150000000", '{"c":1}', "11000000512",
    ]
    assert "decimal" not in found._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]


def test_exports_join_their_tables_once(spark, tmp_path, monkeypatch):
    made = []
    monkeypatch.setattr(Tables, "source_customers", lambda self: made.append("users") or spark.createDataFrame([("STORE", 1), ("OTA", 2)], "SRC_SYSTEM string, c_custkey long"))
    monkeypatch.setattr(raw_exports, "_all_orders", lambda t: made.append("orders") or spark.createDataFrame([("STORE", 1), ("OTA", 2)], "SOURCE string, o_orderkey long"))
    t = Tables(spark, f"{tmp_path}/tables")
    sources = ("STORE", "WEBSITE", "OTA")
    assert [raw_exports._users(t, s).count() for s in sources] == [1, 0, 1]
    assert [raw_exports._orders(t, s).count() for s in sources] == [1, 0, 1]
    assert sorted(made) == ["orders", "users"]


def test_streams_need_the_exports_only(spark, tmp_path, monkeypatch):
    def refuse(*args, **kw):
        raise AssertionError("a build")

    monkeypatch.setattr(queries.pipeline, "build", refuse)
    monkeypatch.setattr(queries, "write_exports", lambda t, root: root)
    monkeypatch.setattr(queries.streaming, "take_in", lambda *args: None)
    monkeypatch.setattr(queries.streaming, "views", lambda *args: {"vw_customer_unified": "found"})
    assert queries.streaming_customers(Tables(spark, f"{tmp_path}/none")) == "found"


def test_streamed_views_are_stored_before_gold(spark, tmp_path, monkeypatch):
    views = {"vw_customer_unified": spark.range(3), "vw_orders_clean": spark.range(2)}
    monkeypatch.setattr(queries, "_streamed", lambda t: views)
    monkeypatch.setattr(queries.pipeline, "build_gold", lambda found, *args: {"fact_orders": found})
    found = queries.streaming_fact_orders(Tables(spark, f"{tmp_path}/none"))
    assert {n: (v.count(), bool(v.inputFiles())) for n, v in found.items()} == {n: (v.count(), True) for n, v in views.items()}


@pytest.mark.parametrize("rows, arrays", [(5, 2), (37, 4)])
def test_more_events_are_more_arrays(spark, tmp_path, monkeypatch, rows, arrays):
    monkeypatch.setattr(queries, "ARRAY_ROWS", 10)
    table = [(n, n % 3, "view", json.dumps({"k": n})) for n in [*range(rows - 1), 0]]  # one id twice
    spark.createDataFrame(table, "event_id long, user_id long, event_type string, props string").write.parquet(f"{tmp_path}/events.parquet")
    before = set(glob.glob(f"{shared_folder(spark)}/*/json-arrays-*"))
    found = queries.json_array_split(Tables(spark, str(tmp_path)))
    assert sorted(map(tuple, found.collect())) == sorted((e, u, k, '}],"\\' + p) for e, u, k, p in table)
    (path,) = set(glob.glob(f"{shared_folder(spark)}/*/json-arrays-*")) - before
    assert len(glob.glob(f"{path}/file=*/part-*")) == arrays
