"""Known totals of the sellers' sample exports; set RAW_SAMPLE_DIR to the folder holding them."""

import os
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewell.plans import marts, pipeline
from tidewell.settings import Settings

ROOT = os.environ.get("RAW_SAMPLE_DIR")
pytestmark = pytest.mark.skipif(not ROOT, reason="RAW_SAMPLE_DIR is not set")
AS_OF = datetime(2025, 10, 16, 12)


@pytest.fixture(scope="module", params=["one_pass", "transitive"])
def tables(request, spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp(request.param))
    return pipeline.build(spark, ROOT, out, Settings(as_of=AS_OF, identity_mode=request.param))


def test_totals(tables):
    counts = {n: tables[n].count() for n in tables}
    assert counts["raw_users"] == 306 and counts["dim_person"] == 247
    assert counts["fact_orders"] == 560 and counts["fact_inventory_snapshot"] == 45
    assert counts["dim_product"] == 15 and counts["dim_channel"] == 4
    assert tables["dim_product"].where("CATEGORY = 'City Tour'").count() == 1


def test_revenue(tables):
    paid = tables["fact_orders"].where("STATUS = 'paid'")
    per_channel = {r[0]: r[1] for r in paid.groupBy("CHANNEL_ID").agg(F.sum("GROSS_AMOUNT")).collect()}
    assert per_channel == {"store": 39290, "website": 50489, "ota": 32703}
    assert paid.count() == 473
    exact = tables["vw_orders_clean"].where("STATUS = 'paid'").agg(F.sum("GROSS_AMOUNT")).first()[0]
    assert exact == Decimal("122471.74")
    assert marts.top_products(paid, AS_OF, 1).first()[0::2] == ("HK012", 13161)


def test_orders_without_known_customer(tables):
    lost = tables["fact_orders"].where("PERSON_KEY IS NULL").groupBy("CHANNEL_ID").count().collect()
    assert [tuple(r) for r in lost] == [("ota", 103)]
    assert tables["vw_orders_clean"].where("ORDER_TS IS NULL").count() == 0
