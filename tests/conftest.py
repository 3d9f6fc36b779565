import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from tidewell.session import local_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = local_session(8, **{"spark.sql.warehouse.dir": warehouse, "spark.sql.shuffle.partitions": "4"})
    session.conf.set("spark.sql.maxMetadataStringLength", "4000")
    yield session
    session.stop()


@pytest.fixture
def no_auto_broadcast(spark):
    """Small test tables would otherwise never take the shuffled path."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("test tables not available")
    return DATA
