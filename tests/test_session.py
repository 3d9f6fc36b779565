"""The folder for intermediate tables."""

import os
import subprocess
import sys

import pytest

from tidewell.session import STAGING_KEY, drop_staged, shared_folder, stage, staging

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

STOCK = """
import os, sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry_points
from tidewell.session import drop_staged, local_session, shared_folder
spark = local_session(4)
assert spark.conf.get("spark.checkpoint.dir", None) is None
for name in ("daily_orders_by_channel", "recent_orders", "fact_orders", "full_refresh_sink"):
    assert entry_points.queries()[name](spark, sys.argv[2]).count() > 0
folder = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"
assert os.listdir(folder)
drop_staged(spark)
assert not os.path.exists(folder)
print("done")
"""


def test_stock_session(data, tmp_path):
    """Nothing set at all: a local session stages below its own temporary folder, and can clear it."""
    (tmp_path / "conf").mkdir()
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path / "conf"), "TMPDIR": str(tmp_path)}
    run = subprocess.run([sys.executable, "-c", STOCK, ROOT, data], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert run.stdout.strip().endswith("done"), run.stderr[-2000:]


def test_setting_of_a_running_session(spark, tmp_path):
    old = spark.conf.get(STAGING_KEY, None)
    spark.conf.set(STAGING_KEY, f"{tmp_path}/mine/")
    try:
        assert shared_folder(spark) == f"{tmp_path}/mine"
        assert stage(spark.range(3), "x").count() == 3
        app = f"{tmp_path}/mine/{spark.sparkContext.applicationId}"
        with staging(spark) as folder:
            stage(spark.range(3), "y")
            assert folder.startswith(app) and os.listdir(folder)
        assert not os.path.exists(folder) and len(os.listdir(app)) == 1
        drop_staged(spark)
        assert not os.path.exists(app)
    finally:
        spark.conf.unset(STAGING_KEY) if old is None else spark.conf.set(STAGING_KEY, old)


def test_a_cluster_must_name_its_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "local-cluster[2,1,1024]"})

    with pytest.raises(RuntimeError, match=STAGING_KEY):
        shared_folder(Session())


def test_a_result_may_outlive_its_block(spark):
    with staging(spark):
        with staging(spark):
            inner, result = stage(spark.range(3), "inner"), stage(spark.range(4), "result", outlive=True)
        with pytest.raises(Exception, match="does not exist|NOT_EXIST"):
            inner.count()
        assert result.count() == 4
    with pytest.raises(Exception, match="does not exist|NOT_EXIST"):
        result.count()
    with staging(spark):
        kept = stage(spark.range(5), "kept", outlive=True)
    assert kept.count() == 5
