"""Identity in batches against one build from nothing."""

import random

import pytest
from pyspark.sql import functions as F

from tidewell.operators.identity import transitive_keys
from tidewell.operators.identity_store import IdentityStore
from tidewell.sources.sinks import put_batch, stored_batches

SCHEMA = "SRC_SYSTEM string, SRC_USER_ID string, EMAIL string, PHONE string"


def records(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def keyed(df):
    return sorted((r["SRC_USER_ID"], r["PERSON_KEY"]) for r in df.collect())


def batches(rng, n=4, size=40, names=30):
    def pick(kind):
        return f"{kind}{rng.randrange(names)}" if rng.random() < 0.8 else None

    return [[("STORE", f"{b}-{i}", pick("m"), pick("4")) for i in range(size)] for b in range(n)]


@pytest.mark.parametrize("seed, names, broadcast_rows", [(1, 200, 500_000), (2, 60, 0)])
def test_batches_equal_one_build(spark, tmp_path, no_auto_broadcast, seed, names, broadcast_rows):
    store = IdentityStore(f"{tmp_path}/store", broadcast_rows)
    seen, before = [], {}
    for number, batch in enumerate(batches(random.Random(seed), names=names)):
        store.add(records(spark, batch), number)
        seen += batch
        everything = records(spark, seen)
        now = keyed(store.keys(everything))
        assert now == keyed(transitive_keys(everything))
        log = {r["old_key"]: r["new_key"] for r in store.merge_log(spark).where(F.col("batch") == number).collect()}
        after = dict(now)
        assert all(after[user] == log.get(key, key) for user, key in before.items())
        assert set(log) <= set(before.values())
        before = after


def test_a_batch_run_again_replaces_itself(spark, tmp_path):
    store = IdentityStore(f"{tmp_path}/store")
    first, second = batches(random.Random(3), n=2)
    store.add(records(spark, first), 0)
    store.add(records(spark, batches(random.Random(4))[0]), 1)  # a batch that turns out to be wrong
    store.add(records(spark, second), 1)
    everything = records(spark, first + second)
    assert keyed(store.keys(everything)) == keyed(transitive_keys(everything))
    assert stored_batches(spark, f"{tmp_path}/store/members") == [0, 1]
    with pytest.raises(ValueError, match="rests on"):
        store.add(records(spark, first), 0)


def test_a_batch_that_broke_off_is_not_there(spark, tmp_path):
    store = IdentityStore(f"{tmp_path}/store")
    rows = [("STORE", "1", "b", "9"), ("STORE", "2", "c", "9")]
    store.add(records(spark, rows), 0)
    put_batch(spark.createDataFrame([("e:b", "e:a", True)], "node string, root string, merged boolean"), f"{tmp_path}/store/moves", 1)
    assert keyed(store.keys(records(spark, rows))) == keyed(transitive_keys(records(spark, rows)))
    assert store.merge_log(spark).isEmpty()


def test_only_touched_components_are_written(spark, tmp_path):
    store = IdentityStore(f"{tmp_path}/store")
    store.add(records(spark, [("STORE", str(i), f"m{i}", f"{i}") for i in range(100)]), 0)
    store.add(records(spark, [("STORE", "x", "m7", "8"), ("STORE", "y", "new", None)]), 1)
    moves = spark.read.parquet(f"{tmp_path}/store/moves/batch=1").collect()
    assert [(r["node"], r["root"], r["merged"]) for r in moves] == [("e:m8", "e:m7", True)]
    assert [r["node"] for r in spark.read.parquet(f"{tmp_path}/store/members/batch=1").collect()] == ["e:new"]


def test_nothing_to_add(spark, tmp_path):
    store = IdentityStore(f"{tmp_path}/store")
    assert store.components(spark).isEmpty()
    store.add(records(spark, []), 0)
    store.add(records(spark, [("STORE", "1", None, None)]), 1)
    alone = records(spark, [("STORE", "1", None, None), ("STORE", "2", "m", None)])
    assert keyed(store.keys(alone)) == keyed(transitive_keys(alone))
