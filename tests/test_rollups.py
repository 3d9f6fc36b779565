"""Rollups after changes against the same sums over the orders as they are."""

import random
from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewell.operators import rollups
from tidewell.operators.rollups import VERSIONS, OrderRollup
from tidewell.sources.sinks import put_batch, stored_batches


def order(rng, number):
    time = datetime(2024, 1, 30) + timedelta(hours=rng.randrange(100)) if rng.random() < 0.95 else None
    amount = Decimal(rng.randrange(1, 10_000)) / 100 if rng.random() < 0.9 else None
    return (f"o{number}", time, rng.choice(["paid", "refunded", None]), rng.choice("ab"), rng.choice("xyz"), amount, rng.random() < 0.1)


def sums(orders):
    count, amount = Counter(), Counter()
    for _, time, *key, value, deleted in orders:
        if not deleted:
            place = (time and time.date(), time and time.hour, *key)
            count[place] += 1
            amount[place] += value or 0
    return sorted(((*k, n, amount[k]) for k, n in count.items()), key=repr)


def found(rollup, spark, **options):
    return sorted(((*r[:5], r[5], r[6] or Decimal(0)) for r in (tuple(r) for r in rollup.rows(spark, **options).collect())), key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, VERSIONS).withColumn("other", F.lit(1)).repartition(3)


def same(a, b):
    return [(*x[:6], Decimal(x[6]).normalize() + 0) for x in a] == [(*x[:6], Decimal(x[6]).normalize() + 0) for x in b]


def test_changes_are_taken_back_and_added(spark, tmp_path):
    rng, rollup, current = random.Random(1), OrderRollup(str(tmp_path)), {}
    for batch in range(4):
        changes = [order(rng, rng.randrange(60)) for _ in range(40)] if batch else [order(rng, i) for i in range(60)]
        changes = list({o[0]: o for o in changes}.values())
        rollup.add(frame(spark, changes), batch)
        current |= {o[0]: o for o in changes}
        assert same(found(rollup, spark), sums(current.values()))


def test_only_touched_days_are_written_and_months_pruned(spark, tmp_path):
    rollup, rng = OrderRollup(str(tmp_path)), random.Random(2)
    orders = [("a", datetime(2024, 1, 5), "paid", "c", "p", Decimal(5), False), ("b", datetime(2024, 2, 5), "paid", "c", "p", Decimal(7), False)]
    rollup.add(frame(spark, orders + [("c", datetime(2023, 5, 1), "paid", "c", "p", Decimal(1), False)]), 0)
    rollup.add(frame(spark, [("a", datetime(2024, 2, 6), "paid", "c", "p", Decimal(5), False), orders[1]]), 1)
    written = spark.read.parquet(f"{tmp_path}/deltas/batch=1").collect()
    assert sorted((str(r.ORDER_DAY), r.ORDERS) for r in written) == [("2024-01-05", -1), ("2024-02-06", 1)]
    recent = rollup.rows(spark, "2024-02-01")
    assert sorted(str(r.ORDER_DAY) for r in recent.collect()) == ["2024-02-05", "2024-02-06"]
    assert all("2024-02-01" in f for f in recent.inputFiles()) or "PartitionFilters: [isnotnull(ORDER_MONTH" in recent._jdf.queryExecution().toString()


def test_a_batch_run_again_replaces_itself(spark, tmp_path):
    rng, rollup = random.Random(3), OrderRollup(str(tmp_path))
    first, wrong, right = ([order(rng, i) for i in range(20)] for _ in range(3))
    rollup.add(frame(spark, first), 0)
    rollup.add(frame(spark, wrong), 1)
    rollup.add(frame(spark, right[:10]), 1)
    assert same(found(rollup, spark), sums(right[:10] + first[10:]))
    with pytest.raises(ValueError, match="rests on"):
        rollup.add(frame(spark, first), 0)
    put_batch(spark.read.parquet(f"{tmp_path}/deltas/batch=1"), f"{tmp_path}/deltas", 2)  # broke off before its versions
    assert same(found(rollup, spark), sums(right[:10] + first[10:]))


def test_the_latest_of_several_rows_counts(spark, tmp_path):
    rollup = OrderRollup(str(tmp_path))
    rows = [("a", datetime(2024, 1, d), "paid", "c", "p", Decimal(d), False) for d in (3, 9, 5)]
    rollup.add(frame(spark, rows), 0)
    assert [(str(r.ORDER_DAY), r.ORDERS) for r in rollup.rows(spark).collect()] == [("2024-01-09", 1)]
    assert rollups.status_mix(rollup.rows(spark)).collect()[0].orders == 1


def test_empty_rollup(spark, tmp_path):
    rollup = OrderRollup(str(tmp_path))
    assert rollup.rows(spark).isEmpty()
    rollup.add(frame(spark, []), 0)
    assert rollup.rows(spark).isEmpty() and stored_batches(spark, f"{tmp_path}/versions") == [0]
