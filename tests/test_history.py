"""Intervals against a full copy of every day."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql.types import IntegerType, StringType, StructType, TimestampNTZType

from tidewell.operators import history as module
from tidewell.operators.history import History
from tidewell.sources.sinks import put_batch, stored_batches

SCHEMA = StructType().add("k", StringType()).add("n", IntegerType()).add("at t", TimestampNTZType())
START = date(2024, 2, 27)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def days(rng, n):
    table = [(rng.choice("abc") if rng.random() < 0.9 else None, rng.choice([1, 2, None]), datetime(2024, 1, rng.randint(1, 3))) for _ in range(30)]
    for i in range(n):
        yield START + timedelta(days=i if i < 3 else i + 2), list(table)
        for _ in range(4):
            table.pop(rng.randrange(len(table)))
            table.append((rng.choice("abc"), rng.randint(1, 9), None))


def test_every_day_is_what_it_was(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(module, "COPIES", 2)
    history, copies = History(str(tmp_path), SCHEMA), {}
    for day, table in days(random.Random(1), 5):
        history.record(frame(spark, table), day)
        copies[day] = sorted(table, key=repr)
    for day, table in copies.items():
        assert rows(history.as_of(spark, day)) == table
    assert rows(history.as_of(spark, START + timedelta(days=4))) == copies[START + timedelta(days=2)]  # a day not recorded
    assert rows(history.as_of(spark, START - timedelta(days=1))) == []
    stored = history.intervals(spark).count()
    assert stored <= 30 + 5 * 8 < sum(map(len, copies.values()))


def test_unchanged_days_store_nothing(spark, tmp_path):
    history = History(str(tmp_path), SCHEMA)
    table = [("a", 1, None), ("a", 1, None), (None, None, None)]
    for i in range(4):
        history.record(frame(spark, table), START + timedelta(days=i))
    assert history.intervals(spark).count() == 2
    assert stored_batches(spark, f"{tmp_path}/open") == [20240301]


def test_a_day_recorded_again_replaces_itself(spark, tmp_path):
    history = History(str(tmp_path), SCHEMA)
    first, wrong, right = [("a", 1, None), ("b", 1, None)], [("c", 1, None)], [("a", 1, None), ("d", 4, None)]
    history.record(frame(spark, first), START)
    history.record(frame(spark, wrong), START + timedelta(days=1))
    history.record(frame(spark, right), START + timedelta(days=1))
    assert rows(history.as_of(spark, START)) == first and rows(history.as_of(spark, START + timedelta(days=1))) == right
    assert history.intervals(spark).count() == 3
    with pytest.raises(ValueError, match="cannot be recorded"):
        history.record(frame(spark, first), START)


def test_a_day_that_broke_off_is_not_there(spark, tmp_path):
    history = History(str(tmp_path), SCHEMA)
    history.record(frame(spark, [("a", 1, None)]), START)
    gone = spark.createDataFrame([("a", 1, None, START, START + timedelta(days=1), 1)], "k string, n int, `at t` timestamp_ntz, VALID_FROM date, VALID_TO date, COPIES long")
    put_batch(gone, f"{tmp_path}/closed", 20240228)
    assert rows(history.as_of(spark, START)) == rows(history.as_of(spark, START + timedelta(days=1))) == [("a", 1, None)]


def test_empty_days(spark, tmp_path):
    history = History(str(tmp_path), SCHEMA)
    assert history.intervals(spark).isEmpty()
    history.record(frame(spark, []), START)
    history.record(frame(spark, [("a", 1, None)]), START + timedelta(days=1))
    history.record(frame(spark, []), START + timedelta(days=2))
    assert [len(rows(history.as_of(spark, START + timedelta(days=i)))) for i in range(3)] == [0, 1, 0]
