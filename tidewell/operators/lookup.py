"""Left (or inner) joins to tables with unique keys that hold up under hot keys.

For each table one of three ways is chosen by measured sizes:

* the table is small, by rows and by bytes: broadcast it, the fact is not shuffled;
* otherwise shuffle both sides on the key, but take out of the shuffle the keys that own
  more than ``HOT_SHARE`` of the fact. There are at most ``1 / HOT_SHARE`` of those, so
  their rows always fit a broadcast; the rows of hot keys, and rows without a key, are
  spread over all partitions by a slot number that matches nothing on the other side;
* a big table and no hot or missing key: the same plan, with nothing to spread.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType, VariantType

from tidewell.session import stage

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
HOT_SHARE = 0.001
SLOTS = 1 << 20


@dataclass(frozen=True)
class Lookup:
    """``on``: key column of ``table`` -> fact expression; ``take``: new name -> its column.

    The key must be unique in ``table``. A NULL key matches nothing; ``how="inner"`` drops
    rows without a match. A taken column may replace one of the fact.
    """

    table: DataFrame
    on: dict[str, Column]
    take: dict[str, str]
    how: str = "left"


def _all_set(names: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(n).isNotNull() for n in names])


def _fits_broadcast(table: DataFrame, rows: int, size: int) -> bool:
    """Whether rows and bytes are within bounds; values of unknown size are never broadcast."""
    if any(isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType)) for f in table.schema.fields):
        return False
    width = F.lit(8 * len(table.columns))
    for f in table.schema.fields:
        if isinstance(f.dataType, (StringType, BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
    n, total = table.agg(F.count("*"), F.sum(width)).first()
    return n <= rows and (total or 0) <= size


def _hot_keys(fact: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    per_key = fact.where(_all_set(keys)).groupBy(*keys).agg(F.count("*").alias("__n"))
    return stage(per_key.where(F.col("__n") > F.lit(threshold)).select(*keys), "hot-keys")


def _shuffled_join(
    fact: DataFrame, table: DataFrame, hot: DataFrame, keys: list[str], took: list[str], how: str
) -> DataFrame:
    hot_found = table.join(F.broadcast(hot), keys, "inner")
    hot_rows = hot.join(F.broadcast(hot_found), keys, "left").select(
        *keys,
        F.lit(True).alias("__hot"),
        F.col("__match").alias("__hot_match"),
        *[F.col(t).alias(f"__hot{t}") for t in took],
    )
    stays = F.col("__hot").isNull() & _all_set(keys)
    marked = fact.join(F.broadcast(hot_rows), keys, "left").withColumn(
        "__slot", F.when(stays, 0).otherwise(1 + F.pmod("__spread", F.lit(SLOTS)))
    )
    # always 0, but not a literal: the optimizer would take that out of the join keys
    zero = F.xxhash64(*[F.col(k) for k in keys]) % 1
    joined = marked.join(table.withColumn("__slot", zero), [*keys, "__slot"], "left")
    if how == "inner":
        joined = joined.where(F.coalesce("__match", "__hot_match"))
    return joined.select(*fact.columns, *[F.coalesce(f"__hot{t}", t).alias(t) for t in took])


def lookups(
    fact: DataFrame,
    wanted: list[Lookup],
    *,
    broadcast_rows: int = BROADCAST_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Add columns of several tables to ``fact``.

    All keys are expressions over ``fact`` as given, so their hot values are counted on
    ``fact`` itself, not on the result of an earlier join. Store an expensive ``fact`` first.
    """
    key_names = [[f"__key{i}_{j}" for j in range(len(w.on))] for i, w in enumerate(wanted)]
    take_names = [[f"__take{i}_{j}" for j in range(len(w.take))] for i, w in enumerate(wanted)]
    tables = [
        w.table.select(
            *[F.col(c).alias(k) for c, k in zip(w.on, keys)],
            *[F.col(c).alias(t) for c, t in zip(w.take.values(), took)],
            F.lit(True).alias("__match"),
        ).where(_all_set(keys))
        for w, keys, took in zip(wanted, key_names, take_names)
    ]
    small = [_fits_broadcast(t, broadcast_rows, broadcast_bytes) for t in tables]

    replaced = {name for w in wanted for name in w.take}
    kept = [c for c in fact.columns if c not in replaced]
    exprs = [e.alias(k) for w, keys in zip(wanted, key_names) for e, k in zip(w.on.values(), keys)]
    rows = fact.select(*fact.columns, *exprs)
    threshold = 0.0
    if not all(small):
        threshold = fact.count() * hot_share
        # the input partition tells apart copies of one row
        spread = F.xxhash64(*[F.col(c) for c in fact.columns], F.spark_partition_id())
        rows = rows.withColumn("__spread", spread)
    counted = rows
    for w, table, keys, took, is_small in zip(wanted, tables, key_names, take_names, small):
        if is_small:
            rows = rows.join(F.broadcast(table.drop("__match")), keys, w.how)
        else:
            rows = _shuffled_join(rows, table, _hot_keys(counted, keys, threshold), keys, took, w.how)
    taken = [F.col(t).alias(n) for w, took in zip(wanted, take_names) for t, n in zip(took, w.take)]
    return rows.select(*kept, *taken)


def lookup(
    fact: DataFrame, table: DataFrame, on: dict[str, Column], take: dict[str, str], how: str = "left", **options
) -> DataFrame:
    """``lookups`` for one table."""
    return lookups(fact, [Lookup(table, on, take, how)], **options)
