"""Person identity kept from build to build: a batch of records touches only the components it joins.

The store is a forest two levels deep, in two tables that only grow. ``members`` has every
identifier once, with the root its component had at the end of the batch that brought it. ``moves``
says which root hangs on which other since; if that one moves as well, its rows are written again
with the newer batch. No edge is kept: a new edge joins the components its ends are in, so a batch
is solved on the graph of its own edges with known identifiers replaced by their roots. A root is
the smallest identifier of its component, as in a build from nothing, so both give the same keys.

A batch is there when its ``members`` are; until then its ``moves`` are not read. Running the last
batch again replaces it; an earlier one cannot be run again, as later ones rest on it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.identity import component_keys, connected_components, identifier_pairs, identifiers
from tidewell.operators.lookup import BROADCAST_ROWS, lookup
from tidewell.session import stage
from tidewell.sources.sinks import put_batch, read_batches, stored_batches

MEMBERS = "node string, root string"
MOVES = "node string, root string, merged boolean"


@dataclass(frozen=True)
class IdentityStore:
    path: str
    broadcast_rows: int = BROADCAST_ROWS

    def add(self, records: DataFrame, batch: int, email: str = "EMAIL", phone: str = "PHONE") -> None:
        """Take in the identifiers of the records and what they join."""
        spark = records.sparkSession
        later = [n for n in stored_batches(spark, self._members) if n > batch]
        if later:
            raise ValueError(f"batch {batch} cannot be added: batch {later[-1]} rests on those before it")
        placed = stage(self._placed(identifiers(records, email, phone), batch), "placed-identifiers")
        pairs = identifier_pairs(records, email, phone)
        for end in ("a", "b"):
            pairs = self._replaced(pairs, end, placed, {"node": F.col(end)}, "start")
        joined = connected_components(pairs.distinct(), broadcast_rows=self.broadcast_rows)
        joined = stage(joined, "joined-roots")

        moved = joined.where("node <> root")
        merged = moved.join(placed.where("NOT is_new").select(F.col("start").alias("node")).distinct(), "node", "left_semi")
        merged = stage(merged, "merged-roots")
        current = self._current(spark, batch)
        repointed = lookup(
            current, merged, {"node": F.col("root")}, {"root": "root"}, how="inner", broadcast_rows=self.broadcast_rows
        )
        moves = merged.withColumn("merged", F.lit(True)).unionByName(repointed.withColumn("merged", F.lit(False)))
        put_batch(moves.select("node", "root", "merged"), self._moves, batch)
        new = placed.where("is_new").select("node", F.col("start").alias("root"))
        new = self._replaced(new, "root", joined, {"node": F.col("root")}, "root")
        put_batch(new.select("node", "root"), self._members, batch)

    def components(self, spark: SparkSession) -> DataFrame:
        """``(node, root)`` of every identifier as of the last batch."""
        members = read_batches(spark, self._members, MEMBERS)
        return self._replaced(members, "root", self._current(spark), {"node": F.col("root")}, "root").select("node", "root")

    def keys(self, records: DataFrame, **columns: str) -> DataFrame:
        """Add the person key of each record as of the last batch, as ``transitive_keys`` does."""
        components = stage(self.components(records.sparkSession), "components")
        return component_keys(records, components, broadcast_rows=self.broadcast_rows, **columns)

    def merge_log(self, spark: SparkSession) -> DataFrame:
        """``(batch, old_key, new_key)``: which person key became which."""
        last = self._after(spark)
        merged = read_batches(spark, self._moves, MOVES, last).where("merged")
        return merged.select("batch", F.sha2("node", 256).alias("old_key"), F.sha2("root", 256).alias("new_key"))

    # --- parts -------------------------------------------------------------------------------

    @property
    def _members(self) -> str:
        return f"{self.path}/members"

    @property
    def _moves(self) -> str:
        return f"{self.path}/moves"

    def _after(self, spark: SparkSession) -> int:
        return max(stored_batches(spark, self._members), default=-1) + 1

    def _current(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """Where each root that ever moved hangs after the batches before this one."""
        upto = self._after(spark) if before is None else before
        rows = read_batches(spark, self._moves, MOVES, upto)
        return stage(rows.groupBy("node").agg(F.max_by("root", "batch").alias("root")), "moved-roots")

    def _replaced(self, rows: DataFrame, column: str, table: DataFrame, on: dict, take: str) -> DataFrame:
        """``rows`` with ``column`` replaced by what the table has for it, if anything."""
        found = lookup(rows, table, on, {"__found": take}, broadcast_rows=self.broadcast_rows)
        return found.withColumn(column, F.coalesce("__found", column)).drop("__found")

    def _placed(self, nodes: DataFrame, batch: int) -> DataFrame:
        """``(node, start, is_new)``: the root of each identifier before this batch, or itself."""
        spark = nodes.sparkSession
        members = read_batches(spark, self._members, MEMBERS, batch).select("node", "root")
        # both sides have an identifier once; the batch is the small one
        found = members.join(nodes, "node", "left_semi")
        found = self._replaced(stage(found, "known-identifiers"), "root", self._current(spark, batch), {"node": F.col("root")}, "root")
        placed = nodes.join(found, "node", "left")
        return placed.select("node", F.coalesce("root", "node").alias("start"), F.col("root").isNull().alias("is_new"))
