"""Person identity across channels: records that share an e-mail or a phone are one person.

``one_pass`` keys a record by its best identifier; no shuffle at all. ``transitive`` follows
chains (A and B share an e-mail, B and C a phone) by connected components over identifiers.
Both key a person by the smallest identifier, so they agree wherever no chain exists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.lookup import BROADCAST_ROWS, lookup
from tidewell.session import stage


def _email_node(email: Column) -> Column:
    return F.concat(F.lit("e:"), email)


def _phone_node(phone: Column) -> Column:
    return F.concat(F.lit("p:"), phone)


def _best_identifier(email: Column, phone: Column, source: Column, user_id: Column, record: Column) -> Column:
    named = F.concat(F.lit("r:"), F.coalesce(source, F.lit("")), F.lit(":"), user_id)
    nameless = F.concat(F.lit("x:"), F.coalesce(source, F.lit("")), F.lit(":"), record)
    return F.coalesce(_email_node(email), _phone_node(phone), named, nameless)


def one_pass_key(
    email: Column, phone: Column, source: Column, user_id: Column, record: Column | None = None
) -> Column:
    """Person key from the normalised e-mail, else the phone, else the user id, else the record.

    ``record`` identifies a record's content; without it a record with no identifier has no key.
    """
    return F.sha2(_best_identifier(email, phone, source, user_id, F.lit(None) if record is None else record), 256)


def connected_components(
    edges: DataFrame, *, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``(a, b)`` edges -> ``(node, root)`` for every node, root = smallest node of its component.

    Alternates the large-star and small-star steps of Kiveris et al. (2014), which need a
    logarithmic number of rounds in practice even for long chains. A step hangs each
    neighbour of a node on the node's smallest neighbour; the minimum is reduced map-side and
    handed back through ``lookup``, so a hub with a huge neighbourhood is never one group.
    """

    def attach(pairs: DataFrame, mins: DataFrame) -> DataFrame:
        return lookup(
            pairs, mins, {"a": F.col("a")}, {"low": "low"}, how="inner", broadcast_rows=broadcast_rows
        )

    # every edge points from the larger node a to the smaller node b
    edges = stage(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    while not _is_forest_of_stars(edges):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        mins = stage(both.groupBy("a").agg(F.least("a", F.min("b")).alias("low")), "large-mins")
        upward = edges.select(F.col("b").alias("a"), F.col("a").alias("far"))
        large = stage(
            attach(upward, mins).select(F.col("far").alias("a"), F.col("low").alias("b")), "large-star"
        )

        mins = stage(large.groupBy("a").agg(F.min("b").alias("low")), "small-mins")
        moved = attach(large, mins).where("b <> low").select(
            F.col("b").alias("a"), F.col("low").alias("b")
        )
        kept = mins.select("a", F.col("low").alias("b"))
        edges = stage(moved.union(kept).distinct(), "small-star")

    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Done when every child has one parent and no parent is a child."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("parent")).union(
        edges.select("b", F.lit(0), F.lit(1))
    )
    broken = (
        ends.groupBy("node")
        .agg(F.sum("child").alias("parents"), F.max("parent").alias("is_parent"))
        .where("parents > 1 OR (parents = 1 AND is_parent = 1)")
    )
    return broken.isEmpty()


def identifier_pairs(records: DataFrame, email: str, phone: str) -> DataFrame:
    """``(a, b)``: identifiers that stand in one record."""
    e, p = F.col(email), F.col(phone)
    named = records.where(e.isNotNull() & p.isNotNull())
    return named.select(_email_node(e).alias("a"), _phone_node(p).alias("b")).distinct()


def identifiers(records: DataFrame, email: str, phone: str) -> DataFrame:
    """``node``: every e-mail and phone of the records."""
    both = F.array(_email_node(F.col(email)), _phone_node(F.col(phone)))
    return records.select(F.explode(both).alias("node")).where("node IS NOT NULL").distinct()


def transitive_keys(
    records: DataFrame,
    email: str = "EMAIL",
    phone: str = "PHONE",
    source: str = "SRC_SYSTEM",
    user_id: str = "SRC_USER_ID",
    out: str = "PERSON_KEY",
    record: str | None = None,
    *,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add the person key of each record's component.

    Nodes are identifiers, not records: copies of one e-mail / phone pair collapse to a single
    edge before anything else happens, and a record needs just one lookup at the end.
    """
    pairs = identifier_pairs(records, email, phone)
    components = stage(connected_components(pairs, broadcast_rows=broadcast_rows), "components")
    return component_keys(
        records, components, email, phone, source, user_id, out, record, broadcast_rows=broadcast_rows
    )


def component_keys(
    records: DataFrame,
    components: DataFrame,
    email: str = "EMAIL",
    phone: str = "PHONE",
    source: str = "SRC_SYSTEM",
    user_id: str = "SRC_USER_ID",
    out: str = "PERSON_KEY",
    record: str | None = None,
    *,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add the person key of each record, given ``(node, root)`` of the identifiers that have one."""
    e, p = F.col(email), F.col(phone)
    best = _best_identifier(e, p, F.col(source), F.col(user_id), F.col(record) if record else F.lit(None))
    rooted = lookup(
        records.withColumn("__best", best),
        components,
        {"node": F.col("__best")},
        {"__root": "root"},
        broadcast_rows=broadcast_rows,
    )
    return rooted.withColumn(out, F.sha2(F.coalesce("__root", "__best"), 256)).drop("__root", "__best")
