"""Publish stored tables to the session catalog, so dashboards can go on using SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidewell.plans.pipeline import BRONZE, GOLD, SILVER

# Layer folder -> schemas its tables appear in.
SCHEMAS = {"bronze": ("raw",), "silver": ("silver",), "gold": ("star", "gold")}


def publish(spark: SparkSession, out: str) -> list[str]:
    """Register the tables a build left under ``out``; returns their names."""
    names = []
    for layer, tables in (("bronze", BRONZE), ("silver", SILVER), ("gold", GOLD)):
        for schema in SCHEMAS[layer]:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
            for table in tables:
                name = f"{schema}.{table}"
                if spark.catalog.tableExists(name):
                    if spark.catalog.getTable(name).tableType != "EXTERNAL":
                        raise ValueError(f"{name} is not one of ours: dropping it would delete its files")
                    spark.sql(f"DROP TABLE {name}")  # external: the files stay
                spark.catalog.createTable(name, path=f"{out}/{layer}/{table}", source="parquet")
                if any(c.isPartition for c in spark.catalog.listColumns(name)):
                    spark.catalog.recoverPartitions(name)
                names.append(name)
    return names
