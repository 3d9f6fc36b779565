"""Data checks that stand in for constraints nobody enforces."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.settings import KNOWN_CURRENCIES
from tidewell.sources.files import CORRUPT


def key_violations(df: DataFrame, table: str, key: str) -> DataFrame:
    """Rows that break "``key`` is unique and not NULL": one per offending value."""
    value = F.col(key).cast("string")
    return (
        df.groupBy(value.alias("key_value"))
        .agg(F.count("*").alias("row_count"))
        .where("key_value IS NULL OR row_count > 1")
        .select(F.lit(table).alias("table_name"), F.lit(key).alias("key_name"), "key_value", "row_count")
    )


def all_key_violations(tables: dict[str, DataFrame], keys: dict[str, list[str]]) -> DataFrame:
    checks = [key_violations(tables[t], t, k) for t, names in keys.items() for k in names]
    return reduce(DataFrame.unionByName, checks)


def orphan_keys(fact: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """How many fact rows found no dimension row, per key; one pass over the fact."""
    nulls = [F.count_if(F.col(k).isNull()).alias(k) for k in keys]
    counts = fact.agg(F.count("*").alias("row_count"), *nulls)
    pairs = ", ".join(f"'{k}', {k}" for k in keys)
    return counts.selectExpr(
        f"'{table}' AS table_name", f"stack({len(keys)}, {pairs}) AS (key_name, orphan_rows)", "row_count"
    )


def currency_report(df: DataFrame, code: str = "CURRENCY", amount: str = "GROSS_AMOUNT") -> DataFrame:
    """Rows and amount per currency, with codes outside the known list flagged."""
    unknown: Column = ~F.coalesce(F.col(code).isin(*KNOWN_CURRENCIES), F.lit(False))
    return (
        df.groupBy(F.col(code).alias("currency"))
        .agg(F.count("*").alias("row_count"), F.sum(amount).alias("amount"))
        .withColumn("unknown_code", unknown)
    )


def bad_records(landed: DataFrame) -> DataFrame:
    """Rows of each landed file, and how many of them did not parse."""
    broken = F.try_variant_get("data", f"$.{CORRUPT}", "string").isNotNull()
    return landed.groupBy("src_system", "src_file").agg(
        F.count("*").alias("row_count"), F.count_if(broken).alias("bad_rows")
    )


def parse_flags(parsed: DataFrame) -> DataFrame:
    """Parsed orders per source whose amount names another currency, or whose time has two offsets."""
    return parsed.groupBy("SOURCE").agg(
        F.count("*").alias("row_count"),
        F.count_if("CURRENCY_MISMATCH").alias("currency_mismatches"),
        F.count_if("TS_AMBIGUOUS").alias("ambiguous_times"),
    )
