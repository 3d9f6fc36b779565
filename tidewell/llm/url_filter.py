"""URL filtering against lists as they stood when each page was fetched.

Lists change by dated entries: a pattern is put on a list or taken off it. Entries become
validity intervals, and every capture is judged by the intervals that hold on the day of its
fetch. Patterns are a host (with all hosts below it) or a host with a path.

Captures are first reduced to their distinct (host, path, day), these to their distinct
(pattern, day), so that a host with a third of all captures meets the list once a day; the
verdicts go back the same way. A pattern has at most one interval for two days, however many
entries name it, as entries of one day are one change. All of it is DataFrame work.

Cases: a null or malformed URL has no host and is not blocked, nor is a capture without a date;
entries without list, pattern, date or direction are void; if entries of one day disagree, the
pattern is listed; an entry takes effect on its day; repeated captures are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def host_of(url: Column) -> Column:
    """The lower-cased host without port and user, empty if there is none."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1), F.lit(""))


def path_of(url: Column) -> Column:
    """The path as written, without query and fragment; empty if there is none."""
    return F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^?#]*)", 1), F.lit(""))


def first_segment(path: Column) -> Column:
    return F.regexp_extract(path, r"^(/[^/]*)", 1)


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(list, pattern, day, listed) -> (list, pattern, valid_from, valid_until); until is exclusive, null if open."""
    daily = (
        entries.where("list IS NOT NULL AND pattern IS NOT NULL AND day IS NOT NULL AND listed IS NOT NULL")
        .groupBy("list", "pattern", "day")
        .agg(F.max("listed").alias("listed"))
    )
    by_day = Window.partitionBy("list", "pattern").orderBy("day")
    changes = daily.withColumn("before", F.lag("listed", 1, False).over(by_day)).where("listed <> before")
    until = F.lead("day").over(by_day)
    return changes.select("list", "pattern", "listed", F.col("day").alias("valid_from"), until.alias("valid_until")).where("listed").drop("listed")


def _patterns(host: str, path: str) -> Column:
    """What a list may name to block a URL: its host and those above it, host and first segment, host and path."""
    above = F.expr(
        f"transform(sequence(1, greatest(size(split({host}, '[.]')) - 1, 1)),"
        f" i -> array_join(slice(split({host}, '[.]'), i, size(split({host}, '[.]'))), '.'))"
    )
    with_path = F.array(F.concat(host, first_segment(F.col(path))), F.concat(host, path))
    return F.array_distinct(F.concat(above, with_path))


def judge(captures: DataFrame, entries: DataFrame, *, key: str, url: str, day: str) -> DataFrame:
    """(key, url, host, day, blocked, rules, n_rules) of every capture.

    ``rules`` names the lists and patterns in force that match, sorted, as ``list:pattern``.
    """
    rows = captures.select(
        F.col(key).alias("id"), F.col(url).alias("link"), host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"), F.col(day).cast("date").alias("at"),
    )
    classes = rows.where("host <> '' AND at IS NOT NULL").select("host", "path", "at").distinct()
    spread = classes.withColumn("pattern", F.explode(_patterns("host", "path")))
    asked = spread.select("pattern", "at").distinct()
    held = validity_intervals(entries)
    inside = (asked["at"] >= held["valid_from"]) & (held["valid_until"].isNull() | (asked["at"] < held["valid_until"]))
    hits = asked.join(held, (asked["pattern"] == held["pattern"]) & inside).select(
        asked["pattern"], asked["at"], F.concat_ws(":", held["list"], held["pattern"]).alias("rule")
    )
    verdicts = (
        spread.join(hits, ["pattern", "at"])
        .groupBy("host", "path", "at")
        .agg(F.array_sort(F.collect_set("rule")).alias("found"))  # at most the patterns of one URL times the lists
    )
    joined = rows.join(verdicts, ["host", "path", "at"], "left")
    n = F.coalesce(F.size("found"), F.lit(0))
    return joined.select(
        F.col("id").alias(key),
        F.col("link").alias(url),
        "host",
        F.col("at").alias(day),
        F.col("found").isNotNull().alias("blocked"),
        F.coalesce(F.array_join("found", " "), F.lit("")).alias("rules"),
        F.when(F.col("found").isNull(), 0).otherwise(n).cast("int").alias("n_rules"),
    )
