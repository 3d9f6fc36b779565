"""Large JSON array files read by many tasks.

The text reader may start a task anywhere in a file if lines end where it is told; here they end at
every closing brace, so an array of objects comes in pieces, in order within each block of the file.
What a piece means depends on all text before it: is it inside a string, how deep is it nested? A
prefix pass carries that over. Within a block running sums give quotes and depth from the block's
start, once for a start outside a string and once for a start inside one; one row per block then
tells which of the two holds and how deep the block starts. A record ends with the brace that brings
the depth back to the level of records. Records within a block are put together where the block
is, those that cross blocks from the edges of blocks alone.

A closing brace never follows a lone backslash in JSON, so no escape crosses a border.

Cases: also objects one after the other without an array. Elements that are not objects come with
declared columns as broken records, else as they are. Text that does not parse, or that a file ends
in the middle of, is a broken record with its text; records before it are read. A missing last
bracket alone goes unnoticed. Files are UTF-8 and not compressed; empty ones have no records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.operators.lookup import lookup
from tidewell.session import stage
from tidewell.sources.corrupt import CORRUPT

_END = "}"
_BYTE_ORDER_MARK = 3


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Text between closing braces, with its place."""
    return spark.read.option("lineSep", _END).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )


def _in_block(value: Column, last: int) -> Column:
    """The sum of a value over the pieces of a block, up to ``last`` places from this one."""
    window = Window.partitionBy("file", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, last)
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def _scanned(pieces: DataFrame) -> DataFrame:
    """Of each piece its quotes, those before it in the block, and its change of depth.

    ``change0`` holds if the block starts outside a string, ``change1`` if inside one.
    """
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    counted = pieces.select("*", bare.alias("bare"), _count(bare, '"').alias("quotes"))
    ahead = counted.withColumn("ahead", _in_block(F.col("quotes"), -1) % 2)

    def change(inside: Column) -> Column:
        opened = F.concat(F.when(inside == 1, '"').otherwise(""), "bare")
        outside = F.regexp_replace(opened, r'"[^"]*("|\z)', "")
        closed = (inside + F.col("quotes")) % 2 == 0
        return _count(outside, "{[") - _count(outside, "]") - closed.cast("int")

    start = [change((F.col("ahead") + s) % 2).alias(f"change{s}") for s in (0, 1)]
    return ahead.select("file", "block", "size", "place", "value", "quotes", "ahead", *start)


def _block_starts(scanned: DataFrame) -> DataFrame:
    """Per block: inside a string at its start or not, depth there, and what the file is like."""
    blocks = scanned.groupBy("file", "block").agg(
        (F.sum("quotes") % 2).alias("quotes"),
        F.sum("change0").alias("change0"),
        F.sum("change1").alias("change1"),
        F.sum(F.octet_length("value") + 1).alias("bytes"),
        F.max("size").alias("size"),
        F.max("place").alias("last"),
        F.min_by(F.regexp_extract("value", r"^[\s\x{FEFF}]*(.)", 1), "place").alias("first"),
    )
    whole = Window.partitionBy("file")  # one row per block of the file
    before = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = blocks.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    change = F.when(F.col("inside") == 0, F.col("change0")).otherwise(F.col("change1"))
    total = F.sum("bytes").over(whole)
    ended = (total == F.col("size")) | (total == F.col("size") - _BYTE_ORDER_MARK)
    return inside.select(
        "file",
        "block",
        "inside",
        F.coalesce(F.sum(change).over(before), F.lit(0)).alias("depth"),
        (F.min_by("first", "block").over(whole) == "[").cast("int").alias("level"),
        # the place of the piece that no brace follows
        F.when((F.max("block").over(whole) == F.col("block")) & ~ended, F.col("last")).alias("unended"),
    )


def _texts(scanned: DataFrame, starts: DataFrame) -> DataFrame:
    """The text of each record with what stands before it: ``text``, and whether records are in an array."""
    names = ("inside", "depth", "level", "unended")
    placed = lookup(scanned, starts, {"file": F.col("file"), "block": F.col("block")}, {n: n for n in names})
    change = F.when(F.col("inside") == 0, F.col("change0")).otherwise(F.col("change1"))
    outside = (F.col("inside") + F.col("ahead") + F.col("quotes")) % 2 == 0
    cut = F.coalesce(F.col("unended") == F.col("place"), F.lit(False))
    depth = F.col("depth") + _in_block(change, 0)
    ends = placed.select(
        "file", "block", "place", "level", F.when(cut, F.col("value")).otherwise(F.concat("value", F.lit(_END))).alias("value"),
        (~cut & outside & (depth == F.col("level"))).cast("int").alias("ends"),
    )
    numbered = ends.withColumn("record", _in_block(F.col("ends"), -1))

    def joined(place: str) -> Column:
        ordered = F.array_sort(F.collect_list(F.struct(place, "value")))
        return F.array_join(F.transform(ordered, lambda piece: piece["value"]), "")

    records = numbered.groupBy("file", "block", "record").agg(
        joined("place").alias("value"), F.max("ends").alias("ends"), F.max("level").alias("level")
    )
    records = stage(records, "json-records")
    at_edge = (F.col("record") == 0) | (F.col("ends") == 0)
    order = Window.partitionBy("file").orderBy("block", "record").rowsBetween(Window.unboundedPreceding, -1)
    edges = records.where(at_edge).select(  # at most two rows per block
        "file", "level", F.struct("block", "record").alias("place"), "value",
        F.coalesce(F.sum("ends").over(order), F.lit(0)).alias("record"), "ends",
    )
    crossing = edges.groupBy("file", "record").agg(
        joined("place").alias("text"), F.max("ends").alias("ends"), F.max("level").alias("level")
    )
    within = records.where(~at_edge).select(F.col("value").alias("text"), "ends", "level")
    return within.unionByName(crossing.select("text", "ends", "level"))


def read_json_array(spark: SparkSession, path: str, columns: tuple[str, ...] = ()) -> DataFrame:
    """The records of array files as ``read_json`` gives them: declared columns, or ``data``, and CORRUPT."""
    scanned = stage(_scanned(_pieces(spark, path)), "json-pieces")
    texts = _texts(scanned, stage(_block_starts(scanned), "json-blocks"))
    element = F.regexp_replace("text", r"^[\s\x{FEFF}]*[\[,]?\s*", "")
    last = F.when((F.col("ends") == 0) & (F.col("level") == 1), F.regexp_replace(element, r"\s*\]\s*$", ""))
    elements = texts.select(F.coalesce(last, element).alias("element")).where(F.trim("element", F.lit(" \t\r\n")) != "")
    if columns:
        fields = ", ".join([*(f"`{c}` VARIANT" for c in columns), f"{CORRUPT} STRING"])
        parsed = F.from_json("element", fields, {"columnNameOfCorruptRecord": CORRUPT})
        return elements.select(parsed.alias("row")).select("row.*")
    items = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), "element", F.lit("]"))), "$", "array<variant>")
    parsed = elements.select("element", items.alias("items"))
    return parsed.select(
        F.explode_outer("items").alias("data"), F.when(F.col("items").isNull(), F.col("element")).alias(CORRUPT)
    )
