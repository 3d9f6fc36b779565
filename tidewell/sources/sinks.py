"""Table writers: full refresh, daily snapshots that add up, and tables that grow batch by batch."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType


def swap_in(spark: SparkSession, new: str, path: str) -> None:
    """Put the finished folder ``new`` in the place of ``path``; the old one goes last."""
    target, fresh, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, new, f"{new}-old"))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(fresh, target):
        if had:
            fs.rename(old, target)
        raise OSError(f"cannot put {new} in the place of {path}")
    if had:
        fs.delete(old, True)


def full_refresh(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Replace the table at ``path`` and return it as stored.

    The new table is written beside the old one and takes its place when it is complete, so
    a build that fails leaves the old table as it was, and a query may read the table it replaces.
    """
    path = path.rstrip("/")
    new = f"{path}__{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(new)
    swap_in(df.sparkSession, new, path)
    # with the schema given, a partitioned table without rows can be read back, too
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches of the table at ``path``, ascending."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))


def put_batch(df: DataFrame, path: str, batch: int, partition_by: tuple[str, ...] = ()) -> None:
    """Store the rows of one batch; running the same batch again replaces it.

    The batch is written to a hidden folder and renamed, so that readers see all of it or none.
    """
    path = path.rstrip("/")
    new = f"{path}/_new-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(new)
    swap_in(df.sparkSession, new, f"{path}/batch={batch}")


def drop_batch(spark: SparkSession, path: str, batch: int) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/batch={batch}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_batches(spark: SparkSession, path: str, schema: str | StructType, before: int | None = None) -> DataFrame:
    """The rows of all batches (numbered below ``before``) with their ``batch``; none if there is no table."""
    numbers = [n for n in stored_batches(spark, path) if before is None or n < before]
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else StructType(list(schema.fields))
    fields.add("batch", IntegerType())
    if not numbers:
        return spark.createDataFrame([], fields)
    folders = [f"{path.rstrip('/')}/batch={n}" for n in numbers]
    return spark.read.schema(fields).option("basePath", path).parquet(*folders)


def full_refresh_table(df: DataFrame, table: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Replace a catalog table, whatever the session's partition overwrite mode.

    The catalog drops the old table first; readers that must never miss it read a path.
    """
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(*partition_by).saveAsTable(table)
    return df.sparkSession.table(table)


def append_snapshot(df: DataFrame, path: str, ts: str = "SNAPSHOT_TS") -> DataFrame:
    """Add the snapshot of one day; running the same day again replaces that day only."""
    dated = df.withColumn("SNAPSHOT_DATE", F.to_date(ts))
    (
        dated.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("SNAPSHOT_DATE")
        .parquet(path)
    )
    return df.sparkSession.read.schema(dated.schema).parquet(path)
