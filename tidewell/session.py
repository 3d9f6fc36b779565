"""Session helpers: a local session for tests, and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Names the folder for intermediate tables; may be set on a running session.
STAGING_KEY = "spark.tidewell.staging.dir"


def local_session(cpus: int | str = "*", app: str = "tidewell", **conf: str) -> SparkSession:
    """A session for tests and the local benchmark. On a cluster, bring your own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """All times in the pipeline are UTC wall-clock; pin the session so casts agree."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: STAGING_KEY, which can be set while the session
    runs, or else what the cluster names in spark.checkpoint.dir.

    Only a local session may fall back to a folder of this machine.
    """
    for key in (STAGING_KEY, "spark.checkpoint.dir"):
        if root := spark.conf.get(key, None):
            return root.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError(f"set {STAGING_KEY} to a folder every executor can reach")
    return os.path.join(tempfile.gettempdir(), "tidewell-checkpoints")


_scopes: list[str] = []


@contextmanager
def staging(spark: SparkSession) -> Iterator[str]:
    """Intermediate results written inside the block go when it ends.

    Use it around work whose results are stored elsewhere before the block ends.
    """
    folder = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/scope-{uuid.uuid4().hex}"
    _scopes.append(folder)
    try:
        yield folder
    finally:
        _scopes.remove(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str, *, outlive: bool = False) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    This cuts the lineage: later jobs, and tasks repeated after a lost executor, read the
    same stored rows instead of recomputing them. Outside a ``staging`` block the rows stay
    until ``drop_staged``, as a frame that reads them may be used at any time. With ``outlive``
    they stay when the innermost block ends: the result of work whose other tables go.
    """
    spark = df.sparkSession
    scopes = _scopes[:-1] if outlive else _scopes
    folder = scopes[-1] if scopes else f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> None:
    """Remove what this application has staged; frames that read it are of no use afterwards."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{spark.sparkContext.applicationId}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
