"""The memory of Python workers: what they keep between tasks, and how much they get at a time.

Spark uses a worker again for later stages. An operator that remembers words between its tasks
keeps them here; another operator's tasks in the same worker give that memory back first.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import SparkSession

#: Bytes of rows that a task hands to its Python worker at a time.
BATCH_BYTES = 4 << 20

_kept: dict[str, Any] = {}


def trim() -> None:
    """Give memory that is free, but still held by allocators, back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def alone() -> None:
    """Drop what other operators have kept in this worker."""
    if _kept:
        _kept.clear()
        gc.collect()
        trim()


def kept(name: str, make: Callable[[], Any]) -> Any:
    """The object of this name, made on first use; objects of other names go."""
    if name not in _kept:
        alone()
        _kept[name] = make()
    return _kept[name]


def small_batches(spark: SparkSession) -> SparkSession:
    """Hand rows over by BATCH_BYTES: the usual ten thousand rows may be long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")
    return spark
