"""Vectors as whole numbers: which rows take part, batches as matrices, and means of groups of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Components this large or larger have squared distances that a 64-bit number may not hold.
TOO_LARGE = 1 << 27

#: Partial sums of groups of vectors, as tasks send them.
PARTIAL = "part int, entry int, n long, sums array<long>"


def whole_vectors(df: DataFrame, vector: str, scale: int, v: str, *, dims: int | None = None) -> DataFrame:
    """The rows with a sound vector, and that vector as ``v``: floor(scale * x) of each component.

    A vector is sound if it is not null and all its components are finite numbers (and ``dims`` of
    them). A component of ``TOO_LARGE`` or more fails the job: its distances have no 64-bit value.
    """
    sound: Column = F.col(vector).isNotNull() & F.forall(
        vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False))
    )
    if dims is not None:
        sound = sound & (F.size(vector) == dims)
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale)))).alias(v)
    fits = F.forall(v, lambda x: x.between(1 - TOO_LARGE, TOO_LARGE - 1))
    wrong = F.raise_error(F.lit(f"a component of {vector} times {scale} is not below {TOO_LARGE}"))
    return df.where(sound).select("*", scaled).withColumn(v, F.when(fits, F.col(v)).otherwise(wrong))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A column of lists of ``width`` numbers each as a matrix of 64-bit integers."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return flat.reshape(len(column), width)


class Sums:
    """Counts and sums of the vectors of each entry, in one task. ``shapes``: entries and width of each part."""

    def __init__(self, shapes: list[tuple[int, int]]) -> None:
        self.counts = [np.zeros(n, np.int64) for n, _ in shapes]
        self.sums = [np.zeros(shape, np.int64) for shape in shapes]

    def add(self, part: int, position: int, entries: np.ndarray, numbers: np.ndarray) -> None:
        """Add one component of some rows; sums of a batch of bounded numbers are exact as doubles."""
        sums = self.sums[part]
        sums[:, position] += np.bincount(entries, weights=numbers, minlength=len(sums)).astype(np.int64)

    def count(self, part: int, entries: np.ndarray) -> None:
        self.counts[part] += np.bincount(entries, minlength=len(self.counts[part]))

    def batches(self) -> Iterator[pa.RecordBatch]:
        used = [(p, int(e)) for p, c in enumerate(self.counts) for e in np.flatnonzero(c)]
        if used:
            columns = [
                pa.array([p for p, _ in used], pa.int32()),
                pa.array([e for _, e in used], pa.int32()),
                pa.array([int(self.counts[p][e]) for p, e in used], pa.int64()),
                pa.array([self.sums[p][e].tolist() for p, e in used], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", "sums"])


def floored_means(partial: DataFrame, old: list[np.ndarray]) -> list[np.ndarray]:
    """The matrices of entries with each entry that has vectors replaced by the floor of their mean.

    Only one row per entry, added up by Spark, comes to the driver.
    """
    widest = max((m.shape[1] for m in old), default=0)
    sums = F.array(*[F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")) for i in range(widest)])
    new = [m.copy() for m in old]
    for row in partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), sums.alias("sums")).collect():
        entry = new[row["part"]][row["entry"]]
        entry[:] = [int(s) // row["n"] for s in row["sums"][: len(entry)]]
    return new
