"""Vector code compression: parts of vectors as entries of learnt codebooks, by dictionary tables.

A vector is cut into equal consecutive parts; each part is coded by the nearest entry of its
codebook. Components are whole numbers, and few different ones occur in a dimension. So a block of
rows is stored dictionary-coded: per dimension its distinct numbers in order, and per row their
places. Against a codebook the squared differences of every distinct number to all entries are
tabulated once a dimension, and the distances of a part are gathers of table rows, added up over the
part's dimensions. All of it is exact integer work.

Codebooks start as the parts of the first rows by id. A round assigns every part and replaces each
entry by the floor of the mean of its parts. Rows never meet: a task sends one count and one vector
of sums per entry, Spark adds them up, and the driver sees the sums of entries only (``entries``
times the number of components). Blocks are written to the shared folder once and read in each
round, so a lost executor repeats a block, not the coding.

Cases: rows whose vector is null or holds a null or a non-finite component are dropped, as are rows
whose vector is not as long as that of the first kept row (by id, then components; a null id comes
last) or, if that length cannot be cut into ``parts``, all rows. Repeated ids are rows of their own.
With fewer rows than entries there are as many entries as rows. Ties go to the lower entry; entries
that no part chose stay. An empty table gives no codes. Columns other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from tidewell.llm.whole_vectors import PARTIAL, Sums, floored_means, matrix, whole_vectors
from tidewell.session import stage

#: Rows of a block; a dimension's dictionary holds no more numbers than that.
BLOCK_ROWS = 4096
#: Rows whose distances to all entries are added up at once.
GATHER_ROWS = 512


def dictionary_coded(vectors: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per dimension the distinct numbers in order, and the place of each row's number among them."""
    coded = [np.unique(column, return_inverse=True) for column in vectors.T]
    return [v.astype(np.int32) for v, _ in coded], [p.astype(np.uint16) for _, p in coded]


def nearest_entries(values: list[np.ndarray], places: list[np.ndarray], book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row's part, lower ones first, and its squared distance."""
    furthest = max(int(np.abs(v).max(initial=0)) for v in values) + int(np.abs(book).max(initial=0))
    kind = np.int32 if furthest**2 * len(values) < 2**31 else np.int64
    tables = [(v.astype(kind)[:, None] - b.astype(kind)[None, :]) ** 2 for v, b in zip(values, book.T)]
    n = len(places[0])
    found, least = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for at in range(0, n, GATHER_ROWS):
        rows = slice(at, at + GATHER_ROWS)
        distances = tables[0][places[0][rows]]
        for table, place in zip(tables[1:], places[1:]):
            distances += table[place[rows]]
        found[rows] = distances.argmin(axis=1)
        least[rows] = distances.min(axis=1)
    return found, least


def _blocks(rows: DataFrame, columns: list[str], width: int) -> DataFrame:
    """Rows as blocks: the other columns as lists, the vectors dictionary-coded."""
    carried = [StructField(c, ArrayType(rows.schema[c].dataType)) for c in columns]
    coded = [StructField(c, ArrayType(BinaryType())) for c in ("values", "places")]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                ends = pa.array([0, part.num_rows], pa.int32())
                lists = [pa.ListArray.from_arrays(ends, part.column(c)) for c in columns]
                for arrays in dictionary_coded(matrix(part.column("v"), width)):
                    lists.append(pa.array([[a.tobytes() for a in arrays]], pa.list_(pa.binary())))
                yield pa.RecordBatch.from_arrays(lists, names=[*columns, "values", "places"])

    return rows.select(*columns, "v").mapInArrow(blocks, StructType([*carried, *coded]))


def _arrays(batch: pa.RecordBatch, at: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The dictionaries and places of the block at a place of a batch."""
    return tuple(
        [np.frombuffer(x.as_buffer(), kind) for x in batch.column(c)[at].values]
        for c, kind in (("values", np.int32), ("places", np.uint16))
    )


def _assigned(values: list[np.ndarray], places: list[np.ndarray], books: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per part the codes and distances of a block."""
    width = len(values) // len(books)
    return [nearest_entries(values[p * width :][:width], places[p * width :][:width], book) for p, book in enumerate(books)]


def _improved(blocks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums([b.shape for b in books])
        width = books[0].shape[1]
        for batch in batches:
            for at in range(batch.num_rows):
                values, places = _arrays(batch, at)
                for part, (codes, _) in enumerate(_assigned(values, places, books)):
                    sums.count(part, codes)
                    for i in range(width):
                        dimension = part * width + i
                        sums.add(part, i, codes, values[dimension][places[dimension]])
        yield from sums.batches()

    return floored_means(blocks.select("values", "places").mapInArrow(partial, PARTIAL), books)


def compress(
    df: DataFrame,
    *,
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    scale: int = 1024,
    key: str = "vec_id",
    vector: str = "embedding",
    keep: tuple[str, ...] = (),
) -> tuple[DataFrame, list[np.ndarray]]:
    """(key, ``keep``, codes, error) of every sound vector, and the codebook of each part.

    ``codes`` are the places of the entries in part order, ``error`` the squared distance to them.
    A component x counts as floor(scale * x).
    """
    columns = [key, *keep]
    whole = whole_vectors(df.select(*columns, vector), vector, scale, "v").select(*columns, "v")
    by_id = [F.col(key).asc_nulls_last(), F.col("v")]
    first = whole.select(key, "v").orderBy(*by_id).limit(1).collect()
    width = len(first[0]["v"]) if first else 0
    if width % parts:
        width = 0
    rows = whole.where((F.size("v") == width) & F.lit(width > 0))
    blocks = stage(_blocks(rows, columns, width), "coded-vectors")
    seeds = rows.select(key, "v").orderBy(*by_id).limit(entries).collect()
    start = np.array([r["v"] for r in seeds], np.int64).reshape(len(seeds), width)
    books = [np.ascontiguousarray(b) for b in np.split(start, parts, axis=1)]
    for _ in range(rounds if seeds else 0):
        books = _improved(blocks, books)

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                found = _assigned(*_arrays(batch, at), books)
                codes = np.stack([c for c, _ in found], axis=1)
                ends = pa.array(np.arange(len(codes) + 1) * parts, pa.int32())
                out = [batch.column(c)[at].values for c in columns]
                out.append(pa.ListArray.from_arrays(ends, pa.array(codes.ravel(), pa.int32())))
                out.append(pa.array(sum(d for _, d in found), pa.int64()))
                yield pa.RecordBatch.from_arrays(out, names=[*columns, "codes", "error"])

    schema = [*(rows.schema[c] for c in columns), StructField("codes", ArrayType(IntegerType())), StructField("error", LongType())]
    return blocks.mapInArrow(final, StructType(schema)), books
