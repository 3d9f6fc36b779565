"""Arrow text columns as flat byte arrays, and words found in them without a Python loop.

All operators read texts in pieces of bounded size: a piece holds whole documents, and more
than PIECE_BYTES only where a single document is longer than that.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3 * 0x9E3779B1 | 1
_M64 = (1 << 64) - 1
#: Powers kept: of a piece, with the end of a word that begins in it.
_USUAL = PIECE_BYTES + (1 << 14)


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts hold ``limit`` bytes at most (or one row)."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(sizes):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' UTF-8 bytes one after the other, and where each begins (with the end). Null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def table(bytes_in: bytes) -> np.ndarray:
    """A 256-entry membership table of bytes."""
    out = np.zeros(256, dtype=bool)
    out[list(bytes_in)] = True
    return out


ASCII_SPACE = table(b"\x20\x09\x0a\x0b\x0c\x0d")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = ASCII_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run of other bytes than ``space``, and how many words each text has.

    A word never crosses from one text to the next.
    """
    inside = np.zeros(len(data) + 2, dtype=bool)
    np.logical_not(space[data], out=inside[1:-1])
    opens = inside[1:-1] & ~inside[:-2]
    closes = inside[1:-1] & ~inside[2:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    opens[cuts] |= inside[1:-1][cuts]
    closes[cuts - 1] |= inside[1:-1][cuts - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def _powers_of(size: int) -> tuple[np.ndarray, np.ndarray]:
    def run(base: int) -> np.ndarray:
        out = np.full(size, base, dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return run(_BASE & _M64), run(pow(_BASE & _M64, -1, 1 << 64))


_usual_powers = lru_cache(maxsize=1)(_powers_of)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads close values apart."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span; equal bytes hash alike wherever they stand. Starts ascend."""
    out = np.zeros(len(starts), np.uint64)
    for at in range(0, len(data), PIECE_BYTES):
        low, high = np.searchsorted(starts, [at, at + PIECE_BYTES])
        if low < high:
            stop = int(ends[low:high].max())
            out[low:high] = _hashes(data[at:stop], starts[low:high] - at, ends[low:high] - at)
    return out


def distinct_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of one span of each distinct string, and which of those each span equals.

    Spans of one hash are compared byte by byte; where any differ, all are told apart by their bytes.
    """
    _, first, back = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    twin = first[back]
    again = np.flatnonzero(twin != np.arange(len(twin)))
    sizes = (ends - starts)[again]
    same = bool((sizes == (ends - starts)[twin[again]]).all())
    cuts = np.searchsorted(np.cumsum(sizes), np.arange(PIECE_BYTES, int(sizes.sum()) + PIECE_BYTES, PIECE_BYTES))
    for part in np.split(np.arange(len(again)), cuts) if same else ():
        at = np.arange(int(sizes[part].sum())) - np.repeat(np.cumsum(sizes[part]) - sizes[part], sizes[part])
        here, there = (np.repeat(starts[rows], sizes[part]) + at for rows in (again[part], twin[again[part]]))
        same = same and bool((data[here] == data[there]).all())
    if same:
        return first, back
    known: dict[bytes, int] = {}
    numbers = [known.setdefault(data[a:b].tobytes(), len(known)) for a, b in zip(starts.tolist(), ends.tolist())]
    _, first, back = np.unique(np.array(numbers, np.int64), return_index=True, return_inverse=True)
    return first, back


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    power, inverse = _usual_powers(_USUAL) if len(data) <= _USUAL else _powers_of(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * inverse[starts]
    return mixed(raw + (ends - starts).astype(np.uint64) * _ODD)
