"""SimHash near-duplicates, found by pigeonring filtering.

A fingerprint is cut into segments that form a ring. If two fingerprints differ in at most t of
their bits and there are m segments, some segment starts a chain in which every run of its first
l segments differs in at most l * t / m bits (Qin and Xiao, 2018). For five segments and four bits:
the first segment equal, the first two at most one bit apart, three at most two, four at most
three. Equality of the first and one bit of the second are looked up by keys with that bit left
out; longer chains are summed on the pairs that meet; then the whole distance is checked.

Copies share a fingerprint and count once from the start. Rows of one key are never paired with
each other all: a breadth-first walk within the key joins each fingerprint once, which keeps
every connection and at most one link per fingerprint and key.

Cases: a null or empty text, or one of white space alone, has fingerprint zero and is linked like
any other; fewer words than a shingle make one shingle; repeated rows are kept; a null key stays,
and a component of null keys only has a null id. Other columns are not carried over.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidewell.llm import worker
from tidewell.llm.text import ASCII_SPACE, LOWER, flat, pieces, words
from tidewell.operators.identity import connected_components
from tidewell.session import stage

SEED = 42
#: Shingles hashed at a time; bounds memory for very long texts.
BLOCK = 1 << 17


def fingerprints_of(column: pa.Array, width: int) -> np.ndarray:
    """The 64-bit fingerprint of each text."""
    data, offsets = flat(column)
    starts, ends, counts = words(data, offsets)
    out = np.zeros(len(offsets) - 1, np.uint64)
    if not len(starts):
        return out
    # the words again, lower-cased, one space after each
    sizes = ends - starts
    inside = ~ASCII_SPACE[data]
    joined = np.full(int(sizes.sum()) + len(starts), 32, np.uint8)
    after = np.cumsum(sizes + 1)
    keep = np.ones(len(joined), bool)
    keep[after - 1] = False
    joined[keep] = LOWER[data[inside]]
    begin, end = after - sizes - 1, after - 1
    text = joined.tobytes()
    digest = partial(xxh64_intdigest, seed=SEED)

    first_word = np.cumsum(counts) - counts
    shingles = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
    row = np.repeat(np.arange(len(counts)), shingles)
    first = np.arange(len(row)) - np.repeat(np.cumsum(shingles) - shingles, shingles) + first_word[row]
    last = np.minimum(first + width, first_word[row] + counts[row]) - 1
    sums = np.zeros((len(counts), 64), np.int64)
    for at in range(0, len(row), BLOCK):
        cut = slice(at, at + BLOCK)
        spans = map(slice, begin[first[cut]].tolist(), end[last[cut]].tolist())
        hashes = np.fromiter(map(digest, map(text.__getitem__, spans)), np.uint64, len(row[cut]))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        edges = np.flatnonzero(np.r_[True, np.diff(row[cut]) > 0])
        sums[row[cut][edges]] += np.add.reduceat(bits, edges, axis=0, dtype=np.int64)
    majority = sums * 2 > shingles[:, None]
    return np.packbits(majority, axis=1, bitorder="little").view(np.uint64).reshape(-1)


def fingerprints(
    documents: DataFrame, *, width: int, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """(key, ``keep``, fp) for every row; fp is the fingerprint as a signed long."""
    columns = [key, *(c for c in keep if c != key)]
    schema = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.alone()
        for batch in batches:
            for part in pieces(batch, text):
                found = fingerprints_of(part.column(text), width).view(np.int64)
                yield pa.RecordBatch.from_arrays([*map(part.column, columns), pa.array(found)], names=[*columns, "fp"])

    return documents.select(*dict.fromkeys([*columns, text])).mapInArrow(run, f"{schema}, fp long")


class Ring:
    """Segments of a 64-bit fingerprint and the budgets of their chains."""

    def __init__(self, distance: int):
        self.distance = distance
        self.segments = distance + 1  # then the first segment of a chain must be equal
        cuts = [round(64 * i / self.segments) for i in range(self.segments + 1)]
        self.parts = [(a, b - a) for a, b in zip(cuts, cuts[1:])]
        self.budgets = [(n * distance) // self.segments for n in range(1, self.segments + 1)]

    def part(self, fp: np.ndarray, i: int) -> np.ndarray:
        at, size = self.parts[i % self.segments]
        return fp >> np.uint64(at) & np.uint64((1 << size) - 1)

    def keys(self, fp: np.ndarray) -> np.ndarray:
        """For each start and each bit of the second segment: start, bit, first segment, rest of the second."""
        out = []
        for i in range(self.segments):
            second = self.parts[(i + 1) % self.segments][1]
            for bit in range(second if self.budgets[1] else 1):
                rest = self.part(fp, i + 1)
                if self.budgets[1]:
                    rest = rest & ~np.uint64(1 << bit)
                out.append(((self.part(fp, i) << np.uint64(second)) | rest) * np.uint64(512) + np.uint64(i * 64 + bit))
        return np.stack(out, axis=1)

    def chained(self, differing: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Whether the chain from ``start`` stays within every budget; the last one is the whole distance."""
        total = np.zeros(len(differing), np.int64)
        good = np.ones(len(differing), bool)
        for n, budget in enumerate(self.budgets):
            at = np.array([p[0] for p in self.parts], np.uint64)[(start + n) % self.segments]
            mask = np.array([(1 << p[1]) - 1 for p in self.parts], np.uint64)[(start + n) % self.segments]
            total += np.bitwise_count(differing >> at & mask)
            good &= total <= budget
        return good

    def walk(self, members: np.ndarray, start: int) -> list[tuple[int, int]]:
        """Links that connect all of one key's fingerprints that are connected, each found once."""
        links, rest, front = [], members, np.zeros(0, np.uint64)
        while len(rest):
            if not len(front):
                front, rest = rest[:1], rest[1:]
            here, front = front[0], front[1:]
            near = self.chained(rest ^ here, np.full(len(rest), start))
            links += [(int(here), int(x)) for x in rest[near]]
            front, rest = np.concatenate([front, rest[near]]), rest[~near]
        return links


def links(distinct: DataFrame, distance: int) -> DataFrame:
    """(a, b): enough pairs of fingerprints within ``distance`` bits to connect all such pairs.

    ``distinct`` has one row per fingerprint, column fp. Rows meet by key in sorted partitions; a
    task holds the fingerprints of one key at a time, eight bytes each.
    """
    if not 1 <= distance <= 7:
        raise ValueError("the distance must be 1 to 7 bits")
    ring = Ring(distance)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                fp = batch.column(0).slice(at, 4096).to_numpy(zero_copy_only=False).view(np.uint64)
                keys = ring.keys(fp)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(fp, keys.shape[1]).view(np.int64))], names=["key", "fp"]
                )

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.uint64), np.zeros(0, np.uint64))
        for batch in _with_end(batches):
            if batch is not None:
                held = tuple(
                    np.concatenate([h, batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64)]) for i, h in enumerate(held)
                )
            key, fp = held
            if not len(key):
                continue
            edges = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            stop = len(key) if batch is None else int(edges[-1])  # the last key may go on
            held = (key[stop:], fp[stop:])
            sizes = np.diff(np.append(edges[edges < stop], stop))
            firsts = edges[edges < stop]
            two = firsts[sizes == 2]
            start = (key[two] % np.uint64(512) // np.uint64(64)).astype(np.int64)
            good = two[ring.chained(fp[two] ^ fp[two + 1], start)]
            a, b = [fp[good]], [fp[good + 1]]
            for at, size in zip(firsts[sizes > 2], sizes[sizes > 2]):
                found = ring.walk(fp[at : at + size], int(key[at]) % 512 // 64)
                if found:
                    a.append(np.array([x for x, _ in found], np.uint64))
                    b.append(np.array([y for _, y in found], np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], names=["a", "b"]
            )

    keyed = distinct.select("fp").mapInArrow(spread, "key long, fp long")
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(met, "a long, b long")


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def near_duplicates(
    documents: DataFrame, *, width: int = 4, distance: int = 4, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, fp, component): every row with its fingerprint and the smallest key it is connected to.

    Fingerprints link at ``distance`` or fewer differing bits; components follow chains of links.
    """
    own = stage(fingerprints(documents, width=width, key=key, text=text), "fingerprints")
    distinct = stage(own.groupBy("fp").agg(F.min(key).alias("low")), "distinct-fingerprints")
    pairs = stage(links(distinct, distance).distinct(), "fingerprint-links")
    nodes = stage(connected_components(pairs), "fingerprint-components")
    rooted = distinct.join(nodes.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = stage(rooted.select("fp", "low", F.coalesce("root", "fp").alias("root")), "rooted")
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component"))
    classes = rooted.join(lowest, "root").select("fp", "component")
    return own.join(stage(classes, "fingerprint-classes"), "fp").select(key, "fp", "component")
