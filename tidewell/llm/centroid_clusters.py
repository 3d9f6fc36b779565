"""Clusters around centroids, each vector's nearest centroid found in a vantage-point tree.

A node of the tree has a centroid as its vantage point and splits the others by their distance to it
into a near and a far half, of which it knows the least and the largest distance; few centroids make
a leaf. By the triangle inequality a query at distance d from a vantage point is at least d - largest
and least - d away from all of a half. A search keeps, for every vector, the least distance that each
open node can hold, opens the lowest one first, and ends when the lowest is beyond the best centroid
found. The radius is inclusive, and bounds give way by more than rounding, so that a centroid as near
as the best is always looked at and the smaller number wins. Distances that decide are exact integers.

In each round the tree is rebuilt from the centroids (which are few: ``clusters`` vectors) and
broadcast; a task searches its rows in blocks, all vectors at the same node together, and sends one
count and one vector of sums per cluster. Spark adds these up; the driver sees one row per cluster.
Vectors are stored as whole numbers in the shared folder once and read in each round.

Cases: vectors that are null, not of ``dims`` components, or hold a null or a non-finite component
take no part. Repeated rows are rows of their own; rows with a null id are clustered, but none starts
as a centroid. Rows with one hash (a repeated id) start in the order of their components. With fewer
rows than ``clusters`` there are as many centroids as rows with an id, and without any no result.
Ties go to the smaller number; an empty cluster keeps its centroid. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tidewell.llm.whole_vectors import PARTIAL, Sums, floored_means, matrix, whole_vectors
from tidewell.session import stage

#: Centroids of a leaf, at most.
LEAF = 3
#: Vectors searched together.
BLOCK_ROWS = 4096
#: By how much of the distances involved a bound gives way; rounding is far less.
SLACK = 1e-9


@dataclass
class Node:
    """The centroids looked at here (the vantage point, or a leaf's), and the halves with their distances."""

    centroids: np.ndarray
    halves: list[tuple[int, float, float]] = field(default_factory=list)  # (node, least, largest)


@dataclass
class Tree:
    centroids: np.ndarray
    nodes: list[Node]


def squared_distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances; by doubles as long as these hold every sum."""
    most = int(np.abs(vectors).max(initial=0)) + int(np.abs(centroids).max(initial=0))
    if most**2 * max(1, vectors.shape[1]) < 2**51:
        v, c = vectors.astype(np.float64), centroids.astype(np.float64)
        squares = (v * v).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None, :] - 2 * (v @ c.T)
        return squares.astype(np.int64)
    return np.stack([((vectors - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def build_tree(centroids: np.ndarray) -> Tree:
    """A vantage point is the centroid of a node whose distances to the others vary most."""
    apart = squared_distances(centroids, centroids)
    nodes: list[Node] = []

    def add(members: np.ndarray) -> int:
        place = len(nodes)
        if len(members) <= LEAF:
            nodes.append(Node(members))
            return place
        distances = np.sqrt(apart[np.ix_(members, members)].astype(np.float64))
        chosen = int(distances.var(axis=1).argmax())
        node = Node(members[[chosen]])
        nodes.append(node)
        order = np.argsort(distances[chosen], kind="stable")
        order = order[order != chosen]
        for half in np.array_split(order, 2):
            reach = distances[chosen][half]
            node.halves.append((add(np.sort(members[half])), float(reach.min()), float(reach.max())))
        return place

    add(np.arange(len(centroids)))
    return Tree(centroids, nodes)


def nearest(tree: Tree, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each vector, its squared distance, and how many distances were computed."""
    n, computed = len(vectors), 0
    best = np.full(n, len(tree.centroids), np.int64)
    least = np.full(n, np.iinfo(np.int64).max, np.int64)
    bounds = np.full((n, len(tree.nodes)), np.inf)
    bounds[:, 0] = 0.0
    searching = np.arange(n)
    while len(searching):
        lowest = bounds[searching].argmin(axis=1)
        bound = bounds[searching, lowest]
        within = bound <= np.sqrt(least[searching].astype(np.float64)) * (1 + SLACK)
        searching, lowest, bound = searching[within], lowest[within], bound[within]
        bounds[searching, lowest] = np.inf
        by_node = np.argsort(lowest, kind="stable")
        cuts = np.flatnonzero(np.diff(lowest[by_node])) + 1
        for group in np.split(by_node, cuts) if len(by_node) else ():
            rows, node = searching[group], tree.nodes[lowest[group[0]]]
            distances = squared_distances(vectors[rows], tree.centroids[node.centroids])
            computed += distances.size
            for number, distance in zip(node.centroids, distances.T):
                nearer = (distance < least[rows]) | ((distance == least[rows]) & (number < best[rows]))
                best[rows[nearer]], least[rows[nearer]] = number, distance[nearer]
            for half, low, high in node.halves:
                away = np.sqrt(distances[:, 0].astype(np.float64))
                apart = np.maximum(away - high, low - away) - SLACK * (away + high)
                bounds[rows, half] = np.maximum(bound[group], apart)
    return best, least, computed


def _searched(batch: pa.RecordBatch, tree: Tree) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for at in range(0, batch.num_rows, BLOCK_ROWS):
        part = batch.slice(at, BLOCK_ROWS)
        vectors = matrix(part.column("v"), tree.centroids.shape[1])
        found, distances, _ = nearest(tree, vectors)
        yield part, vectors, found, distances


def _improved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    tree = rows.sparkSession.sparkContext.broadcast(build_tree(centroids))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums([tree.value.centroids.shape])
        for batch in batches:
            for _, vectors, found, _ in _searched(batch, tree.value):
                sums.count(0, found)
                for i, numbers in enumerate(vectors.T):
                    sums.add(0, i, found, numbers)
        yield from sums.batches()

    new = floored_means(rows.select("v").mapInArrow(partial, PARTIAL), [centroids])[0]
    tree.destroy()
    return new


def cluster(
    df: DataFrame,
    *,
    clusters: int = 40,
    rounds: int = 5,
    dims: int = 64,
    scale: int = 256,
    salt: str = "2:",
    key: str = "vec_id",
    vector: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """(key, cluster, distance) of every sound vector, and the final centroids.

    The first centroids are the vectors with the smallest SHA-256 of ``salt`` and their id, in that
    order. A component x counts as floor(scale * x).
    """
    rows = stage(whole_vectors(df.select(key, vector), vector, scale, "v", dims=dims).select(key, "v"), "whole-vectors")
    drawn = F.sha2(F.concat(F.lit(salt), F.col(key).cast("string")), 256)
    seeds = rows.where(F.col(key).isNotNull()).orderBy(drawn, "v").limit(clusters).collect()
    centroids = np.array([r["v"] for r in seeds], np.int64).reshape(len(seeds), dims)
    schema = StructType([rows.schema[key], StructField("cluster", IntegerType()), StructField("distance", LongType())])
    if not seeds:
        return rows.where(F.lit(False)).select(key, F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    for _ in range(rounds):
        centroids = _improved(rows, centroids)
    tree = rows.sparkSession.sparkContext.broadcast(build_tree(centroids))

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, found, distances in _searched(batch, tree.value):
                out = [part.column(key), pa.array(found, pa.int32()), pa.array(distances, pa.int64())]
                yield pa.RecordBatch.from_arrays(out, names=[key, "cluster", "distance"])

    return rows.mapInArrow(final, schema), centroids
