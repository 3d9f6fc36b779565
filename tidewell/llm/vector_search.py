"""Exact top-k by inner product, with bounds from segment statistics, coarse to fine.

Vectors are cut into segments; of each the mean and the deviation are kept. As
sum((q - mq)(x - mx)) <= n * sq * sx in a segment of n components, the squared distance of two
vectors is at least sum(n * ((mq - mx)^2 + (sq - sx)^2)), and so their inner product, half of
|q|^2 + |x|^2 minus that distance, is at most sum(n * (mq * mx + sq * sx)). The bound is taken with
few segments, then with more on what is left, and exact products are computed for the survivors.

Queries and candidates meet in blocks: every block of queries with every shard of candidates,
each of a bounded number of rows; a shard hands on its best k of each query. No bound is lost
between blocks, as each task prunes only against exact scores of its own shard.

Cases: vectors that are null, or hold a null or a non-finite component, and rows without an id
take no part; vectors are compared with those of their own length only; a repeated row is a
candidate (and a query) of its own; ties go to the smaller id. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.session import stage

#: Rows of one block of queries, and of one shard of candidates.
BLOCK_ROWS = 2048
SHARD_ROWS = 8192
#: Segments of each resolution, and the share of pairs up to which only the survivors are computed.
RESOLUTIONS = (4, 16)
SPARSE = 0.05
#: Components of pairs gathered at once.
GATHERED = 1 << 22


def segment_statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Of each segment sqrt(n) times its mean and its deviation, side by side."""
    cuts = np.linspace(0, vectors.shape[1], min(segments, vectors.shape[1]) + 1).astype(int)
    sizes = np.diff(cuts)
    sums = np.add.reduceat(vectors, cuts[:-1], axis=1) / sizes
    centred = vectors - np.repeat(sums, sizes, axis=1)
    spread = np.sqrt(np.add.reduceat(centred * centred, cuts[:-1], axis=1) / sizes)
    return np.concatenate([sums, spread], axis=1) * np.sqrt(np.concatenate([sizes, sizes]))


def exact_products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products of each query with each candidate, as integers."""
    most = max(np.abs(queries).max(initial=0), np.abs(candidates).max(initial=0))
    if float(most) ** 2 * max(1, queries.shape[1]) < 2**53:
        return (queries.astype(np.float64) @ candidates.astype(np.float64).T).astype(np.int64)
    return queries @ candidates.T


def pair_products(left: np.ndarray, right: np.ndarray, q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of some pairs of rows, of which GATHERED components are held at a time."""
    out = np.zeros(len(q), left.dtype)
    step = max(1, GATHERED // max(1, left.shape[1]))
    for at in range(0, len(q), step):
        part = slice(at, at + step)
        out[part] = np.einsum("pd,pd->p", left[q[part]], right[c[part]])
    return out


def best_of_shard(
    queries: np.ndarray, query_rows: np.ndarray, candidates: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query place, candidate place, score) of the best k candidates of each query, ties to the smaller id."""
    order = np.argsort(ids, kind="stable")
    candidates, rows, ids = candidates[order], rows[order], ids[order]
    own = np.searchsorted(np.sort(rows), query_rows)
    by_row = np.argsort(rows)
    here = (own < len(rows)) & (rows[by_row[np.minimum(own, len(rows) - 1)]] == query_rows)
    itself = np.full(len(queries), -1)
    itself[here] = by_row[own[here]]
    wide_q, wide_c = queries.astype(np.float64), candidates.astype(np.float64)
    alive = np.ones((len(queries), len(candidates)), bool)
    alive[np.flatnonzero(here), itself[here]] = False
    floor = np.full(len(queries), -np.inf)
    for segments in RESOLUTIONS if candidates.shape[1] else ():
        if segments >= candidates.shape[1]:
            break
        sq, sc = segment_statistics(wide_q, segments), segment_statistics(wide_c, segments)
        slack = 1.0 + 1e-9 * np.linalg.norm(sq, axis=1)[:, None] * np.linalg.norm(sc, axis=1).max(initial=0)
        if alive.mean() > SPARSE:
            bound = np.where(alive, sq @ sc.T + slack, -np.inf)
            if np.isneginf(floor).all() and len(candidates) > k:  # exact scores of the likeliest give a first floor
                likely = np.argpartition(-bound, k, axis=1)[:, : k + 1]
                scores = np.einsum("qd,qcd->qc", wide_q, wide_c[likely])
                scores[~np.take_along_axis(alive, likely, axis=1)] = -np.inf
                floor = np.sort(scores, axis=1)[:, -k] if scores.shape[1] >= k else floor
            alive &= bound >= floor[:, None]
        else:
            q, c = np.nonzero(alive)
            bound = pair_products(sq, sc, q, c) + slack[q, 0]
            gone = bound < floor[q]
            alive[q[gone], c[gone]] = False
    if alive.mean() > SPARSE:
        scores = exact_products(queries, candidates)
        q, c = np.nonzero(alive)
        scores = scores[q, c]
    else:
        q, c = np.nonzero(alive)
        scores = pair_products(queries, candidates, q, c)
    keep = scores >= floor[q]
    q, c, scores = q[keep], c[keep], scores[keep]
    order = np.lexsort((c, -scores, q))
    q, c, scores = q[order], c[order], scores[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    return q[place < k], ids[c[place < k]], scores[place < k]


def top_k(
    vectors: DataFrame,
    is_query: Column,
    *,
    k: int = 5,
    scale: int = 256,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, key, score): the k highest integer products of each query row with all other rows.

    A component x counts as floor(scale * x), taken as a double.
    """
    sound = F.expr(f"forall({vector}, x -> x IS NOT NULL AND abs(CAST(x AS DOUBLE)) < CAST('Infinity' AS DOUBLE))")
    whole = F.expr(f"transform({vector}, x -> CAST(floor(CAST(x AS DOUBLE) * {int(scale)}) AS BIGINT))")
    rows = stage(
        vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & sound).select(
            F.monotonically_increasing_id().alias("row"),
            F.col(key).cast("long").alias("id"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
            F.size(vector).alias("dim"),
            whole.alias("v"),
        ),
        "vectors",
    )
    sizes = rows.agg(F.count("*").alias("n"), F.count_if("asks").alias("asking")).first()
    shards = max(1, -(-sizes["n"] // SHARD_ROWS))
    blocks = max(1, -(-sizes["asking"] // BLOCK_ROWS))
    place = F.xxhash64("row")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    candidates = rows.select("dim", F.pmod(place, F.lit(shards)).cast("int").alias("shard"), every(blocks).alias("block"), "row", "id", "v")
    asking = rows.where("asks").select(
        "dim", every(shards).alias("shard"), F.pmod(place, F.lit(blocks)).cast("int").alias("block"), "row", "id", "v"
    )

    def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        table = table.combine_chunks()
        values = [c.flatten() for c in table.column("v").chunks]
        flat = pa.concat_arrays(values).to_numpy(zero_copy_only=False) if values else np.zeros(0, np.int64)
        n = table.num_rows
        return flat.reshape(n, -1) if len(flat) else np.zeros((n, 0), np.int64), *(
            table.column(c).to_numpy() for c in ("row", "id")
        )

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query_row", "query_id", "id", "score"]
        if not left.num_rows or not right.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        (cv, crow, cid), (qv, qrow, qid) = matrix(left), matrix(right)
        q, found, scores = best_of_shard(qv, qrow, cv, crow, cid, k)
        return pa.table([pa.array(x, pa.int64()) for x in (qrow[q], qid[q], found, scores)], names=names)

    keys = ["dim", "block", "shard"]
    found = (
        candidates.groupBy(*keys)
        .cogroup(asking.groupBy(*keys))
        .applyInArrow(search, "query_row long, query_id long, id long, score long")
    )
    best_first = Window.partitionBy("query_row").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(key), "score")
