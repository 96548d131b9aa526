"""Nearest neighbours by a block matrix join over int8 product tiles with error bounds."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import grouped, table


def valid(column: str) -> Column:
    """Whether a vector takes part: not null or empty, all components finite, not all zero."""
    c = F.col(column)
    finite = F.forall(c, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(c, lambda x: x != 0), F.lit(False))


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes as floats for the product, scale, norm of scale * codes, and norm of the rounding error, by row."""
    scale = np.abs(x).max(axis=1) / 127.0
    codes = np.rint(x / scale[:, None])
    back = codes * scale[:, None]
    kind = np.float32 if x.shape[1] * 127 * 127 < 1 << 24 else np.float64  # products of codes stay exact
    return codes.astype(np.int8).astype(kind), scale, np.linalg.norm(back, axis=1), np.linalg.norm(x - back, axis=1)


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row-wise inner products in double precision, summed from the first component to the last."""
    total = np.zeros(len(x))
    for d in range(x.shape[1]):
        total += x[:, d] * y[:, d]
    return total


def distinct_rows(ids: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ids and vectors without repeated rows. A block holds all rows of an id."""
    if len(np.unique(ids)) == len(ids):
        return ids, x
    kept = list({(int(i), v.tobytes()): n for n, (i, v) in enumerate(zip(ids, x))}.values())
    return ids[kept], x[kept]


def tile_top(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query of a tile, its k best candidates in it: ids and exact scores, best first, ties to smaller ids.

    The int8 product differs from the exact one by at most |eq||c| + |q'||ec| (e: rounding errors, q' the rounded
    query). A pair survives if its upper bound reaches the k-th best lower bound of its query.
    """
    qc, qs, qn, qe = quantise(q)
    cc, cs, _, ce = quantise(c)
    near = (qc @ cc.T).astype(np.float64) * qs[:, None] * cs[None, :]
    bound = qe[:, None] * np.linalg.norm(c, axis=1)[None, :] + qn[:, None] * ce[None, :]
    bound = bound * (1 + 1e-9) + 1e-12 * np.abs(near)
    own = qid[:, None] == cid[None, :]
    low = np.where(own, -np.inf, near - bound)
    if low.shape[1] > k:
        least = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k]
    else:
        least = np.full(len(qid), -np.inf)
    alive = (near + bound >= least[:, None]) & ~own
    for i in range(len(qid)):
        at = np.flatnonzero(alive[i])
        if not len(at):
            continue
        score = products(np.broadcast_to(q[i], (len(at), q.shape[1])), c[at])
        best = np.lexsort((cid[at], -score))[:k]
        yield int(qid[i]), cid[at][best], score[best]


def nearest(vectors: DataFrame, queries: DataFrame, *, k: int = 20, id: str = "vec_id", vector: str = "embedding", query_block: int = 512, block: int = 4096) -> DataFrame:
    """query_id, rank (from 1), the id and score of each query's k nearest rows by inner product.

    Every query meets every row once, in tiles of at most about query_block queries and block rows; a tile's
    matrices bound a task's memory. Vectors that are not valid(), or whose id is null, take no part; vectors meet
    only those of their own length; a row is never its own neighbour, nor is another row of the same id; rows equal
    in id and vector count once; ties go to the smaller id. No valid vector or query: no rows.
    """
    spark = vectors.sparkSession
    vectors = vectors.filter(F.col(id).isNotNull() & valid(vector)).select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("x"))
    queries = queries.filter(F.col(id).isNotNull() & valid(vector)).select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("x"))
    nc, nq = max(1, -(-vectors.count() // block)), max(1, -(-queries.count() // query_block))
    # Blocks by a hash of the id, so that equal vectors with many ids spread over all blocks.
    right = vectors.select("id", "x", F.lit(0).alias("query"), F.expr(f"explode(transform(sequence(0, {nq - 1}), q -> cast(q as bigint) * {nc} + pmod(xxhash64(id), {nc})))").alias("tile"))
    left = queries.select("id", "x", F.lit(1).alias("query"), F.expr(f"explode(transform(sequence(0, {nc - 1}), c -> pmod(xxhash64(id, 1), {nq}) * {nc} + cast(c as bigint)))").alias("tile"))

    def tiles(t: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a, b in zip(starts[:-1], starts[1:]):
            part = t.slice(a, b - a).combine_chunks()
            ids, side, x = part["id"].to_numpy(), part["query"].to_numpy(), part["x"].combine_chunks()
            if isinstance(x, pa.ChunkedArray):
                x = pa.concat_arrays(x.chunks)
            length = x.value_lengths().to_numpy(zero_copy_only=False)
            flat, at = x.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(length)]
            got = []
            for d in np.unique(length):
                mine = [np.flatnonzero((length == d) & (side == s)) for s in (1, 0)]
                if not len(mine[0]) or not len(mine[1]):
                    continue
                (i, q), (j, c) = (distinct_rows(ids[m], flat[at[m][:, None] + np.arange(d)[None, :]]) for m in mine)
                got += tile_top(i, q, j, c, k)
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.list_(pa.int64())), pa.array([g[2] for g in got], pa.list_(pa.float64()))], ["query_id", "ids", "scores"])

    best = grouped(left.unionByName(right), "tile", tiles, "query_id long, ids array<long>, scores array<double>")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Merge the sorted lists of a query, one at a time, into a list of k."""
        now, held = None, []

        def out() -> pa.RecordBatch:
            n = len(held)
            return pa.RecordBatch.from_arrays([pa.array([now] * n, pa.int64()), pa.array(range(1, n + 1), pa.int32()), pa.array([i for _, i in held], pa.int64()), pa.array([-s for s, _ in held], pa.float64())], ["query_id", "rank", "vec_id", "score"])

        for b in batches:
            for q, ids, scores in zip(b["query_id"].to_pylist(), b["ids"].to_pylist(), b["scores"].to_pylist()):
                if q != now:
                    if held:
                        yield out()
                    now, held = q, []
                held = list(islice(heapq.merge(held, zip((-s for s in scores), ids)), k))
        if held:
            yield out()

    return best.repartition("query_id").sortWithinPartitions("query_id").mapInArrow(merge, "query_id long, rank int, vec_id long, score double")


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every vector whose id is divisible by 20."""
    v = table(spark, sf_dir, "embeddings")
    return nearest(v, v.filter(F.col("vec_id") % 20 == 0))


SQL = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.x, c.x) AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM p)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 20
"""
