"""Exact top-k by inner product of scaled integer vectors: a KD-tree a shard, searched best first."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import grouped, saved, table

FOUND = "query_id long, ids array<long>, scores array<long>"
LONG = (-(1 << 63), (1 << 63) - 1)


class Tree:
    """A KD-tree: each node's rows are rows[start:stop] and lie in the tight box lo..hi; a leaf has no children."""

    def __init__(self, x: np.ndarray, leaf: int) -> None:
        self.rows = np.arange(len(x))
        self.lo, self.hi, self.start, self.stop, self.children = [], [], [], [], []
        self._add(x, 0, len(x))
        todo = [0]
        while todo:
            n = todo.pop()
            a, b = self.start[n], self.stop[n]
            spread = self.hi[n] - self.lo[n]
            if b - a <= leaf or not spread.any():
                continue
            widest, middle = int(np.argmax(spread)), (b - a) // 2
            mine = self.rows[a:b]
            self.rows[a:b] = mine[np.argpartition(x[mine, widest], middle)]
            self.children[n] = (self._add(x, a, a + middle), self._add(x, a + middle, b))
            todo += self.children[n]
        self.x, self.lo, self.hi = x[self.rows], np.array(self.lo), np.array(self.hi)

    def _add(self, x: np.ndarray, a: int, b: int) -> int:
        mine = x[self.rows[a:b]]
        self.lo.append(mine.min(axis=0))
        self.hi.append(mine.max(axis=0))
        self.start.append(a)
        self.stop.append(b)
        self.children.append(None)
        return len(self.start) - 1

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """For each query and node, the largest inner product that a point of the node's box can have."""
        return np.maximum(q, 0) @ self.hi.T + np.minimum(q, 0) @ self.lo.T


def scaled(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) in doubles."""
    return np.floor(scale * x.astype(np.float64))


def exact(q: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """q and c as doubles if all their inner products and partial sums are exact so, else as Python integers."""
    top = lambda a: float(np.abs(a).max()) if a.size else 0.0
    if top(q) * top(c) * max(1, q.shape[1]) < 1 << 53:
        return q, c
    whole = lambda a: np.array([int(v) for v in a.ravel()], dtype=object).reshape(a.shape)
    return whole(q), whole(c)


def search(tree: Tree, ids: np.ndarray, qid: np.ndarray, q: np.ndarray, least: list[int | None], k: int) -> Iterator[tuple[int, list[int], list[int]]]:
    """For each query its k best rows of the tree (ids by row of tree.x), those below `least` left out; ties to smaller ids.

    Nodes are taken by the largest bound first; the search ends when no bound reaches the k-th score found so far,
    or the k-th score that another shard has given.
    """
    bounds = tree.bounds(q)
    for i in range(len(qid)):
        mine = bounds[i]
        heap = [(-mine[0], 0)]
        best_s, best_i = q[:0, 0] if q.shape[1] else np.zeros(0), ids[:0]
        low = least[i]
        while heap:
            bound, n = heapq.heappop(heap)
            if low is not None and -bound < low:
                break
            if tree.children[n]:
                for c in tree.children[n]:
                    if low is None or mine[c] >= low:
                        heapq.heappush(heap, (-mine[c], c))
                continue
            a, b = tree.start[n], tree.stop[n]
            s = tree.x[a:b] @ q[i] if q.shape[1] else np.zeros(b - a)
            if s.dtype == object:
                s = np.array([min(max(v, LONG[0]), LONG[1]) for v in s], dtype=object)
            good = ids[a:b] != qid[i]
            if low is not None:
                good &= s >= low
            at = np.flatnonzero(good)
            if not len(at):
                continue
            best_s, best_i = np.concatenate([best_s, s[at]]), np.concatenate([best_i, ids[a:b][at]])
            top = np.lexsort((best_i, -best_s))[:k]
            best_s, best_i = best_s[top], best_i[top]
            if len(top) == k and (low is None or best_s[-1] > low):
                low = best_s[-1]
        if len(best_i):
            yield int(qid[i]), best_i.tolist(), [int(v) for v in best_s]


def _vectors(part: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Components of all rows in one array, where each row begins, and its length."""
    x = part["x"].combine_chunks()
    if isinstance(x, pa.ChunkedArray):
        x = pa.concat_arrays(x.chunks) if x.num_chunks else pa.array([], x.type)
    length = x.value_lengths().to_numpy(zero_copy_only=False)
    return x.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(length)][:-1], length


def top_k(vectors: DataFrame, queries: DataFrame, *, k: int = 10, id: str = "vec_id", vector: str = "embedding", scale: int = 1024, shard_rows: int = 8192, query_block: int = 1024, leaf: int = 64) -> DataFrame:
    """query_id, rank (from 1), the id and score of each query's k best rows by inner product of floor(scale * x).

    Rows are dealt to shards of about shard_rows by a hash, so that no group of equal vectors fills one, and each
    shard's task builds a KD-tree: median splits of the widest side of tight boxes. First each query is searched in
    one shard, its home; its k-th score there is then a floor for all other shards, where it meets every tree in
    blocks of about query_block queries. Both passes go best first and leave out only nodes whose box can't reach
    the k-th score, so the result is exact; it holds the k best of each shard at most until they are merged.

    Vectors that are null or hold null or non-finite components, and null ids, take no part; zero vectors do.
    Vectors meet only those of their own length. A row is never its own neighbour, nor is another row of its id;
    rows equal in id and vector count once; an id with several vectors is one query, whose best pairs are taken
    from all of them. Components too large for exact doubles are multiplied as integers of any size, and scores
    beyond a long count as its ends. No vector or no query: no rows.
    """
    finite = F.coalesce(F.forall(vector, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False))), F.lit(False))
    rows = lambda df: df.filter(F.col(id).isNotNull() & finite).select(F.col(id).cast("long").alias("id"), F.col(vector).alias("x")).distinct()
    vectors, queries = saved(rows(vectors)), saved(rows(queries))
    shards, blocks = max(1, -(-vectors.count() // shard_rows)), max(1, -(-queries.count() // query_block))
    shard, block, home = F.expr(f"pmod(xxhash64(id, x), {shards}L)"), F.expr(f"pmod(xxhash64(id, x, 1), {blocks}L)"), F.expr(f"pmod(xxhash64(id, x, 2), {shards}L)")
    none = F.lit(None).cast("long")

    def tiles(t: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a, b in zip(starts[:-1], starts[1:]):
            part = t.slice(a, b - a).combine_chunks()
            ids, asks, least = part["id"].to_numpy(), part["query"].to_numpy(zero_copy_only=False).astype(bool), part["least"].to_pylist()
            flat, first, length = _vectors(part)
            got: list[tuple[int, list[int], list[int]]] = []
            for d in np.unique(length[asks]):
                qi, ci = np.flatnonzero((length == d) & asks), np.flatnonzero((length == d) & ~asks)
                if not len(ci):
                    continue
                of = lambda at: scaled(flat[first[at][:, None] + np.arange(d)[None, :]], scale)  # noqa: B023, E731
                q, c = exact(of(qi), of(ci))
                tree = Tree(c, leaf)
                got += search(tree, ids[ci][tree.rows], ids[qi], q, [least[j] for j in qi], k)
            yield pa.RecordBatch.from_arrays([pa.array([g[n] for g in got], kind) for n, kind in enumerate((pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())))], ["query_id", "ids", "scores"])

    asked = queries.withColumn("home", home)
    at_home = vectors.select("id", "x", F.lit(False).alias("query"), none.alias("least"), shard.alias("tile"))
    at_home = saved(grouped(at_home.union(asked.select("id", "x", F.lit(True), none, "home")), "tile", tiles, FOUND))
    found = at_home
    if shards > 1:
        floors = at_home.filter(F.size("scores") == k).groupBy(F.col("query_id").alias("id")).agg(F.max(F.element_at("scores", -1)).alias("least"))
        asked = asked.join(floors, "id", "left").withColumn("b", block)
        away = asked.select("id", "x", F.lit(True).alias("query"), "least", "b", "home", F.explode(F.expr(f"sequence(0L, {shards - 1}L)")).alias("s")).filter("s <> home")
        away = away.select("id", "x", "query", "least", (F.col("b") * shards + F.col("s")).alias("tile"))
        met = vectors.select("id", "x", F.lit(False).alias("query"), none.alias("least"), F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")).alias("b"))
        met = met.select("id", "x", "query", "least", (F.col("b") * shards + shard).alias("tile"))
        found = at_home.union(grouped(met.union(away), "tile", tiles, FOUND))
    pairs = found.select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("p")).select("query_id", F.col("p.ids").alias("vec_id"), F.col("p.scores").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 highest scores of every vector whose id is divisible by 100."""
    v = table(spark, sf_dir, "embeddings")
    return top_k(v, v.filter(F.col("vec_id") % 100 == 0))


SQL = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda e: floor(1024 * e)) AS x FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM p)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 10
"""
