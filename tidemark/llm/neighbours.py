"""Approximate nearest neighbours by inner product: a hash-prefix forest.

Every row block holds a forest over its own vectors: per tree a long hash
string (signs of ``BITS`` orthogonalised random projections), kept as a sorted
array.  A query descends each tree to the longest prefix it shares with any
string, then all trees ascend together, one prefix bit at a time, until their
matching ranges together hold ``reach`` times the block's rows (and their union
``FLOOR`` * ``k`` rows, if there are so many); the union of the ranges is scored exactly in double precision.  Vectors are extended by one coordinate
that makes all norms of a block equal, so that hashing by angle serves the
inner product.

All rows are indexed and all queries meet every row block, in query blocks.
Equal vectors are one index entry with the ``k`` + 1 smallest ids: no other of
their ids can be among a query's ``k`` nearest.  A query's candidates from all
blocks meet after each block has cut its own to ``k``.

Defined results: vectors that are null, empty, zero, or hold null or
non-finite components take no part, nor do rows without vec_id or of another
length than the query's; rows that repeat vec_id and vector count once; a
vec_id with several vectors is a query for each; ties go to the smaller
vec_id; fewer candidates than ``k`` are all returned; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import n_blocks, table

TREES = 96
BITS = 24
#: Ranges of all trees together, as a multiple of the block's rows.
REACH = 0.45
#: Least candidates of a query in a block, in multiples of k (small blocks).
FLOOR = 30
ROW_BLOCK = 8192
QUERY_BLOCK = 2048
FOUND = "query_id bigint, vec_id bigint, score double"


def _usable(vec: Column) -> Column:
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)))
    return F.coalesce(vec.isNotNull() & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def projections(dim: int, trees: int = TREES, bits: int = BITS) -> np.ndarray:
    """dim x (trees * bits) directions, orthogonal within batches of ``dim``."""
    rng, parts, need = np.random.default_rng(3), [], trees * bits
    while sum(p.shape[1] for p in parts) < need:
        parts.append(np.linalg.qr(rng.normal(size=(dim, dim)))[0])
    return np.concatenate(parts, axis=1)[:, :need]


def _strings(x: np.ndarray, proj: np.ndarray, trees: int) -> np.ndarray:
    """trees x rows hash strings, first bit highest."""
    bits = proj.shape[1] // trees
    out = np.zeros((trees, len(x)), np.uint32)
    sign = (x @ proj > 0).reshape(len(x), trees, bits)
    for b in range(bits):
        out = (out << np.uint32(1)) | sign[:, :, b].T
    return out


class Forest:
    def __init__(self, x: np.ndarray, trees: int = TREES, bits: int = BITS):
        self.x, self.trees, self.bits = x, trees, bits
        norm = np.linalg.norm(x, axis=1)
        self.top = norm.max()
        rest = np.sqrt(np.maximum(1 - (norm / self.top) ** 2, 0))
        self.proj = projections(x.shape[1] + 1, trees, bits)
        h = _strings(np.column_stack([x / self.top, rest]), self.proj, trees)
        self.order = np.argsort(h, axis=1, kind="stable")
        self.sorted = np.take_along_axis(h, self.order, axis=1)

    def ranges(self, q: np.ndarray, need: float) -> tuple[np.ndarray, np.ndarray]:
        """Per tree and query the range of strings that match down to the level
        at which the trees' ranges together first hold ``need`` rows."""
        unit = q / np.linalg.norm(q, axis=1, keepdims=True)
        h = _strings(np.column_stack([unit, np.zeros(len(q))]), self.proj, self.trees)
        lo, hi = np.zeros(h.shape, np.int64), np.zeros(h.shape, np.int64)
        open_ = np.arange(len(q))
        # descend: the longest prefix shared with a neighbour in sorted order
        depth = np.zeros(len(q), np.int64)
        for t in range(self.trees):
            at = np.searchsorted(self.sorted[t], h[t])
            for near in (np.maximum(at - 1, 0), np.minimum(at, len(self.x) - 1)):
                differ = (self.sorted[t][near] ^ h[t]).astype(np.float64)
                depth = np.maximum(depth, self.bits - np.where(differ > 0, np.floor(np.log2(np.maximum(differ, 1))) + 1, 0)
                                   .astype(np.int64))
        # ascend synchronously; prefixes that still hold nothing are skipped
        level = int(depth.max(initial=0))
        while len(open_) and level >= 0:
            mask = np.uint32(((1 << level) - 1) << (self.bits - level))
            tail = np.uint32((1 << (self.bits - level)) - 1)
            now = open_[depth[open_] >= level]
            if len(now):
                for t in range(self.trees):
                    first = h[t, now] & mask
                    lo[t, now] = np.searchsorted(self.sorted[t], first)
                    hi[t, now] = np.searchsorted(self.sorted[t], first | tail, side="right")
                full = (hi[:, now] - lo[:, now]).sum(0) >= need
                open_ = np.setdiff1d(open_, now[full])
            level -= 1
        return lo, hi

    def _union(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        seen = np.zeros(len(self.x), bool)
        for t in range(self.trees):
            seen[self.order[t, lo[t]:hi[t]]] = True
        return np.flatnonzero(seen)

    def search(self, q: np.ndarray, k: int, reach: float):
        """(rows, scores) of the best candidates of every query; all that tie
        with the k-th are among them."""
        # a query that is a row itself is in every tree's range
        need = reach * len(self.x) + self.trees
        lo, hi = self.ranges(q, need)
        for i in range(len(q)):
            rows, more = self._union(lo[:, i], hi[:, i]), need
            while len(rows) < min(len(self.x), FLOOR * k):      # ascend further
                more *= 2
                own = self.ranges(q[i:i + 1], more)
                rows = self._union(own[0][:, 0], own[1][:, 0])
            score = self.x[rows] @ q[i]
            if len(rows) > 2 * k:
                least = np.partition(score, len(score) - k - 1)[len(score) - k - 1]    # one may be the query itself
                rows = rows[score >= least - 1e-9 * max(1.0, abs(least))]
            # the reported sum runs over the coordinates in order
            yield rows, np.cumsum(self.x[rows] * q[i], axis=1)[:, -1]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64)


def _search(k: int, reach: float):
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        q_id, q_dim = queries.column("query_id").to_pylist(), np.array(queries.column("dim").to_pylist())
        r_dim = np.array(rows.column("dim").to_pylist())
        out: list[tuple] = []
        for dim in np.intersect1d(q_dim, r_dim):
            qi, ri = np.flatnonzero(q_dim == dim), np.flatnonzero(r_dim == dim)
            forest = Forest(_matrix(rows.column("vec").take(ri)))
            ids = rows.column("ids").take(ri).to_pylist()
            for i, (found, score) in zip(qi, forest.search(_matrix(queries.column("vec").take(qi)), k, reach)):
                best = sorted((-s, v) for j, s in zip(found.tolist(), score.tolist()) for v in ids[j] if v != q_id[i])
                out += [(q_id[i], v, -s) for s, v in best[:k]]
        cols = list(zip(*out)) if out else [(), (), ()]
        return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())],
                        names=["query_id", "vec_id", "score"])
    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, reach: float = REACH) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows found per query.
    Both inputs have vec_id and embedding."""
    def clean(df: DataFrame) -> DataFrame:
        return df.where(F.col("vec_id").isNotNull() & _usable(F.col("embedding"))).select(
            F.col("vec_id").cast("bigint").alias("vec_id"),
            F.transform("embedding", lambda x: x.cast("double")).alias("vec"))

    # equal vectors: the smallest ids only; Spark cuts them before the shuffle
    few = clean(vectors).withColumn("_n", F.dense_rank().over(Window.partitionBy("vec").orderBy("vec_id"))).where(
        F.col("_n") <= k + 1)
    entries = few.groupBy("vec").agg(F.array_sort(F.collect_set("vec_id")).alias("ids")).checkpoint()
    asked = clean(queries).distinct().checkpoint()
    n_rows, n_asked = n_blocks(entries.count(), ROW_BLOCK), n_blocks(asked.count(), QUERY_BLOCK)
    rows = entries.select("vec", "ids", F.size("vec").alias("dim"), F.pmod(F.xxhash64("ids"), F.lit(n_rows)).alias("rb"),
                          F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1))).alias("qb"))
    own = asked.select(F.col("vec_id").alias("query_id"), "vec", F.size("vec").alias("dim"),
                       F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1)).cast("array<bigint>")).alias("rb"),
                       F.pmod(F.xxhash64("vec_id"), F.lit(n_asked)).cast("int").alias("qb"))
    found = own.groupBy("rb", "qb").cogroup(rows.groupBy("rb", "qb")).applyInArrow(_search(k, reach), FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)
