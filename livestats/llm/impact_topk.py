"""Exact top-k search by inner product over an impact-ordered index, score at a time.

Components become integers (``floor(64 x)``).  The index of a block of vectors
groups its postings (vector, dimension, value) by quantised impact, the leading
bits of the value's magnitude.  A block of queries takes the segments in
descending impact and adds their postings to the score accumulators.  After a
segment the part of a vector that is still to come has a known length, so
accumulator +- |query| * |rest| bounds its score (Cauchy-Schwarz).  A query
stops when those bounds prove that few enough vectors can still be among its k
best; exactly these possible members are scored anew from the full vectors.

The queries are a stated set (every row whose id the modulus divides) against
all rows.  Both sides are dealt in blocks to the cells of a grid, a cell holds
one block of each, and only k rows of a query leave a cell.

Defined cases: vectors that are NULL or hold a NULL, NaN or infinite component,
and rows without an id, take no part; vectors of different length share the
leading dimensions, missing ones count 0; equal scores go to the smaller
vec_id, rows of equal vec_id are separate candidates but never their own
query's; an empty table yields no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCALE = 64
QUERY_EVERY = 20
K = 20
#: Rows of a block of vectors and of a block of queries at the aim.
VECTOR_BLOCK = 16384
QUERY_BLOCK = 1024
#: A query stops once this share of a block's vectors can still be members (or 4 k of them).
STOP_SHARE = 0.01


def quantised(vectors: DataFrame) -> DataFrame:
    """``vec_id, v array<int>`` of the vectors that take part."""
    x = F.transform(F.col("embedding"), lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"), bad.alias("bad"))
    rows = rows.where("vec_id is not null and x is not null and not bad")
    return rows.select("vec_id", F.transform("x", lambda c: F.floor(c * SCALE).cast("long")).alias("v"))


class Index:
    """Postings of a block of vectors in segments of descending impact."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors.astype(np.float64)
        size = np.abs(vectors)
        impact = np.zeros(vectors.shape, np.int64)
        impact[size > 0] = np.floor(np.log2(size[size > 0])).astype(np.int64) + 1
        self.segments = []
        left = (self.vectors ** 2).sum(axis=1)
        for level in range(int(impact.max(initial=0)), 0, -1):
            vector, dimension = np.nonzero(impact == level)
            if len(vector):
                left = left - np.bincount(vector, self.vectors[vector, dimension] ** 2, len(vectors))
                self.segments.append((vector, dimension, np.sqrt(np.maximum(left, 0)) * (1 + 1e-9) + 1e-6))

    def search(self, queries: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int) -> list[np.ndarray]:
        """Row numbers that hold every possible one of the ``k`` best of each query.

        ``own[q]`` marks a query's id; rows of that id are no candidates.
        """
        n = len(self.vectors)
        queries = queries.astype(np.float64)
        length = np.sqrt((queries ** 2).sum(axis=1))
        possible: list[np.ndarray] = [np.arange(n)] * len(queries)
        if n <= 4 * k:
            return possible
        open_ = np.arange(len(queries))
        total = np.zeros((len(queries), n))
        few = max(4 * k, int(STOP_SHARE * n))
        plane = np.zeros(self.vectors.shape)
        for vector, dimension, rest in self.segments:
            plane[vector, dimension] = self.vectors[vector, dimension]
            total[open_] += queries[open_] @ plane.T
            plane[vector, dimension] = 0
            still = []
            for q in open_:
                slack = length[q] * rest
                low = total[q] - slack
                low[ids == own[q]] = -np.inf
                at_least = np.partition(low, n - k)[n - k]
                possible[q] = np.flatnonzero(total[q] + slack >= at_least)
                if len(possible[q]) > few:
                    still.append(q)
            open_ = np.array(still, np.int64)
            if not len(open_):
                break
        return possible


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :min(len(v), width)] = v[:width]
    return out


def _best(queries: pd.DataFrame, vectors: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` best of a cell's vectors for each of its queries."""
    width = max((len(v) for v in queries["v"]), default=0)
    rows, ids = _matrix(vectors["v"], width), vectors["vec_id"].to_numpy(np.int64)
    wanted, own = _matrix(queries["v"], width), queries["vec_id"].to_numpy(np.int64)
    out = []
    for q, at in enumerate(Index(rows).search(wanted, own, ids, k)):
        at = at[ids[at] != own[q]]
        scores = rows[at] @ wanted[q]  # exact integers
        best = np.lexsort((ids[at], -scores))[:k]
        out.append(pd.DataFrame({"query_id": own[q], "query": queries["query"].iloc[q], "vec_id": ids[at[best]],
                                 "score": scores[best]}))
    return pd.concat(out) if out else pd.DataFrame(columns=["query_id", "query", "vec_id", "score"])


def top_k(vectors: DataFrame, k: int = K, query_every: int = QUERY_EVERY, vector_block: int = VECTOR_BLOCK,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best candidates of every query."""
    rows = quantised(vectors)
    is_query = F.col("vec_id") % query_every == 0
    n_rows, n_queries = rows.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    n_vector_blocks = max(1, -(-n_rows // vector_block))
    n_query_blocks = max(1, -(-n_queries // query_block))
    deal = F.xxhash64("vec_id", F.monotonically_increasing_id())
    # each side meets all blocks of the other: rows times blocks, never rows times rows
    stored_side = rows.select("vec_id", "v", F.pmod(deal, F.lit(n_vector_blocks)).cast("int").alias("vb"), F.explode(
        F.sequence(F.lit(0), F.lit(n_query_blocks - 1))).alias("qb"))
    query_side = rows.where(is_query).select("vec_id", "v", F.monotonically_increasing_id().alias("query"), F.pmod(
        deal, F.lit(n_query_blocks)).cast("int").alias("qb"))
    query_side = query_side.withColumn("vb", F.explode(F.sequence(F.lit(0), F.lit(n_vector_blocks - 1))))

    def cell(queries: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        return _best(queries, stored, k)

    found = query_side.groupBy("vb", "qb").cogroup(stored_side.groupBy("vb", "qb")).applyInPandas(
        cell, "query_id bigint, query bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
