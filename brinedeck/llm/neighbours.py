"""Nearest neighbours of a query set by a block matrix join.

Queries and candidates are dealt to blocks; each pair of a query block and a candidate block is
a tile, computed in a task of its own. A tile rounds both sides to int8 and multiplies them.
Products of int8 vectors give the distance of the rounded vectors exactly, and the rounding
errors of both sides bound how far the true distance can be from it. Pairs that could still be
among a query's ``k`` nearest are computed again in double precision and merged by a heap for
each query; the tiles' heaps are merged by rank. The result is exact.

A candidate is sent once to each query block and a query once to each candidate block; both
kinds of block hold about ``block_numbers`` vector components, so neither side is ever held whole.

Cases: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do
rows without id; vectors of different lengths are never compared; rows that share a query's id
are its own and no candidates; a repeated candidate counts as often as it occurs; of several vectors of
one query id the smallest (as an array) is the query; ties go to the smaller id; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brinedeck.llm.common import ship

ship(__name__)

#: Components of int8 vectors whose products a float32 sum holds exactly.
EXACT = 1000


class Rounded:
    """Rows rounded to int8, with the length of what was lost in each."""

    def __init__(self, rows: np.ndarray):
        top = float(np.abs(rows).max(initial=0.0))
        self.scale = top / 127 if top > 0 else 1.0
        self.int8 = np.rint(rows / self.scale).astype(np.int8)
        whole = self.int8.astype(np.float64)
        self.lost = np.sqrt(((rows - self.scale * whole) ** 2).sum(axis=1))
        self.square = self.scale**2 * (whole**2).sum(axis=1)

    def product(self, other: Rounded, mine: slice, theirs: slice) -> np.ndarray:
        """Exact products of int8 rows, by slices of components short enough for float32."""
        a, b = self.int8[mine], other.int8[theirs]
        total = np.zeros((len(a), len(b)))
        for at in range(0, a.shape[1], EXACT):
            total += a[:, at : at + EXACT].astype(np.float32) @ b[:, at : at + EXACT].astype(np.float32).T
        return total


def exact_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distance of rows, squares added from the first component to the last."""
    if not len(a):
        return np.zeros(0)
    return np.sqrt(np.cumsum((a - b) ** 2, axis=1)[:, -1])


def tile(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, span: int = 2048) -> list[tuple[int, int, float]]:
    """(query, id, distance) of each query's k nearest rows of a tile; ties to the smaller id."""
    heaps: list[list[tuple[float, int]]] = [[] for _ in query_ids]
    limit = np.full(len(query_ids), np.inf)  # no row farther than this is among the k nearest
    rounded_q, rounded_c = Rounded(queries), Rounded(rows)
    for q0 in range(0, len(query_ids), 512):
        mine = slice(q0, q0 + 512)
        for c0 in range(0, len(ids), span):
            theirs = slice(c0, c0 + span)
            near = rounded_q.square[mine, None] + rounded_c.square[None, theirs] - 2 * rounded_q.scale * rounded_c.scale * rounded_q.product(rounded_c, mine, theirs)
            near = np.sqrt(np.maximum(near, 0.0))
            error = (rounded_q.lost[mine, None] + rounded_c.lost[None, theirs]) * (1 + 1e-9) + near * 1e-9 + 1e-12 * (rounded_q.scale + rounded_c.scale)
            own = query_ids[mine, None] == ids[None, theirs]
            high = np.where(own, np.inf, near + error)
            if high.shape[1] >= k:
                limit[mine] = np.minimum(limit[mine], np.partition(high, k - 1, axis=1)[:, k - 1])
            left, right = np.nonzero((near - error <= limit[mine, None]) & ~own)
            for at in range(0, len(left), 1 << 16):
                a, b = left[at : at + (1 << 16)] + q0, right[at : at + (1 << 16)] + c0
                for q, c, d in zip(a.tolist(), ids[b].tolist(), exact_distance(queries[a], rows[b]).tolist(), strict=True):
                    heap, entry = heaps[q], (-d, -c)
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
            for q in range(q0, min(q0 + 512, len(query_ids))):
                if len(heaps[q]) == k:
                    limit[q] = min(limit[q], -heaps[q][0][0])
    return [(int(query_ids[q]), -c, -d) for q, heap in enumerate(heaps) for d, c in heap]


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding", block_numbers: int = 1 << 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of each row that ``is_query``, by Euclidean distance."""
    vector = F.col(vector_column).cast("array<double>")
    rows = vectors.filter(F.col(id_column).isNotNull() & usable(vector))
    rows = rows.select(F.col(id_column).cast("long").alias("id"), vector.alias("vector"), F.size(vector).alias("length"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    numbers = F.coalesce(F.sum("length"), F.lit(0))
    in_all, in_queries = rows.agg(numbers, F.coalesce(F.sum(F.when(F.col("is_query"), F.col("length"))), F.lit(0))).first()
    query_blocks, blocks = (max(1, -(-int(n) // block_numbers)) for n in (in_queries, in_all))
    queries = rows.filter("is_query").groupBy("id").agg(F.min(F.struct("length", "vector")).alias("_v")).select("id", F.col("_v.vector").alias("vector"), F.col("_v.length").alias("length"))
    queries = queries.withColumn("query_block", F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int")  # equal ids are spread as well
    candidates = rows.select("id", "vector", "length", dealt.alias("block")).withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))

    def join(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            found = tile(left["id"].to_numpy(np.int64), np.stack(left["vector"].to_list()).astype(float), right["id"].to_numpy(np.int64), np.stack(right["vector"].to_list()).astype(float), k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    key = ["length", "query_block", "block"]
    met = queries.groupBy(*key).cogroup(candidates.groupBy(*key)).applyInPandas(join, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")  # at most k rows from each block
    ranked = met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
