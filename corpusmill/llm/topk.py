"""Exact top-k search by no-random-access aggregation of sorted lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

SCALE = 64
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 16_384
LIST_BLOCK = 4_096
NOTHING = -(1 << 62)
# Shares of the lists that are read before the bounds are looked at again.
DEPTHS = (0.5, 0.75, 1.0)


def integer_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component; rows with a null or non-finite one are left out.

    Rows that repeat an id count as one, with the least of their vectors; a null id is left out.
    """
    x = F.transform(F.col("embedding"), lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    good = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite)
    v = F.transform(x, lambda c: F.floor(c * scale).cast("long"))
    return good.select(F.col("vec_id").cast("long"), v.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


class SortedLists:
    """One list per component of some vectors, sorted by value, readable from both ends."""

    def __init__(self, vectors: np.ndarray, kind: type) -> None:
        self.size = len(vectors)
        self.values = vectors.astype(kind)
        order = np.argsort(vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.values, order, axis=0)
        self.place = np.empty_like(order)
        np.put_along_axis(self.place, order, np.arange(self.size)[:, None], axis=0)

    def bounds(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of all components after `depth` entries were read from an end of each list.

        (least, most), each with the columns as read from the top, then as read from the
        bottom. What was read is known; what was not lies between the list's other end and the
        entry read last.
        """
        n = self.size
        from_top, from_bottom = self.place >= n - depth, self.place < depth
        top, bottom = self.sorted[max(n - depth, 0)], self.sorted[min(depth, n) - 1]
        least = np.hstack([
            np.where(from_top, self.values, self.sorted[0]), np.where(from_bottom, self.values, bottom)
        ])
        most = np.hstack([
            np.where(from_top, self.values, top), np.where(from_bottom, self.values, self.sorted[-1])
        ])
        return least, most


def _exact_kind(queries: np.ndarray, vectors: np.ndarray) -> type:
    """A number type in which all inner products are exact."""
    high = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(queries.shape[1], 1)
    return np.float32 if high < 2**24 else np.float64 if high < 2**53 else np.int64


def block_top_k(
    queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int,
    depths: tuple[float, ...] = DEPTHS, list_block: int = LIST_BLOCK,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, vector id, score): the k best of `vectors` for every query, ties to smaller ids.

    The lists of each block of vectors are read from the top for components in which the query
    is positive, from the bottom where it is negative, all to the same depth. At each depth every
    vector has a lower and an upper bound of its score. Vectors whose upper bound is below the
    k-th best lower bound of all blocks so far are out. A query stops when no more than k are in;
    the scores of those are resolved. Read to the end, both bounds are the score.
    """
    kind = _exact_kind(queries, vectors)
    signed = np.hstack([np.maximum(queries, 0), np.minimum(queries, 0)]).astype(kind)
    best_scores = np.full((len(queries), k), NOTHING, np.int64)
    best_ids = np.full((len(queries), k), -1, np.int64)
    for start in range(0, len(vectors), list_block):
        own, names = vectors[start : start + list_block], ids[start : start + list_block]
        lists = SortedLists(own, kind)
        going = np.arange(len(queries))
        floor = best_scores[:, -1].copy()
        rows, cols = [], []
        for share in depths:
            least, most = lists.bounds(max(1, int(np.ceil(share * len(own)))))
            # for a negative component of the query the largest value gives the least score
            half = own.shape[1]
            low = np.hstack([least[:, :half], most[:, half:]])
            high = np.hstack([most[:, :half], least[:, half:]])
            upper = signed[going] @ high.T
            lower = upper if share == depths[-1] else signed[going] @ low.T
            same = query_ids[going][:, None] == names[None, :]
            if len(own) > k:
                seen = np.where(same, NOTHING, lower) if same.any() else lower
                kth = np.partition(seen, len(own) - k, axis=1)[:, len(own) - k]
                floor[going] = np.maximum(floor[going], np.ceil(kth.astype(np.float64)).astype(np.int64))
            inside = (upper >= floor[going][:, None]) & ~same
            done = (inside.sum(1) <= k) | (share == depths[-1])
            r, c = np.nonzero(inside[done])
            rows.append(going[done][r])
            cols.append(c)
            going = going[~done]
            if not len(going):
                break
        row, col = np.concatenate(rows), np.concatenate(cols)
        score = np.einsum("ij,ij->i", queries[row], own[col])
        _merge(best_scores, best_ids, row, names[col], score, k)
    row, col = np.nonzero(best_scores > NOTHING)
    return row, best_ids[row, col], best_scores[row, col]


def _merge(scores: np.ndarray, ids: np.ndarray, row: np.ndarray, name: np.ndarray, score: np.ndarray, k: int) -> None:
    """Puts new results among the best of their rows."""
    touched = np.unique(row)
    old = np.repeat(touched, k)
    row = np.concatenate([old, row])
    name, score = np.concatenate([ids[touched].ravel(), name]), np.concatenate([scores[touched].ravel(), score])
    order = np.lexsort([name, -score, row])
    row, name, score = row[order], name[order], score[order]
    first = np.searchsorted(row, row)
    rank = np.arange(len(row)) - first
    keep = rank < k
    ids[row[keep], rank[keep]], scores[row[keep], rank[keep]] = name[keep], score[keep]


def top_k(
    queries: DataFrame, vectors: DataFrame, k: int, query_block: int = QUERY_BLOCK, block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k largest inner products, without its own id.

    Both tables have (vec_id, v) as from `integer_vectors`; ties go to the smaller id, and only
    vectors of one length are compared. Queries and vectors are dealt into blocks by a hash, and
    a task answers one block of queries from one block of vectors, so its memory does not grow
    with the data. The best k of each block are ranked against each other.
    """
    n_queries, n = queries.count(), vectors.count()
    query_blocks, blocks = max(1, -(-n_queries // query_block)), max(1, -(-n // block))

    def dealt(rows: DataFrame, side: int, own: int, others: int) -> DataFrame:
        mine: Column = F.pmod(F.xxhash64("vec_id"), F.lit(own)).cast("int")
        all_others: Column = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        pair = ["a", "b"] if side == 0 else ["b", "a"]
        placed = rows.select("vec_id", "v", mine.alias(pair[0])).select("*", all_others.alias(pair[1]))
        return placed.select("a", "b", F.size("v").alias("length"), "vec_id", "v")

    def answer(keys: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        length = keys[2].as_py()
        one, two = (
            t.column("v").combine_chunks().flatten().to_numpy().reshape(t.num_rows, length) for t in (left, right)
        )
        query_ids, ids = left.column("vec_id").to_numpy(), right.column("vec_id").to_numpy()
        if left.num_rows and right.num_rows:
            row, name, score = block_top_k(one, query_ids, two, ids, k)
        else:
            row = name = score = np.zeros(0, np.int64)
        return pa.table({"query_id": query_ids[row], "vec_id": name, "score": score})

    cells = ["a", "b", "length"]
    found = dealt(queries, 0, query_blocks, blocks).groupBy(*cells).cogroup(
        dealt(vectors, 1, blocks, query_blocks).groupBy(*cells)
    ).applyInArrow(answer, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def similar_vectors(rows: DataFrame, every: int = 20, k: int = 20, scale: int = SCALE) -> DataFrame:
    """The k best partners of every vector whose id is divisible by `every`."""
    vectors = integer_vectors(rows, scale)
    return top_k(vectors.where(F.col("vec_id") % every == 0), vectors, k)


TOP_K_SQL = """
WITH good AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
), vectors AS (
    SELECT vec_id, min(v) AS v FROM good GROUP BY vec_id
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM scored
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM ranked WHERE n <= 20
"""
