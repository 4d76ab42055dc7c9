"""Exact top-k inner-product search by the threshold algorithm.

Candidates are searched where the grid of vectors.py brings them, in blocks of rows. A block keeps one list per dimension, sorted by that component.
A query goes down all lists at once, from the end that its own component favours, and scores the rows that it meets. The
components at the depth reached bound the score of every row not yet met; when this bound is less than the
k-th score so far, the rest of the block can't enter the result. The k-th score is carried from block to block, and all but the first chunk of rows begin with
that of the first.

Queries are a stated set; they are dealt into groups and meet the chunks of rows in the cells of the grid, so nothing goes through the driver. A cell returns k
rows a query at most, which are merged by query.

Scores are exact: they are computed in floating point where every sum stays below 2^53, and in 64-bit integers beyond. A score that
could leave 64 bits is an error, as there is no column to hold it.

Results for edge cases: vectors that are null, empty, or hold null or non-finite components, and rows with a null id, take no
part. A query meets only vectors of its own length, and no row of its own id. A repeated query row is answered
once more; repeated candidate rows count each. Ties go to the smaller id. Empty tables give no rows. Other columns, whatever their names,
are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talkweave.llm.common import stored, table
from talkweave.llm.vectors import Scores, grid, merged, prepared, searched

#: Rows of each list in the first step down; each next step goes four times as deep.
FIRST_DEPTH = 16


class Block(Scores):
    def __init__(self, ids: np.ndarray, x: np.ndarray):
        super().__init__(x)
        self.ids = ids
        self.lists = np.argsort(x, axis=0, kind="stable").T  # by dimension, ascending

    def search(self, q: np.ndarray, own: int, k: int, ids: np.ndarray, scores: np.ndarray, least: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
        """ids, scores: the best so far, the best first; returns the new ones. Rows below ``least`` aren't wanted."""
        n, dims = self.x.shape
        x, q = self.exact(q)
        up = np.where(q > 0, -1, 1)  # from which end
        met = np.zeros(n, bool)
        met[self.ids == own] = True
        at, depth = 0, FIRST_DEPTH
        every = np.arange(dims)
        while at < n:
            to = min(depth, n)
            span = np.arange(at, to)
            rows = np.where(up[:, None] > 0, self.lists[:, span], self.lists[:, n - 1 - span]).ravel()
            new = np.zeros(n, bool)
            new[rows] = True
            new &= ~met
            met |= new
            rows = np.flatnonzero(new)
            if len(scores) == k:
                least = max(least, scores[-1])
            if len(rows):
                s = x[rows] @ q
                ids, scores = merged(ids, scores, self.ids[rows[s >= least]], s[s >= least], k)
                if len(scores) == k:
                    least = max(least, scores[-1])
            edge = x[np.where(up > 0, self.lists[:, to - 1], self.lists[:, n - to]), every]
            if edge @ q < least:
                break
            at, depth = to, 4 * depth
        return ids, scores


class TopK:
    """given: the first bound, if there is one."""

    def __init__(self, k: int, keys: np.ndarray, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, given: list):
        self.k, self.keys, self.ids, self.x = k, keys, ids, x
        self.least = [g[0] if g else -np.inf for g in given]
        self.best = [(np.empty(0, np.int64), np.empty(0))] * len(ids)

    def block(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
        block = Block(ids, x)
        self.best = [block.search(q, own, self.k, *b, least) for q, own, b, least in zip(self.x, self.ids, self.best, self.least)]

    def found(self) -> list[tuple]:
        return [(int(key), int(own), int(i), int(s)) for key, own, best in zip(self.keys, self.ids, self.best) for i, s in zip(*best)]


def top_k(df: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, scale: int = 1024) -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows for each row where ``is_query`` holds."""
    queries, rows, groups, chunks = grid(prepared(df, F.col(id_col), F.col(vector_col), F.lit(None), is_query, scale))
    cells = lambda asked, which: searched(asked, rows, groups, which, lambda *q: TopK(k, *q), "key long, query_id long, vec_id long, score long", ["key", "query_id", "vec_id", "score"])
    found = stored(cells(queries.withColumn("given", F.array().cast("array<long>")), range(1)))
    if chunks > 1:
        bounds = found.groupBy("key").agg(F.when(F.count("*") >= k, F.array(F.min("score"))).alias("given"))
        found = found.unionAll(cells(queries.join(bounds, "key", "left"), range(1, chunks)))
    order = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s) WHERE n <= 10
"""
