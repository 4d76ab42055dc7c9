"""Hard negatives of anchors: rows of another label that score nearly as high as a positive, exactly.

Two searches over the grid of vectors.py, both by coordinate pruning. Rows come by falling length and are cut into length buckets; a bucket keeps the
sorted list of every coordinate of its unit vectors. A query needs a score of at least a threshold; with the bucket's longest row this gives the least cosine that a row of
it can do with, so a bucket whose rows are too short is passed over whole. Each of the query's focus coordinates (the largest of its unit vector) then has a feasible range of
values, from the angles between query, axis and row; two binary searches cut it out of the sorted list, and rows that lie in the ranges of all focus coordinates are verified by their
exact score.

First search: the positives, the best rows of the anchor's label; the threshold is the k-th score so far, from a first bound on. Second: the negatives of all of an anchor's
positives at once; the threshold is the least that any of them still needs, from the lower end of its window.

Results for edge cases: rows with a null id or label, a null or empty vector, or null or non-finite components take no part. A row meets only vectors of its own
length. Repeated rows count each, as candidates and as anchors; a row is never a positive of its own id. Ties go to the smaller id. A positive with a negative score has no
negatives, as its window is empty; zero vectors score 0. Empty tables give no rows. Other columns, whatever their names, are ignored. Scores beyond
64 bits are an error.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talkweave.llm.common import stored, table
from talkweave.llm.vectors import Scores, grid, merged, prepared, searched

FOCUS = 4
#: Cosines may be wrong by so much, so feasible ranges are wider by it.
SLACK = 1e-9


class LengthBucket(Scores):
    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        super().__init__(x)
        self.ids, self.labels = ids, labels
        norms = np.sqrt((x * x).sum(axis=1))
        self.longest = float(norms.max())
        unit = x / np.where(norms > 0, norms, 1)[:, None]
        self.order = np.argsort(unit, axis=0).T
        self.lists = np.take_along_axis(unit.T, self.order, axis=1)

    def candidates(self, unit: np.ndarray, norm: float, least: float) -> np.ndarray | None:
        """The rows that may score ``least`` or more; None for all."""
        if least <= 0:
            return None
        reach = norm * self.longest
        if least > reach * (1 + SLACK):
            return np.empty(0, np.int64)
        cos = min(1.0, least / reach)
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        met = np.zeros(len(self.ids), np.int8)
        for f in focus:
            q = float(unit[f])
            spread = np.sqrt(max(0.0, (1 - q * q) * (1 - cos * cos)))
            low = -1.0 if -q > cos else q * cos - spread
            high = 1.0 if q > cos else q * cos + spread
            a, b = np.searchsorted(self.lists[f], (low - SLACK, high + SLACK))
            met[self.order[f, a:b]] += 1
        return np.flatnonzero(met == len(focus))

    def verified(self, q: np.ndarray, unit: np.ndarray, norm: float, least: float, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the wanted rows (a mask) that score ``least`` or more."""
        x, q = self.exact(q)
        rows = self.candidates(unit, norm, least)
        if rows is None or 4 * len(rows) > len(wanted):  # reading all in order is faster than picking many
            rows = np.flatnonzero(wanted) if rows is None else rows[wanted[rows]]
            scores = (x @ q)[rows]
        else:
            rows = rows[wanted[rows]]
            scores = x[rows] @ q
        keep = scores >= least
        return self.ids[rows[keep]], scores[keep]


class _Anchors:
    def __init__(self, k: int, keys: np.ndarray, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, given: list):
        self.k, self.keys, self.ids, self.labels, self.x, self.given = k, keys, ids, labels, x, given
        self.norms = np.sqrt((x * x).sum(axis=1))
        self.units = x / np.where(self.norms > 0, self.norms, 1)[:, None]
        none = (np.empty(0, np.int64), np.empty(0))
        self.best = [[none] * self.lists(g) for g in given]

    def lists(self, given: list | None) -> int:
        return 1

    def block(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
        bucket = LengthBucket(ids, labels, x)
        for n in range(len(self.ids)):
            self.meet(bucket, n)


class Positives(_Anchors):
    """given: the first bound, if there is one."""

    def meet(self, bucket: LengthBucket, n: int) -> None:
        ids, scores = self.best[n][0]
        least = self.given[n][0] if self.given[n] else -np.inf
        if len(scores) == self.k:
            least = max(least, scores[-1])
        wanted = (bucket.labels == self.labels[n]) & (bucket.ids != self.ids[n])
        self.best[n][0] = merged(ids, scores, *bucket.verified(self.x[n], self.units[n], self.norms[n], least, wanted), self.k)

    def found(self) -> list[tuple]:
        return [(int(key), int(own), int(i), int(s)) for key, own, lists in zip(self.keys, self.ids, self.best) for i, s in zip(*lists[0])]


class Negatives(_Anchors):
    """given: the id and score of each positive, one after the other."""

    def __init__(self, k: int, low: int, *rest):
        self.low = low
        super().__init__(k, *rest)

    def lists(self, given: list | None) -> int:
        return len(given) // 2

    def meet(self, bucket: LengthBucket, n: int) -> None:
        windows = [(-(-self.low * s // 100), s) for s in self.given[n][1::2]]
        needs = [max(low, int(scores[-1]) if len(scores) == self.k else low) for (low, _), (_, scores) in zip(windows, self.best[n])]
        open_ = [i for i, (low, high) in enumerate(windows) if low <= high]
        if not open_:
            return
        ids, scores = bucket.verified(self.x[n], self.units[n], self.norms[n], min(needs[i] for i in open_), bucket.labels != self.labels[n])
        for i in open_:
            fit = (scores >= needs[i]) & (scores <= windows[i][1])
            if fit.any():
                self.best[n][i] = merged(*self.best[n][i], ids[fit], scores[fit], self.k)

    def found(self) -> list[tuple]:
        return [
            (int(key), int(own), i, int(self.given[n][2 * i]), int(self.given[n][2 * i + 1]), int(j), int(s))
            for n, (key, own) in enumerate(zip(self.keys, self.ids)) for i, best in enumerate(self.best[n]) for j, s in zip(*best)
        ]


def _best(found: DataFrame, k: int, *by: str) -> DataFrame:
    """The partial results of all cells, at most k of each, merged: adds rank."""
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "row_id"))).where(F.col("rank") <= k)


def hard_negatives(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", positives: int = 5, negatives: int = 5, low: int = 80, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score for the rows where ``is_anchor`` holds; negatives score from ``low`` hundredths of the positive's score up to it."""
    rows = prepared(df.where(F.col(label_col).isNotNull()), F.col(id_col), F.col(vector_col), F.col(label_col), is_anchor, scale)
    queries, dealt, groups, chunks = grid(rows)
    fields = "key long, own long, row_id long, score long"
    none = queries.withColumn("given", F.array().cast("array<long>"))
    k = positives
    search = lambda *q: Positives(k, *q)
    first = stored(searched(none, dealt, groups, range(1), search, fields, ["key", "own", "row_id", "score"]))
    if chunks > 1:
        bounds = first.groupBy("key").agg(F.when(F.count("*") >= k, F.array(F.min("score"))).alias("given"))
        begun = queries.join(bounds, "key", "left")
        first = stored(first.unionAll(searched(begun, dealt, groups, range(1, chunks), search, fields, ["key", "own", "row_id", "score"])))
    best = _best(first, k, "key").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("rank", "row_id", "score"))).alias("p"))
    asked = stored(queries.join(best.select("key", F.flatten(F.transform("p", lambda r: F.array(r["row_id"], r["score"]))).alias("given")), "key"))
    fields = "key long, own long, place int, positive_id long, positive_score long, row_id long, score long"
    found = searched(asked, dealt, groups, range(chunks), lambda *q: Negatives(negatives, low, *q), fields, ["key", "own", "place", "positive_id", "positive_score", "row_id", "score"])
    out = _best(found, negatives, "key", "place")
    return out.select(F.col("own").alias("anchor_id"), "positive_id", "rank", F.col("row_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(moved, F.col("vec_id") % 100 == 0)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor, b.vec_id AS other, a.label = b.label AS alike, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor, other AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) AS n FROM s WHERE alike) WHERE n <= 5),
m AS (
  SELECT p.*, s.other, s.score, row_number() OVER (PARTITION BY p.anchor, positive_id ORDER BY s.score DESC, s.other) AS n
  FROM p JOIN s ON s.anchor = p.anchor AND NOT s.alike AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor AS anchor_id, positive_id, CAST(n AS INTEGER) AS rank, other AS negative_id, positive_score, score AS negative_score FROM m WHERE n <= 5
"""
