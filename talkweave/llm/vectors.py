"""Searches of a stated set of queries against all rows of a table of vectors, as a grid of tasks.

Rows are dealt into chunks and queries into groups, each of about equal numbers, and written once. A cell of the grid is one group and one chunk; a shuffle
brings its queries and rows into one task, where the queries come first and stay (``QUERY_BYTES`` of them, about), and the rows come by
after them in blocks. So nothing goes through the driver, the plan has the same size for any number of queries, and a task holds a group of queries and
a block of rows. A search over the first chunk gives each query a first bound, with which all other cells start.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkweave.llm.common import bounded_batches, stored

QUERY_BYTES = 64 << 20
CHUNK_BYTES = 512 << 20
BLOCK_ROWS = 8192
#: Partitions of a grid at most; beyond, a partition has several cells.
MOST_PARTITIONS = 20_000


def quantised(column: pa.Array, ids: pa.Array, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, floor(scale * x)) of the rows that take part, by length of vector."""
    flat = column.flatten()
    starts = np.concatenate(([0], np.cumsum(np.where(column.is_null().to_numpy(zero_copy_only=False), 0, column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))))).astype(np.int64)
    x = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(x))))
    size = np.diff(starts)
    good = (size > 0) & (bad[starts[1:]] == bad[starts[:-1]]) & ~ids.is_null().to_numpy(zero_copy_only=False)
    for d in np.unique(size[good]):
        rows = np.flatnonzero(good & (size == d))
        yield rows, np.floor(scale * x[starts[rows][:, None] + np.arange(d)])


def prepared(df: DataFrame, id_col: Column, vector: Column, label: Column, asked: Column, scale: int) -> DataFrame:
    """id, label, asked, d (length of the vector), norm and x (the components floor(scale * x), as bytes of doubles) of the rows that take part: those with
    an id and a vector of finite components."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, x in quantised(b.column(1), b.column(0), scale):
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(at), b.column(2).take(at), b.column(3).take(at), pa.array([x.shape[1]] * len(rows), pa.int32()), pa.array(np.sqrt((x * x).sum(axis=1))), pa.array([r.tobytes() for r in x], pa.binary())],
                    ["id", "label", "asked", "d", "norm", "x"],
                )

    rows = df.select(id_col.cast("long").alias("id"), vector.cast("array<double>").alias("x"), label.cast("long").alias("label"), F.coalesce(asked, F.lit(False)).alias("asked"))
    return rows.mapInArrow(run, "id long, label long, asked boolean, d int, norm double, x binary")


def grid(rows: DataFrame) -> tuple[DataFrame, DataFrame, int, int]:
    """Stored rows (with chunk) and queries (with group, and key, a number of their own), and the numbers of groups and chunks."""
    spark = rows.sparkSession
    rows = stored(rows)
    size = F.coalesce(F.sum(F.octet_length("x")), F.lit(0))
    n = rows.agg(F.count("*").alias("rows"), size.alias("bytes"), F.coalesce(F.sum(F.when(F.col("asked"), F.octet_length("x"))), F.lit(0)).alias("asked")).first()
    groups = max(1, -(-n["asked"] // QUERY_BYTES))
    chunks = max(1, -(-n["bytes"] // CHUNK_BYTES), min(spark.sparkContext.defaultParallelism, -(-n["rows"] // BLOCK_ROWS)))
    # dealt in turn, not by a key, so equal rows spread too
    dealt = stored(rows.select("id", "label", "d", "norm", "x").repartition(chunks).withColumn("chunk", F.spark_partition_id()))
    queries = stored(rows.where("asked").select("id", "label", "d", "x").repartition(groups).withColumn("group", F.spark_partition_id()).withColumn("key", F.monotonically_increasing_id()))
    return queries, dealt, groups, chunks


class Search(Protocol):
    """What a cell does: made from its queries of one length of vector, it sees blocks of rows and gives its finds at the end."""

    def block(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None: ...

    def found(self) -> list[tuple]: ...


def searched(queries: DataFrame, rows: DataFrame, groups: int, chunks: range, make: Callable[..., Search], schema: str, names: list[str]) -> DataFrame:
    """queries: key, id, label, d, x, group, given (array<long>). The finds of all cells of the groups and ``chunks``; ``make`` gets keys, ids, labels, vectors and
    what is given of a cell's queries. Rows come to a search by falling norm."""
    first, last = chunks.start, chunks.stop - 1
    asked = queries.select("group", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("chunk"), F.lit(0).alias("kind"), "d", F.lit(0.0).alias("norm"), "key", "id", "label", "x", "given")
    met = rows.where(F.col("chunk").between(first, last)).select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), "chunk", F.lit(1).alias("kind"), "d", "norm", F.lit(0).cast("long").alias("key"), "id", "label", "x", F.lit(None).cast("array<long>").alias("given")
    )
    cells = groups * len(chunks)
    cell = F.col("group") * len(chunks) + F.col("chunk") - first
    n = min(cells, MOST_PARTITIONS)
    both = asked.unionAll(met).repartitionById(n, F.pmod(cell, F.lit(n)).cast("int")).sortWithinPartitions("group", "chunk", "kind", "d", F.desc("norm"), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = None
        waiting: dict[int, list] = {}
        searches: dict[int, Search] = {}
        block: list[pa.RecordBatch] = []
        types = [f.type for f in pa_schema]

        def arrays(parts: list[pa.RecordBatch], d: int):
            t = pa.Table.from_batches(parts)
            x = np.frombuffer(b"".join(t["x"].to_pylist()), np.float64).reshape(-1, d)
            return t, t["id"].to_numpy(), t["label"].fill_null(0).to_numpy(), x

        def flush():
            nonlocal block
            if block:
                d = block[0]["d"][0].as_py()
                if d in waiting:
                    t, ids, labels, x = arrays(waiting.pop(d), d)
                    searches[d] = make(t["key"].to_numpy(), ids, labels, x, t["given"].to_pylist())
                if d in searches:
                    _, ids, labels, x = arrays(block, d)
                    searches[d].block(ids, labels, x)
            block = []

        def finds():
            flush()
            for s in searches.values():
                out = s.found()
                for at in range(0, len(out), 10_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[at : at + 10_000]), types)], names)
            waiting.clear()
            searches.clear()

        for b in batches:
            # runs of one cell, kind and length of vector
            marks = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(4)], axis=1)
            cuts = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1).tolist(), len(marks)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if lo == hi:
                    continue
                group, chunk, kind, d = marks[lo].tolist()
                if (group, chunk) != here:
                    yield from finds()
                    here = (group, chunk)
                part = b.slice(lo, hi - lo)
                if kind == 0:
                    waiting.setdefault(d, []).append(part)
                    continue
                if block and block[0]["d"][0].as_py() != d:
                    flush()
                block.append(part)
                if sum(p.num_rows for p in block) >= BLOCK_ROWS:
                    flush()
        yield from finds()

    pa_schema = [pa.field(n, {"long": pa.int64(), "int": pa.int32()}[k]) for n, k in (c.split() for c in schema.split(", "))]
    return both.mapInArrow(run, schema)


class Scores:
    """Exact inner products with a block's rows: in doubles where all sums stay below 2^53, in 64-bit integers beyond."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.largest = float(np.abs(x).max()) * x.shape[1] if x.size else 0.0
        self.whole: np.ndarray | None = None

    def exact(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and query in the type that keeps scores exact."""
        most = self.largest * float(np.abs(q).max())
        if most < 2.0**53:
            return self.x, q
        if most >= 2.0**63:
            raise OverflowError("scores of these vectors may need more than 64 bits")
        if self.whole is None:
            self.whole = self.x.astype(np.int64)
        return self.whole, q.astype(np.int64)


def merged(ids: np.ndarray, scores: np.ndarray, new_ids: np.ndarray, new_scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The best k of both, larger scores first, ties by smaller id."""
    ids, scores = np.concatenate((ids, new_ids)), np.concatenate((scores.astype(new_scores.dtype), new_scores))
    best = np.lexsort((ids, -scores))[:k]
    return ids[best], scores[best]
