"""Packing token sequences by the sum-of-squares rule.

Every document is tokenised, gets an end id, and its ids are placed into sequences (windows) of ``capacity`` ids. Whole
windows are cut off first; the rest, shorter than a window, goes online into the fill level that minimises
the sum of the squared numbers of windows at each level. A level array holds these numbers, so a placement is one
vectorised minimum over the levels. At the end of a shard, the few windows that are still open are closed by
cutting the emptiest ones' pieces into the gaps of the fullest, so a shard ends with one padded window at most.

Shards are partitions of about ``shard_bytes`` of text, so their number follows the input. Rows are dealt to them in turn, so a hot source, or a row that repeats a million times,
is spread. A sequence id holds the shard's number and the window's number in it. Rows of a shard are
sorted, so a task that runs again gives the same pieces.

Results for edge cases: a null text counts as empty and is one end id; a null or repeated id is a row like any other, and rows that repeat are packed each, which of them where being
without meaning; a text of any length is read whole and cut into windows, which one task does; of levels that are as good as each other (ties) the fullest
is taken; columns beyond id and text, whatever their names, are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.llm.bpe import packed_encoder, read_tokenizer, tokenizer_path
from talkweave.llm.common import bounded_batches, shards, table

CAPACITY = 4096
END_ID = 2
SHARD_BYTES = 16 << 20


class LevelPacker:
    """Open windows by fill level; place() tells the window and offset of a piece."""

    def __init__(self, capacity: int = CAPACITY):
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, np.int64)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.windows = 0

    def place(self, size: int) -> tuple[int, int]:
        """For a size from 1 to capacity. Ties go to the fullest level."""
        c, cap = self.count, self.capacity
        if size == cap:
            self.windows += 1
            return self.windows - 1, 0
        # change of the sum of squares for each level h that has a window, when one moves to h + size
        n = cap - size + 1
        change = 2 * (c[size : size + n] - c[:n]) + 2
        change[n - 1] = 1 - 2 * c[cap - size]  # a full window is no longer counted
        change[c[:n] == 0] = np.iinfo(np.int64).max
        change[0] = 2 * c[size] + 1  # a new window
        level = int(n - 1 - np.argmin(change[::-1]))
        if level:
            window = self.open[level].pop()
            c[level] -= 1
        else:
            window = self.windows
            self.windows += 1
        if level + size < cap:
            c[level + size] += 1
            self.open[level + size].append(window)
        return window, level

    def levels(self) -> list[tuple[int, int]]:
        """(window, level) of the open windows, the fullest first."""
        return [(w, h) for h in range(self.capacity, 0, -1) for w in self.open[h]]


def pack_shard(docs: Iterator[tuple[object, bytes]], capacity: int = CAPACITY) -> Iterator[tuple]:
    """docs: key and packed 32-bit ids. Gives (key, start, length, crc32 of ids, ids of the document, window, offset)."""
    packer = LevelPacker(capacity)
    waiting: dict[int, list[tuple]] = {}  # pieces of open windows: (key, start, ids, ids of the document)
    filled: dict[int, int] = {}

    def closed(window: int, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for key, start, ids, total in pieces:
            n = len(ids) // 4
            yield key, start, n, zlib.crc32(ids), total, window, offset
            offset += n

    for key, ids in docs:
        total = len(ids) // 4
        for start in range(0, total, capacity):
            piece = ids[4 * start : 4 * (start + capacity)]
            n = len(piece) // 4
            window, offset = packer.place(n)
            waiting.setdefault(window, []).append((key, start, piece, total))
            if offset + n == capacity:
                yield from closed(window, waiting.pop(window))
    rest = packer.levels()
    filled = dict(rest)
    first, last = 0, len(rest) - 1
    while first < last:
        to, of = rest[first][0], rest[last][0]
        gap = capacity - filled[to]
        if not gap:
            yield from closed(to, waiting.pop(to))
            first += 1
            continue
        key, start, ids, total = waiting[of].pop()
        n = min(gap, len(ids) // 4)
        waiting[to].append((key, start, ids[: 4 * n], total))
        filled[to] += n
        filled[of] -= n
        if 4 * n < len(ids):
            waiting[of].append((key, start + n, ids[4 * n :], total))
        if not waiting[of]:
            del waiting[of]
            last -= 1
    for window, pieces in waiting.items():
        yield from closed(window, pieces)


PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_documents(
    df: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """A row for each piece: the id, PIECES."""
    spark = df.sparkSession
    bounded_batches(spark)
    source = spark.sparkContext.broadcast(read_tokenizer(path or tokenizer_path()))
    docs = df.select(F.col(id_col).alias("key"), F.coalesce(text_col, F.lit("")).alias("words"))
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = packed_encoder(source.value)
        shard = TaskContext.get().partitionId() << 32

        def ids() -> Iterator[tuple[object, bytes]]:
            for b in batches:
                for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    yield key, enc.packed(text) + end

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            keys, *rest = zip(*rows)
            rest[4] = [shard | w for w in rest[4]]
            return pa.RecordBatch.from_arrays([pa.array(keys, kind), *(pa.array(x, pa.int64()) for x in rest)], ["id", *(c.split()[0] for c in PIECES.split(", "))])

        rows: list[tuple] = []
        for row in pack_shard(ids(), capacity):
            rows.append(row)
            if len(rows) == 8192:
                yield batch(rows)
                rows = []
        if rows:
            yield batch(rows)

    field = docs.schema["key"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(field)
    n = shards(docs, "words", shard_bytes)
    placed = docs.repartition(n).sortWithinPartitions("key", "words")
    return placed.mapInArrow(run, f"id {field.simpleString()}, {PIECES}").withColumnRenamed("id", id_col)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
