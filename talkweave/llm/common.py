"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.storage import removed, shared_dir, stored  # noqa: F401

#: Rows and bytes that one Arrow batch handed to Python may hold; this bounds a worker's memory when texts are long.
BATCH_ROWS = 512
BATCH_BYTES = 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Keeps the Arrow batches of this session small, since a single text can have megabytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_hash(*of: Column) -> tuple[Column, Column]:
    """128 bits that tell rows apart, as two independent columns."""
    return F.xxhash64(*of).alias("r1"), F.xxhash64(F.lit(1), *of).alias("r2")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names for columns of our own that no column of df has, whatever their case."""
    taken = {c.lower() for c in df.columns}
    mark = "__"
    while any(f"{mark}{n}".lower() in taken for n in names):
        mark += "_"
    return [f"{mark}{n}" for n in names]


def shards(df: DataFrame, text_col: str, shard_bytes: int) -> int:
    """How many shards of about ``shard_bytes`` of text the table fills, 1 at least."""
    total = df.select(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0
    return max(1, -(-int(total) // shard_bytes))


def with_column(df: DataFrame, name: str, kind: str, arrow_type: pa.DataType, of: tuple[str, ...], compute: Callable[..., list]) -> DataFrame:
    """Adds or replaces a column by what ``compute`` makes of lists of the columns ``of``; all other columns pass unchanged."""
    bounded_batches(df.sparkSession)
    ready = df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))
    at, inputs = ready.columns.index(name), [ready.columns.index(c) for c in of]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = list(b.columns)
            columns[at] = pa.array(compute(*(b.column(i).to_pylist() for i in inputs)), arrow_type)
            yield pa.RecordBatch.from_arrays(columns, b.schema.names)

    return ready.mapInArrow(run, ready.schema)
