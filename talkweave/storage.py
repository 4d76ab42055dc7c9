"""Scratch tables in a folder that all machines share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A new path in the folder that all machines share: the session's ``spark.checkpoint.dir``. Where that is unset, a temporary folder
    will do on a local master, and then also takes checkpoints; elsewhere it is an error, since executors would not see it."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="spark-shared-")
        sc.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str | None = None, codec: str = "zstd") -> DataFrame:
    """Cuts the lineage by writing ``df`` to the shared folder (to ``path``, if it is to be removed later) and reading it back; a lost
    executor then costs only a new read."""
    path = path or shared_dir(df.sparkSession)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a scratch table that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
