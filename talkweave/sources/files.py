"""Files in and out. Paths go through Spark's readers and writers only, so any store that Spark reads will do."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkweave import schemas
from talkweave.functions.text import beside, safe_split
from talkweave.sources.audio import wav_layout
from talkweave.storage import removed


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def qualified(spark: SparkSession, path: str) -> str:
    """The folder with its file system, for tasks that read and write single files in it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return re.sub("^file:/+", "file:///", p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()).rstrip("/")


def put(root: str, path: str, content: bytes) -> None:
    """Writes one file below a qualified folder; it gets its name when complete."""
    store, base = fs.FileSystem.from_uri(root)
    folder, name = f"{base}/{path}".rsplit("/", 1)
    store.create_dir(folder, recursive=True)
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as f:
        f.write(content)
    store.move(draft, f"{folder}/{name}")


class Draft:
    """One file below a qualified folder, written bit by bit; it gets its name when finished."""

    def __init__(self, root: str, path: str):
        self.store, base = fs.FileSystem.from_uri(root)
        folder, name = f"{base}/{path}".rsplit("/", 1)
        self.store.create_dir(folder, recursive=True)
        self.draft, self.path = f"{folder}/.{name}.{uuid.uuid4().hex}", f"{folder}/{name}"
        self.out = self.store.open_output_stream(self.draft)

    def write(self, content: bytes) -> None:
        self.out.write(content)

    def finish(self) -> None:
        self.out.close()
        self.store.move(self.draft, self.path)


def get(root: str, path: str) -> bytes:
    store, base = fs.FileSystem.from_uri(root)
    with store.open_input_stream(f"{base}/{path}") as f:
        return f.read()


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """path, line (from 1, of the file) and value of every line of all text files at the path, however large.

    Files are read in byte ranges, which know where they start but not at which line. Row numbers within a task count a range's lines in place; the ranges' line counts, a row
    each, are summed up in their order within the file and give each range its first line. Lines themselves aren't sorted, nor shuffled where the ranges are few."""
    at = F.col("_metadata")
    raw = spark.read.text(path, recursiveFileLookup=True).select(at["file_path"].alias("path"), at["file_block_start"].alias("start"), F.monotonically_increasing_id().alias("n"), "value")
    ranges = raw.groupBy("path", "start").agg(F.min("n").alias("first"), F.count("*").alias("lines"))
    before = F.sum("lines").over(Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    offsets = ranges.select("path", "start", (F.coalesce(before, F.lit(0)) - F.col("first") + 1).alias("shift"))
    return raw.join(offsets, ["path", "start"]).select(F.regexp_replace("path", "^file:/+", "/").alias("path"), (F.col("n") + F.col("shift")).alias("line"), "value")


def read_json(spark: SparkSession, path: str, schema: T.StructType, whole: bool = False) -> DataFrame:
    """Typed JSON lines (or one document per file if ``whole``); nothing at the path is an empty table. A malformed
    record stops the read; see bad_records() for where."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", whole).option("recursiveFileLookup", True).json(path)


def _parsed(text: Column, schema: T.StructType) -> Column:
    """The record as a struct, with _corrupt_record where it doesn't fit the schema."""
    wide = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return F.from_json(text, wide, {"mode": "PERMISSIVE"})


def lacking(record: Column, needed: tuple[str, ...]) -> Column:
    """Why a parsed record is none: its text doesn't fit, or a field is missing; else null."""
    missing = F.array_compact(F.array(*(F.when(record[c].isNull(), c) for c in needed)))
    return F.when(record.isNull() | record["_corrupt_record"].isNotNull(), "not of the schema").when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ", ")))


def json_lines(spark: SparkSession, path: str, schema: T.StructType, needed: tuple[str, ...] = ()) -> DataFrame:
    """The schema's columns, path, line and error of every line that isn't blank: records that don't fit are rows, too."""
    if not exists(spark, path):
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("path", T.StringType()), T.StructField("line", T.LongType()), T.StructField("error", T.StringType())]))
    lines = numbered_lines(spark, path).where(F.trim("value") != "").withColumn("r", _parsed(F.col("value"), schema))
    return lines.select(*(F.col(f"r.{c}").alias(c) for c in schema.names), "path", "line", lacking(F.col("r"), needed).alias("error"))


def bad_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """path, line and text of the records that don't fit the schema."""
    lines = numbered_lines(spark, path).where(F.trim("value") != "").withColumnRenamed("value", "record")
    return lines.where(lacking(_parsed(F.col("record"), schema), ()).isNotNull())


def read_scripts(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, schemas.SCRIPT)


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, schemas.SEQUENCE)


def stage_files(spark: SparkSession, path: str) -> DataFrame:
    """Every conversations/<id>.json of a stage folder, a document each and indented or not: the conversation's columns, path and error (null where the metadata holds)."""
    where = f"{path.rstrip('/')}/conversations"
    if not exists(spark, where):
        return spark.createDataFrame([], T.StructType([*schemas.CONVERSATION.fields, T.StructField("path", T.StringType()), T.StructField("error", T.StringType())]))
    raw = spark.read.text(where, wholetext=True, pathGlobFilter="*.json").select("value", F.regexp_replace("_metadata.file_path", "^file:/+", "/").alias("path"))
    parsed = raw.withColumn("r", _parsed(F.col("value"), schemas.CONVERSATION))
    given = {"language": F.coalesce("r.language", F.lit("en")), "overlaps": F.coalesce("r.overlaps", F.array().cast(schemas.CONVERSATION["overlaps"].dataType))}
    fields = [given.get(c, F.col(f"r.{c}")).alias(c) for c in schemas.CONVERSATION.names]
    out = parsed.select(*fields, "path", lacking(F.col("r"), ("conversation_id", "category", "duration_sec", "turns")).alias("error"))
    # readers pass over empty files
    empty = _empty_files(spark, where).where("path LIKE '%.json'").select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.CONVERSATION), "path", F.lit("empty file").alias("error"))
    return out.unionAll(empty)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """The conversations of a stage folder, with the file's path; a file that holds none stops the read and is named. See stage_files() for those as rows."""
    wrong = F.raise_error(F.concat(F.lit("invalid metadata in "), "path", F.lit(": "), "error")).cast("boolean")
    # a condition, so that it is looked at before all others
    return stage_files(spark, path).where(F.when(F.col("error").isNull(), F.lit(True)).otherwise(wrong)).drop("error")


def read_prompts(spark: SparkSession, path: str) -> DataFrame:
    """Voice prompt pairs from all meta.json below a folder, in the order of their paths, with WAV paths resolved."""
    raw = spark.read.schema(schemas.PROMPT).option("recursiveFileLookup", True).option("pathGlobFilter", "meta.json").option("multiLine", True).json(path)
    at = F.col("_metadata.file_path")
    return raw.select(F.regexp_replace(at, "^file:/+", "/").alias("path"), "s1_prompt_transcription", "s2_prompt_transcription", *(beside(at, F.col(c)).alias(c) for c in ("s1_prompt_wav", "s2_prompt_wav")))


def _empty_files(spark: SparkSession, path: str) -> DataFrame:
    """path and length of the files below a folder that have no bytes, which Spark's readers pass over: a listing by one task."""
    place = qualified(spark, path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = fs.FileSystem.from_uri(place)
        for _ in batches:
            info = store.get_file_info(fs.FileSelector(base, recursive=True)) if store.get_file_info(base).type == fs.FileType.Directory else [store.get_file_info(base)]
            names = [x.path for x in info if x.type == fs.FileType.File and not x.size and not x.base_name.startswith((".", "_"))]
            yield pd.DataFrame({"path": pd.Series(names, dtype=str), "length": 0})

    return spark.range(0, 1, 1, 1).mapInPandas(run, "path string, length bigint")


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """path and length of all files below a folder; contents aren't read."""
    if not exists(spark, path):
        return spark.createDataFrame([], "path string, length bigint")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "length")
    return found.unionAll(_empty_files(spark, path))


def stage_audio(spark: SparkSession, path: str) -> DataFrame:
    """path (below the stage's folder, as in the records) and seconds (null where the file is no WAV) of the WAV files in the stage's audio folder; no rows without such a folder. Files are listed
    without their contents; a task then reads the chunk headers of each, not its samples."""
    kind = "path string, seconds double"
    if not exists(spark, where := f"{path.rstrip('/')}/audio"):
        return spark.createDataFrame([], kind)
    place = qualified(spark, path)
    root = re.sub("^file:/+", "/", place)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.wav").load(where)
    listed = found.select(F.expr(f"substring(regexp_replace(path, '^file:/+', '/'), {len(root) + 2})").alias("path"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = fs.FileSystem.from_uri(place)
        for pdf in batches:
            yield pdf.assign(seconds=[_seconds(store, f"{base}/{p}") for p in pdf["path"]])

    return listed.mapInPandas(run, kind)


def _seconds(store: fs.FileSystem, path: str) -> float | None:
    with store.open_input_file(path) as f:
        try:
            head = wav_layout(f)
        except ValueError:
            return None
        return head.frames / head.rate


def read_splits(spark: SparkSession, path: str, splits: list[str] | str = "all") -> DataFrame:
    """Codec rows of the splits of a corpus, which are folders or shards named by split, with source_split."""
    if splits == "all":
        return spark.read.schema(schemas.CODEC_ROW).parquet(path)
    known = [r["source_split"] for r in spark.read.schema(schemas.CODEC_ROW).parquet(path).select("source_split").distinct().collect()]
    if missing := sorted(set(splits) - set(known)):
        raise ValueError(f"unknown splits: {', '.join(missing)}")
    return spark.read.schema(schemas.CODEC_ROW).parquet(path).where(F.col("source_split").isin(*splits))


def write_json(spark: SparkSession, path: str, payload: dict) -> None:
    """One small document, indented, other letters as they are: a report or a plan."""
    folder, name = path.rsplit("/", 1)
    put(qualified(spark, folder), name, json.dumps(payload, indent=2, ensure_ascii=False).encode())


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Gives a finished folder its name, in one step; an error where the name is taken."""
    a, b = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (staged, path))
    store = b.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(b.getParent())
    if store.exists(b) or not store.rename(a, b):
        raise FileExistsError(f"can't publish {staged} as {path}")


def rounds(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the rounds published below a path."""
    if not exists(spark, path):
        return []
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [f.getPath().getName() for f in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)]
    return sorted(int(n[6:]) for n in names if n.startswith("round=") and n[6:].isdigit())


def append_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_by_bucket(scripts: DataFrame, buckets: list[str], path: str) -> None:
    """Rewrites one folder of JSON lines per bucket; a bucket without scripts gets an empty one."""
    scripts.withColumn("bucket", F.col("category")).write.mode("overwrite").partitionBy("bucket").json(path)
    for b in buckets:
        if not exists(scripts.sparkSession, f"{path}/bucket={b}"):
            scripts.limit(0).write.mode("overwrite").json(f"{path}/bucket={b}")


def write_stage(conversations: DataFrame, path: str) -> None:
    """conversations/<id>.json for each, indented; files of a run before are deleted first. Tasks write their own conversations' files, and one that runs again writes the same."""
    spark = conversations.sparkSession
    removed(spark, f"{path.rstrip('/')}/conversations")
    place = qualified(spark, path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i, text in zip(pdf["conversation_id"], pdf["text"]):
                if not i or "/" in i or i in (".", ".."):
                    raise ValueError(f"conversation_id {i!r} is no file name")
                put(place, f"conversations/{i}.json", json.dumps(json.loads(text), indent=2, ensure_ascii=False).encode())
            yield pdf[["conversation_id"]].iloc[:0]

    whole = F.to_json(F.struct(*conversations.columns), {"ignoreNullFields": "false"})
    conversations.select("conversation_id", whole.alias("text")).mapInPandas(run, "conversation_id string").write.format("noop").mode("overwrite").save()


def write_audio(rows: DataFrame, path: str, name: str = "name") -> DataFrame:
    """Writes ``audio`` (WAV bytes) of each row to a file of its name below the path; gives name and bytes. Evaluating it writes the files."""
    place = qualified(rows.sparkSession, path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for n, content in zip(pdf["name"], pdf["audio"]):
                put(place, n, bytes(content))
            yield pd.DataFrame({"name": pdf["name"], "bytes": [len(c) for c in pdf["audio"]]})

    return rows.select(F.col(name).alias("name"), "audio").where("audio IS NOT NULL").mapInPandas(run, "name string, bytes bigint")


def write_tsv(df: DataFrame, path: str) -> None:
    """Tabs, no header, quotes only where needed."""
    df.write.mode("overwrite").option("sep", "\t").option("escape", '"').option("emptyValue", "").option("nullValue", "").csv(path)


def write_shards(rows: DataFrame, path: str, size: int = 500) -> None:
    """Parquet shards of at most ``size`` rows, by split."""
    rows.withColumn("split", safe_split(F.col("source_split"))).write.mode("overwrite").option("maxRecordsPerFile", size).partitionBy("split").parquet(path)


def write_numbered_shards(rows: DataFrame, path: str, split: str, *order: str, size: int = 500, offset: int = 0) -> None:
    """Parquet shards of ``size`` rows in order (the last of a split may be smaller), in folders by split and running number: one task writes a shard."""
    from talkweave.operators.corpus import sharded

    named = sharded(rows, split, *order, size=size, offset=offset).drop("idx").withColumn("split", safe_split(F.col(split)))
    named.repartition("split", "shard").write.mode("append" if offset else "overwrite").partitionBy("split", "shard").parquet(path)


def upload_plan(files: DataFrame, repo: str, subset: str) -> DataFrame:
    """repo_id, subset, file_count and total_bytes of an inventory."""
    return files.agg(F.count("*").alias("file_count"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes")).select(F.lit(repo).alias("repo_id"), F.lit(subset).alias("subset"), "file_count", "total_bytes")
