"""Drops lines that many documents share, all but one copy of each.

A line is known by its key: without ASCII white space at both ends, A-Z in lower case. Lines are exploded, their keys hashed (128 bits), and the
documents that hold a hash counted; a hash that enough documents hold loses all its lines but those of the document with the largest id. The
places to drop are joined to the hash, gathered by document, and the document is put together again by position.

What scales how: hashes are counted by (hash, id) first, so a line that a third of all documents hold is spread and then summed up in parts. When
lines meet the shared hashes, the hot ones (more than one line in HOT_SHARE, so at most HOT_SHARE of them) are broadcast; all
others meet by a shuffle, where no hash has more than that share of the lines. The lines' hashes are written once and read twice. Only hashes and positions are shuffled; whole texts once, in the last join.

Results for edge cases: a null or empty text is one empty line. Documents are told apart by id: rows that repeat an id count as one, rows without an
id (null) as one together, which any other holder precedes. Rows that repeat an id with different texts each keep the lines that the id may keep.
Ties don't arise, since the largest id is one document. An empty table gives an empty one. Other columns, whatever their names, pass unchanged; a text
is processed whole, however long.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.llm.common import bounded_batches, free_names, row_hash, stored, table

SPACE = " \t\n\x0b\x0c\r"
#: A hash with more than one in so many of the lines in question is hot.
HOT_SHARE = 1000
HOT_LEAST = 10_000


def _lowered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A-Z of the last column in lower case, other letters as they are, for which Spark has only the slow translate()."""
    for b in batches:
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pc.ascii_lower(b.columns[-1])], b.schema.names)


def line_rows(rows: DataFrame, min_chars: int) -> DataFrame:
    """rows: id, text. One row for each line whose key is long enough: id, r1, r2 (the row's hash), pos, h1, h2 (the key's)."""
    bounded_batches(rows.sparkSession)
    hashed = rows.select("id", *row_hash(F.col("id"), F.col("text")), "text")
    lines = hashed.mapInArrow(_lowered, hashed.schema).select("id", "r1", "r2", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    keyed = lines.withColumn("key", F.btrim("line", F.lit(SPACE))).where(F.length("key") >= min_chars)
    return keyed.select("id", "r1", "r2", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"))


def shared_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """h1, h2, keeper (the largest id) and n_lines of the hashes that at least so many documents hold."""
    counted = lines.groupBy("h1", "h2").agg(F.countDistinct("id").alias("ids"), F.max(F.col("id").isNull().cast("int")).alias("without"), F.max("id").alias("keeper"), F.count("*").alias("n_lines"))
    return counted.where(F.col("ids") + F.col("without") >= min_docs).select("h1", "h2", "keeper", "n_lines")


def dropped_places(lines: DataFrame, shared: DataFrame) -> DataFrame:
    """r1, r2 and the positions that the row loses."""
    total = shared.agg(F.sum("n_lines").alias("n")).first()["n"] or 0
    hot = F.col("n_lines") > max(HOT_LEAST, total // HOT_SHARE)
    few = F.broadcast(shared.where(hot).select("h1", "h2", "keeper"))  # at most HOT_SHARE rows
    rest = lines.join(F.broadcast(shared.where(hot).select("h1", "h2")), ["h1", "h2"], "left_anti")
    met = lines.join(few, ["h1", "h2"]).unionByName(rest.join(shared.where(~hot).select("h1", "h2", "keeper"), ["h1", "h2"]))
    return met.where(~F.col("id").eqNullSafe(F.col("keeper"))).groupBy("r1", "r2").agg(F.collect_set("pos").alias("drops"))


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5, n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """df without the shared lines in ``text_col``, and with the number of lines before and of lines dropped."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = stored(line_rows(df.select(F.col(id_col).alias("id"), text.alias("text")), min_chars))
    shared = stored(shared_lines(lines, min_docs))
    r1, r2, parts, drops = free_names(df, "r1", "r2", "lines", "drops")
    lost = dropped_places(lines, shared).select(F.col("r1").alias(r1), F.col("r2").alias(r2), F.col("drops").alias(drops))
    h1, h2 = row_hash(F.col(id_col), text)
    # split before the join: behind it the lines are a column, and not split again for each line that is looked up
    whole = df.withColumns({r1: h1, r2: h2, parts: F.split(text, "\n")}).drop(text_col)
    both = whole.join(lost, [r1, r2], "left")
    n = F.size(parts)
    kept = F.array_except(F.sequence(F.lit(0), n - 1), F.coalesce(F.col(drops), F.array().cast("array<int>")))
    joined = F.when(F.col(drops).isNull(), F.array_join(parts, "\n")).otherwise(F.array_join(F.transform(kept, lambda i: F.get(parts, i)), "\n"))
    done = both.withColumns({text_col: joined, n_lines: n.cast("long"), n_dropped: F.coalesce(F.size(drops), F.lit(0)).cast("long")})
    return done.select(*df.columns, *(c for c in (n_lines, n_dropped) if c not in df.columns))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE_SQL = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
k AS (SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM l),
s AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.keeper AS lost FROM k LEFT JOIN s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(lost AS BIGINT)) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
