"""Validation reports: a row per violation, and a summary row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkweave.operators.rules import judged_scripts


def duplicates(rows: DataFrame, id_col: str, *order: str) -> DataFrame:
    """Rows of an id after its first, in order."""
    return rows.withColumn("occurrence", F.row_number().over(Window.partitionBy(id_col).orderBy(*order))).where("occurrence > 1")


def script_violations(scripts: DataFrame, buckets: DataFrame) -> DataFrame:
    """conversation_id, error: duplicates and the first broken rule of each script."""
    extra = scripts.groupBy("conversation_id").agg(F.count("*").alias("n")).where("n > 1")
    twice = extra.select("conversation_id", F.explode(F.array_repeat(F.lit("duplicate conversation_id"), (F.col("n") - 1).cast("int"))).alias("error"))
    return twice.unionAll(judged_scripts(scripts, buckets).where("reason IS NOT NULL").select("conversation_id", F.col("reason").alias("error")))


def stage_violations(conversations: DataFrame, buckets: DataFrame, files: DataFrame | None = None, require_overlaps: bool = False) -> DataFrame:
    """Every violation in a stage's conversations. files: path and seconds of the audio that exists (null where it is no WAV), by paths as in the records; missing
    audio is found by anti joins. Without it audio isn't looked at. A conversation with an ``error`` (see stage_files) has only that, under its file's name."""
    every = conversations
    if "error" in conversations.columns:
        conversations = conversations.where("error IS NULL")
    b = F.broadcast(buckets.select(F.col("name").alias("b_name"), "duration_min_sec", "duration_max_sec"))
    rows = conversations.join(b, F.col("category") == F.col("b_name"), "left")
    bad = lambda cond, text: F.when(cond, text)
    turns = F.col("turns")
    late = F.transform(F.filter(F.sequence(F.lit(0), F.size(turns) - 1), lambda i: (i > 0) & (F.get(turns, i)["start_ms"] < F.get(turns, i - 1)["end_ms"])), lambda i: F.format_string("turn %d starts before previous turn ends", i))
    own = F.array(
        bad(F.col("b_name").isNull(), F.concat(F.lit("unknown category "), F.coalesce("category", F.lit("")))),
        bad(~F.col("duration_sec").between(F.col("duration_min_sec"), F.col("duration_max_sec")), F.format_string("duration %.2fs outside bucket %s", "duration_sec", "category")),
        bad(F.lit(require_overlaps) & (F.coalesce(F.size("overlaps"), F.lit(0)) <= 0), "missing overlaps"),
    )
    errors = F.concat(F.array_compact(own), F.when(F.lit(not require_overlaps) & (F.size(turns) > 1), late).otherwise(F.array().cast("array<string>")))
    out = rows.select("conversation_id", F.explode(errors).alias("error"))
    if "error" in conversations.columns:
        name = F.regexp_extract("path", "[^/]*$", 0)
        out = out.unionAll(every.where("error IS NOT NULL").select(name.alias("conversation_id"), F.concat(F.lit("invalid metadata: "), "error").alias("error")))
    if files is None:
        return out
    named = conversations.where("mixed_audio_path IS NOT NULL AND mixed_audio_path <> ''").select("conversation_id", "duration_sec", F.col("mixed_audio_path").alias("path"))
    gone = named.join(files, "path", "left_anti").select("conversation_id", F.concat(F.lit("missing mixed audio "), "path").alias("error"))
    off = named.join(files, "path").where(F.coalesce(F.abs(F.col("seconds") - F.col("duration_sec")) > 0.1, F.lit(True))).select("conversation_id", F.lit("metadata duration does not match WAV").alias("error"))
    spoken = conversations.select("conversation_id", F.explode("turns.audio_path").alias("path"))
    silent = spoken.join(files, "path", "left_anti").select("conversation_id", F.concat(F.lit("missing turn audio "), "path").alias("error"))
    return out.unionAll(gone).unionAll(off).unionAll(silent)


def sequence_faults(tokens: Column, mask: Column) -> Column:
    total = F.aggregate(mask, F.lit(0), lambda a, x: a + x)
    return F.array_compact(
        F.array(F.when(F.size(tokens) != F.size(mask), "tokens and loss_mask differ in length"), F.when(F.size(tokens) == 0, "empty token sequence"), F.when(total == 0, "loss mask has no trainable positions"))
    )


def sequence_violations(sequences: DataFrame) -> DataFrame:
    return sequences.select("conversation_id", F.explode(sequence_faults(F.col("tokens"), F.col("loss_mask"))).alias("error"))


def line_violations(lines: DataFrame) -> DataFrame:
    """Records that don't fit, by file and line, of what json_lines gives."""
    return lines.where("error IS NOT NULL").select(F.concat_ws(":", "path", "line").alias("conversation_id"), F.concat(F.lit("invalid record: "), "error").alias("error"))


def report(records: DataFrame, violations: DataFrame, what: str, most: int = 1000) -> dict:
    """ok, checked and the first errors (a report for people: at most ``most`` lines, with their whole number)."""
    checked = records.count()
    n = violations.count()
    errors = [f"{r['conversation_id']}: {r['error']}" for r in violations.orderBy("conversation_id", "error").limit(most).collect()]
    if not checked:
        errors.append(f"no {what} found")
    return {"ok": not errors, "checked": checked, "n_errors": n if checked else n + 1, "errors": errors}
