"""Operators on codec codes and training sequences, and what is exported from scripts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkweave.functions import text as tx
from talkweave.functions import tokens as tk
from talkweave.operators.ordinal import ordinal, ordinal_within

SHARD_ROWS = 500


def long_codes(rows: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """One row per code: id, cb, frame, code."""
    by_cb = rows.select(id_col, F.posexplode("codes").alias("cb", "c"))
    return by_cb.select(id_col, "cb", F.posexplode("c").alias("frame", "code"))


def previous(codes: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Adds prev, the code one frame before, the start code at first."""
    return codes.withColumn("prev", F.lag("code", 1, tk.START_CODE).over(Window.partitionBy(id_col, "cb").orderBy("frame")))


def sequences(tokens: DataFrame, conversations: DataFrame, keys: list[str], *carry: str) -> DataFrame:
    """Training sequences: token records (codes_training) with their conversation's turns; ``carry`` names columns of the records to keep."""
    both = tokens.join(conversations.select(*keys, "turns"), keys)
    codes = F.col("codes_training")
    return both.select(*keys, *carry, tk.sequence_tokens(F.col("turns"), codes).alias("tokens"), tk.sequence_mask(F.col("turns"), codes).alias("loss_mask"))


def collated(rows: DataFrame, batch: Column, budget: int = 192, id_col: str = "conv_id") -> DataFrame:
    """Codes cut or filled to the batch's frames (its largest row, at most the budget), with a mask of real frames. The frames
    are a maximum by batch, joined back."""
    own = F.least(F.col("n_frames"), tk.shortest(F.col("codes")))
    marked = rows.withColumn("batch", batch).withColumn("own", own)
    frames = marked.groupBy("batch").agg(F.least(F.max("own"), F.lit(budget)).alias("frames"))
    both = marked.join(frames, "batch")
    return both.select(
        id_col, "batch", "frames", F.transform("codes", lambda c: tk.padded_codes(F.slice(c, F.lit(1), F.col("own")), F.col("frames"))).alias("codes"), tk.frame_mask(F.col("own"), F.col("frames")).alias("code_mask")
    )


def codebook_report(codes: DataFrame) -> DataFrame:
    """By codebook: codes, different codes, repeats of the frame before, least and largest code."""
    seen = previous(codes)
    return seen.groupBy("cb").agg(
        F.count("*").alias("n"), F.countDistinct("code").alias("distinct_codes"), F.sum((F.col("code") == F.col("prev")).cast("long")).alias("repeats"), F.min("code").alias("least"), F.max("code").alias("largest")
    )


def code_runs(codes: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Runs of equal codes in a codebook of a row: id, cb, start, code, length. Gaps and islands: a run begins where the code isn't that of the frame before; its number is
    a running count of such beginnings."""
    by = Window.partitionBy(id_col, "cb").orderBy("frame")
    begins = F.coalesce((F.col("code") != F.lag("code").over(by)) | (F.col("frame") != F.lag("frame").over(by) + 1), F.lit(True))
    numbered = codes.withColumn("begins", begins.cast("int")).withColumn("island", F.sum("begins").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(id_col, "cb", "island").agg(F.min("frame").alias("start"), F.min("code").alias("code"), F.count("*").alias("length")).drop("island")


def frame_runs(rows: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Runs of equal whole frames: id, start, length; only those of two frames or more. Frames go as far as the shortest codebook."""
    some = rows.where(tk.shortest(F.col("codes")) > 0)
    each = some.select(id_col, F.posexplode(F.transform(F.sequence(F.lit(0), tk.shortest(F.col("codes")) - 1), lambda f: F.transform("codes", lambda c: F.get(c, f)))).alias("frame", "whole"))
    by = Window.partitionBy(id_col).orderBy("frame")
    begins = F.coalesce(F.col("whole") != F.lag("whole").over(by), F.lit(True))
    numbered = each.select(id_col, "frame", begins.cast("int").alias("begins")).withColumn("island", F.sum("begins").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(id_col, "island").agg(F.min("frame").alias("start"), F.count("*").alias("length")).where("length > 1").drop("island")


def collapse_report(codes: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """By codebook: n codes, distinct ones, n_runs, longest run, in_repeats (codes that lie in runs of two or more), top (how often the most frequent code occurs) and entropy in bits. Counts by
    code are summed up in parts, so one codebook isn't one task's."""
    counts = codes.groupBy("cb", "code").agg(F.count("*").alias("k"))
    sums = counts.groupBy("cb").agg(F.sum("k").alias("n"), F.count("*").alias("distinct_codes"), F.max("k").alias("top"), F.sum(F.col("k") * F.log2(F.col("k"))).alias("s"))
    runs = code_runs(codes, id_col).groupBy("cb").agg(F.count("*").alias("n_runs"), F.max("length").alias("longest"), F.sum(F.when(F.col("length") > 1, F.col("length")).otherwise(0)).alias("in_repeats"))
    entropy = F.log2(F.col("n")) - F.col("s") / F.col("n")
    return sums.join(runs, "cb").select("cb", "n", "distinct_codes", "top", "n_runs", "longest", "in_repeats", entropy.alias("entropy"))


def weighted_loss(losses: DataFrame, *by: str, first_weight: float = 8.0) -> DataFrame:
    """losses: cb, loss. The mean over codebooks, the first weighing more, and how many there are; of each group ``by``."""
    w = F.when(F.col("cb") == 0, F.lit(first_weight)).otherwise(F.lit(1.0))
    return losses.groupBy(*by).agg((F.sum(w * F.col("loss")) / F.sum(w)).alias("loss"), F.count("*").alias("codebooks"))


def real_time(log: DataFrame, *by: str) -> DataFrame:
    """log: audio_sec and us (microseconds that it took) of each item. Of each group ``by``: items, wall_us, audio_sec, frames, and speed, seconds of audio a second of wall time."""
    seconds = F.sum("us") / F.lit(1e6)
    return log.groupBy(*by).agg(
        F.count("*").alias("items"), F.sum("us").alias("wall_us"), F.sum("audio_sec").alias("audio_sec"), F.sum(F.greatest(F.lit(1), F.floor(F.col("audio_sec") * tk.FRAMES_PER_SECOND))).alias("frames"),
        (F.sum("audio_sec") / F.greatest(seconds, F.lit(1e-6))).alias("speed"),
    )


def sharded(rows: DataFrame, split: str, *order: str, size: int = SHARD_ROWS, offset: int = 0) -> DataFrame:
    """Adds shard: fixed-size chunks in order within each split, after ``offset`` shards that exist."""
    return ordinal_within(rows, split, *order).withColumn("shard", F.floor(F.col("idx") / size) + offset)


def codec_rows(rows: DataFrame, dataset: str, rate: int) -> DataFrame:
    """Rows of a codec corpus from id, speaker, text, split, idx (the row's number in its split), codes and n_samples: an absent id is made from
    split and number, an absent speaker is 'unknown'."""
    return rows.select(
        tx.row_id(F.col("id"), F.col("split"), F.col("idx")).alias("id"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("speaker", F.lit("unknown")).alias("speaker_id"),
        F.col("codes").cast("array<array<smallint>>").alias("codes"), F.size(F.get("codes", F.lit(0))).alias("n_frames"), F.size("codes").alias("k_codebooks"), F.lit(rate).alias("sampling_rate"),
        (F.col("n_samples") / rate).cast("float").alias("duration_sec"), F.lit(dataset).alias("source_dataset"), F.col("split").alias("source_split"),
    )


def token_rows(rows: DataFrame, *order: str, at: int | None = None) -> DataFrame:
    """What training reads of codec rows, in order, with idx from 0; only the row of that number with ``at``."""
    kept = rows.select("id", "text", "speaker_id", "codes", "n_frames", "k_codebooks")
    numbered = ordinal(kept, *order)
    return numbered if at is None else numbered.where(F.col("idx") == at)


def first_of_each(rows: DataFrame, split: str, n: int, *order: str) -> DataFrame:
    """The first n rows of each split, in order; tasks keep their own first n before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(split).orderBy(*order))
    return rows.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")


def mean_loss(losses: DataFrame, *by: str) -> DataFrame:
    """losses: loss of each batch. Their mean; 0 without any batch; of each group ``by``."""
    return losses.groupBy(*by).agg((F.coalesce(F.sum("loss"), F.lit(0.0)) / F.greatest(F.count("loss"), F.lit(1))).alias("loss"), F.count("loss").alias("batches"))


def wall_hours(mean_sec: Column, rows: Column, speed: float) -> Column:
    """Hours that so many rows take at so many times the speed of their audio, carried on from their mean length."""
    return mean_sec * rows / F.lit(speed) / 3600


def first_rows(rows: DataFrame, n: int, *order: str) -> DataFrame:
    """The first n rows in order, before any other filter."""
    return rows.orderBy(*order).limit(n)


def train_eval(rows: DataFrame, key: str, seed: int = 13, most: int = 128, share: int = 20) -> DataFrame:
    """Adds part: an evaluation part of exact size min(128, max(1, n // 20)) by hash order, the rest for training."""
    n = rows.count()
    size = min(most, max(1, n // share))
    order = F.sha1(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return ordinal(rows.withColumn("__h", order), "__h", key).withColumn("part", F.when(F.col("idx") < size, "eval").otherwise("train")).drop("idx", "__h")


def with_prompts(scripts: DataFrame, prompts: DataFrame, *order: str) -> DataFrame:
    """Scripts with a voice prompt by row number modulo the number of prompts. All scripts are numbered; filter afterwards.
    The prompt bank is recorded by hand; where it is large, the join isn't broadcast."""
    bank = ordinal(prompts, "path", name="p_idx").drop("path")
    n = bank.count()
    if not n:
        raise ValueError("no voice prompt pairs found")
    return ordinal(scripts, *order).withColumn("p_idx", F.col("idx") % n).join(bank, "p_idx").drop("p_idx")


def tsv_rows(scripts: DataFrame, prompts: DataFrame, *order: str) -> DataFrame:
    """The six columns of the export, in script order: file, transcriptions, prompt files, text."""
    both = with_prompts(scripts, prompts, *order)
    return both.select("idx", "category", F.concat("conversation_id", F.lit(".wav")).alias("wav"), "s1_prompt_transcription", "s2_prompt_transcription", "s1_prompt_wav", "s2_prompt_wav", tx.linear(F.col("turns")).alias("text"))
