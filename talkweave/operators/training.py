"""What training data is checked and prepared by (extensions): duration drift, role draws, rejected rows, loss weights by event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkweave.functions import timeline as tl
from talkweave.functions import tokens as tk

FRAME_MS = int(1000 / tk.FRAMES_PER_SECOND)
#: How much a moment weighs by its label; others weigh 1.
WEIGHTS = {"interruption": 2.0, "yield": 2.0, "backchannel": 1.5, "simultaneous_start": 1.5, "silence": 0.5}


def duration_drift(rows: DataFrame, by: str, samples: str = "samples", frames: str = "frames", rate: int = 24_000) -> DataFrame:
    """Of each group: n, expected_ms (by samples), measured_ms (by codec frames), drift_ms and worst_ms, the largest drift of a row either way. Rows without either number are left out."""
    expected, measured = tl.samples_ms(F.col(samples), rate), (F.col(frames) * FRAME_MS).cast("long")
    each = rows.where(F.col(samples).isNotNull() & F.col(frames).isNotNull()).select(by, expected.alias("expected"), measured.alias("measured"))
    off = F.col("measured") - F.col("expected")
    return each.groupBy(by).agg(F.count("*").alias("n"), F.sum("expected").alias("expected_ms"), F.sum("measured").alias("measured_ms"), F.sum(off).alias("drift_ms"), F.max(F.abs(off)).alias("worst_ms"))


def roles(turns: DataFrame, seed: int = 13, share: float = 0.5, locked: bool = False) -> DataFrame:
    """turns with role: S0 is the user and S1 the assistant, the other way round in ``share`` of the conversations, drawn by seed and conversation only; never where ``locked``."""
    swapped = F.lit(False) if locked else tl.draw(seed, F.col("conv_id"), "role") < share
    user = (F.col("speaker") == "S0") != swapped
    return turns.withColumn("role", F.when(user, "user").otherwise("assistant"))


def rejected(text: Column, codes: Column, most_frames: int, failed: Column | None = None) -> Column:
    """Why a row of an extraction can't be trained on; null if it can: failed (an error is recorded, or there are no codes), empty (no text or no frame), or too long."""
    none = codes.isNull() | (failed.isNotNull() if failed is not None else F.lit(False))
    frames = tk.shortest(codes)
    return F.when(none, "failed").when(F.coalesce(F.trim(text) == "", F.lit(True)) | (frames == 0), "empty").when(frames > most_frames, "too long")


def weighted_by_event(segments: DataFrame, loss: Column, weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """segments with label and their losses: the mean loss of each conversation, segments weighing by their length and label."""
    w = F.coalesce(F.create_map(*(F.lit(x) for item in weights.items() for x in item))[F.col("label")], F.lit(1.0)) * (F.col("end_ms") - F.col("start_ms"))
    return segments.groupBy("conv_id").agg((F.sum(w * loss) / F.sum(w)).alias("loss"), F.sum(w).alias("weight"))
