"""Operators on turn rows (conv_id, turn, speaker, text, category): timelines, overlaps, exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkweave.functions import text as tx
from talkweave.functions import timeline as tl


def by_turn():
    return Window.partitionBy("conv_id").orderBy("turn")


def category(n_turns: Column) -> Column:
    return F.when(n_turns.between(4, 5), "short").when(n_turns.between(6, 7), "medium").when(n_turns == 8, "long").otherwise("other")


def from_messages(messages: DataFrame) -> DataFrame:
    """Chat messages (conv_id, turn, role, text) as turn rows: user and assistant speak, others don't."""
    said = messages.where(F.col("role").isin("user", "assistant"))
    n = F.count("*").over(Window.partitionBy("conv_id"))
    return said.select("conv_id", "turn", F.when(F.col("role") == "user", "S0").otherwise("S1").alias("speaker"), "text", category(n).alias("category"))


def timeline(turns: DataFrame, rate: int = 24_000) -> DataFrame:
    """Adds samples, ms, start_ms and end_ms: turns follow each other with a gap."""
    timed = turns.withColumn("samples", tl.turn_samples(tx.space_words(F.col("text")), rate)).withColumn("ms", tl.samples_ms(F.col("samples"), rate))
    before = F.coalesce(F.sum(F.col("ms") + tl.GAP_MS).over(by_turn().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return timed.withColumn("start_ms", before).withColumn("end_ms", F.col("start_ms") + F.col("ms"))


def mixed_duration(turns: DataFrame, rate: int = 24_000) -> DataFrame:
    """conv_id, category, n_turns, total_samples: the length of the joined audio, with a tenth of a second between turns."""
    samples = tl.turn_samples(tx.space_words(F.col("text")), rate)
    return turns.groupBy("conv_id").agg(F.first("category").alias("category"), F.count("*").alias("n_turns"), (F.sum(samples) + (F.count("*") - 1) * (rate // 10)).alias("total_samples"))


def overlap_plan(timed: DataFrame, seed: int = 13, backchannel: float = 0.70, interruption: float = 0.25) -> DataFrame:
    """One shifted turn per conversation of three turns or more: conv_id, kind, turn_a, turn_b, shifted start and end of
    turn b, overlap_start_ms, overlap_end_ms. The overlap's length comes from turn b's. Draws depend on seed and conv_id only. Conversations without a pair of
    speakers, or whose overlap would be empty, have no row."""
    prior = lambda c: F.lag(c).over(by_turn())
    pairs = timed.select(
        "conv_id", "turn", "start_ms", "end_ms", "ms", prior("turn").alias("turn_a"), prior("start_ms").alias("a_start"), prior("end_ms").alias("a_end"),
        (F.col("speaker") != prior("speaker")).alias("alternates"), F.count("*").over(Window.partitionBy("conv_id")).alias("n_turns"),
    )
    pairs = pairs.where("n_turns >= 3 AND alternates")
    n = F.count("*").over(Window.partitionBy("conv_id"))
    rank = F.row_number().over(by_turn()) - 1
    chosen = pairs.withColumn("pick", F.floor(tl.draw(seed, F.col("conv_id"), "turn") * n)).withColumn("rank", rank).where("rank = pick")
    kind = tl.overlap_kind(tl.draw(seed, F.col("conv_id"), "kind"), backchannel, interruption)
    shifted = chosen.withColumn("kind", kind).withColumn("new_start", tl.shifted_start(F.col("kind"), F.col("a_start"), F.col("a_end"), F.col("ms"))).withColumn("new_end", F.col("new_start") + F.col("ms"))
    window = shifted.withColumn("overlap_start_ms", F.greatest("a_start", "new_start")).withColumn("overlap_end_ms", F.least("a_end", "new_end"))
    return window.where("overlap_end_ms > overlap_start_ms").select("conv_id", "kind", "turn_a", F.col("turn").alias("turn_b"), "new_start", "new_end", "overlap_start_ms", "overlap_end_ms")


def shifted_timeline(timed: DataFrame, plan: DataFrame) -> DataFrame:
    """Turn rows of the planned conversations with the shift applied."""
    p = plan.select(F.col("conv_id").alias("p_id"), "turn_b", "new_start", "new_end")
    joined = timed.join(p, F.col("conv_id") == F.col("p_id"))
    moved = F.col("turn") == F.col("turn_b")
    return joined.withColumn("start_ms", F.when(moved, F.col("new_start")).otherwise(F.col("start_ms"))).withColumn("end_ms", F.when(moved, F.col("new_end")).otherwise(F.col("end_ms"))).select(*timed.columns)


def order_violations(timed: DataFrame) -> DataFrame:
    """Turns that start before the previous one ends."""
    last = F.lag("end_ms", 1, -1).over(by_turn())
    return timed.withColumn("previous_end_ms", last).where("start_ms < previous_end_ms").select("conv_id", "turn", "start_ms", "previous_end_ms")


def overlap_audit(timed: DataFrame) -> DataFrame:
    """Time that a turn shares with any turn before it, from a running maximum instead of pairs."""
    reach = F.max("end_ms").over(by_turn().rowsBetween(Window.unboundedPreceding, -1))
    seen = timed.withColumn("shared_ms", F.when(reach.isNull(), 0).otherwise(F.greatest(F.lit(0), F.least(reach, F.col("end_ms")) - F.col("start_ms"))))
    return seen.groupBy("conv_id").agg(F.sum((F.col("shared_ms") > 0).cast("long")).alias("n_overlaps"), F.coalesce(F.sum("shared_ms"), F.lit(0)).alias("shared_ms"))


def linear_texts(turns: DataFrame) -> DataFrame:
    """conv_id, text: a conversation as one line of tagged turns."""
    part = F.struct("turn", F.concat(tx.tag(F.col("speaker")), F.lit(" "), F.col("text")).alias("s"))
    return turns.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda x: x["s"]), " ").alias("text"))


def frame_runs(timed: DataFrame, frame_ms: int = 80) -> DataFrame:
    """Runs of frames in which the same speakers are active, none in two: conv_id, first, last, s0, s1. They come from a sweep over the turns' first and last frames, so a
    conversation costs no more than its turns. Turns without a frame (the last before the first) are left out."""
    first, last = F.floor(F.col("start_ms") / frame_ms), F.floor((F.col("end_ms") - 1) / frame_ms)
    ends = F.inline(F.array(F.struct(first.alias("at"), F.lit(1).alias("n")), F.struct((last + 1).alias("at"), F.lit(-1).alias("n"))))
    of = lambda s: F.sum(F.when(F.col("speaker") == s, F.col("n")).otherwise(0))
    moments = timed.where(last >= first).select("conv_id", "speaker", ends).groupBy("conv_id", "at").agg(F.sum("n").alias("n"), of("S0").alias("s0"), of("S1").alias("s1"))
    order = Window.partitionBy("conv_id").orderBy("at")
    so_far = lambda c: F.sum(c).over(order.rowsBetween(Window.unboundedPreceding, 0)) > 0
    runs = moments.select("conv_id", F.col("at").alias("first"), (F.lead("at").over(order) - 1).alias("last"), so_far("n").alias("some"), *(so_far(c).cast("int").alias(c) for c in ("s0", "s1")))
    return runs.where("some").drop("some")


def frame_streams(timed: DataFrame, frame_ms: int = 80) -> DataFrame:
    """Frames of 80 ms in which each speaker is active: conv_id, frame, s0, s1."""
    return frame_runs(timed, frame_ms).select("conv_id", F.explode(F.sequence("first", "last")).alias("frame"), "s0", "s1")


def speech_report(timed: DataFrame) -> DataFrame:
    """Per conversation: frames spoken, frames both speak, span of frames."""
    n = F.col("last") - F.col("first") + 1
    return frame_runs(timed).groupBy("conv_id").agg(F.sum(n).alias("spoken"), F.sum(n * F.col("s0") * F.col("s1")).alias("both"), (F.max("last") + 1).alias("span"))
