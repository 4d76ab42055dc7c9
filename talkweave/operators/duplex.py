"""Two-channel timelines (extensions): maximal segments with event labels, turn taking, overlaps.

S0 is the user, S1 the assistant. Turn rows have conv_id, turn, speaker, start_ms, end_ms. Segments come from a sweep over starts and ends, not from frames, so a
recording of hours costs no more than its turns. Windows hold one conversation, that is one recording.

For all: turns with a null or an empty extent (end not after start) speak nothing and are left out; rows that repeat count once in segments, which know only whether a side
speaks; an empty table gives an empty one; columns beyond those named are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkweave.operators.asof import asof_join

LABELS = ("normal_turn", "backchannel", "interruption", "yield", "continue_speaking", "simultaneous_start", "silence")


def _spoken(turns: DataFrame) -> DataFrame:
    return turns.where("start_ms IS NOT NULL AND end_ms > start_ms AND speaker IN ('S0', 'S1')")


def segments(turns: DataFrame) -> DataFrame:
    """conv_id, seq (from 0), start_ms, end_ms, user and assistant (booleans), label. The segments of a conversation part the time from 0 to its last end, without a gap,
    and neighbours differ in who speaks.

    Labels, from the neighbours: nobody speaks: silence. Both speak: simultaneous_start if nobody spoke before; interruption if the one who spoke before has
    stopped when it ends and the other goes on; backchannel else (the other stops first, or both at once). One speaks, after both did:
    continue_speaking if the same one also spoke alone before that, else yield (the other gave way). All else: normal_turn."""
    said = _spoken(turns)
    event = lambda at, by: said.select("conv_id", F.col(at).cast("long").alias("at"), *(F.when(F.col("speaker") == s, by).otherwise(0).alias(c) for s, c in (("S0", "u"), ("S1", "a"))))
    origin = said.select("conv_id", F.lit(0).cast("long").alias("at"), F.lit(0).alias("u"), F.lit(0).alias("a"))
    moments = event("start_ms", 1).unionAll(event("end_ms", -1)).unionAll(origin).groupBy("conv_id", "at").agg(F.sum("u").alias("u"), F.sum("a").alias("a"))
    order = Window.partitionBy("conv_id").orderBy("at")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    state = moments.select("conv_id", "at", (F.sum("u").over(so_far) > 0).alias("user"), (F.sum("a").over(so_far) > 0).alias("assistant"))
    # a segment begins where the state changes; the last moment, where all have stopped, ends the last segment
    change = state.withColumn("same", (F.col("user") == F.lag("user").over(order)) & (F.col("assistant") == F.lag("assistant").over(order))).withColumn("last", F.max("at").over(Window.partitionBy("conv_id")))
    starts = change.where("(same IS NULL OR NOT same OR at = last) AND at >= 0")
    cut = starts.withColumn("end_ms", F.lead("at").over(order)).where("end_ms IS NOT NULL").withColumnRenamed("at", "start_ms")
    by = Window.partitionBy("conv_id").orderBy("start_ms")
    one = F.when(F.col("user") & F.col("assistant"), "B").when(F.col("user"), "U").when(F.col("assistant"), "A").otherwise("N")
    near = cut.withColumn("s", one).withColumns({"p": F.lag("s").over(by), "pp": F.lag("s", 2).over(by), "n": F.lead("s").over(by), "seq": (F.row_number().over(by) - 1).cast("long")})
    both = F.when(~F.coalesce(F.col("p").isin("U", "A"), F.lit(False)), "simultaneous_start").when(F.col("n").isin("U", "A") & (F.col("n") != F.col("p")), "interruption").otherwise("backchannel")
    alone = F.when(F.col("p") == "B", F.when(F.col("pp") == F.col("s"), "continue_speaking").otherwise("yield")).otherwise("normal_turn")
    label = F.when(F.col("s") == "N", "silence").when(F.col("s") == "B", both).otherwise(alone)
    return near.select("conv_id", "seq", "start_ms", "end_ms", "user", "assistant", label.alias("label"))


def responses(turns: DataFrame, width: int | None = None) -> DataFrame:
    """For each assistant turn the user turn that began last before it (or with it): conv_id, turn, start_ms, user_turn, user_end_ms, latency_ms (from the user's end to the
    start; null without a user turn) and interrupts (the user still spoke). Of user turns that begin together the last counts. ``width`` cuts long recordings, see asof_join."""
    said = _spoken(turns)
    user = said.where("speaker = 'S0'").select("conv_id", F.col("start_ms").alias("user_start_ms"), F.col("turn").alias("user_turn"), F.col("end_ms").alias("user_end_ms"))
    own = said.where("speaker = 'S1'").select("conv_id", "turn", "start_ms")
    met = asof_join(own, user, "conv_id", "start_ms", "user_start_ms", ["user_turn", "user_end_ms"], F.col("user_turn"), width)
    late = F.col("start_ms") - F.col("user_end_ms")
    return met.select("conv_id", "turn", "start_ms", "user_turn", "user_end_ms", late.alias("latency_ms"), F.coalesce(late < 0, F.lit(False)).alias("interrupts"))


def turn_taking(turns: DataFrame) -> DataFrame:
    """Per conversation: assistant_turns, false_interruptions (starts while the user speaks), user_turns, answered (user turns after which the assistant starts before the next
    one), latency_ms (sum over answers) and least and most latency, user_ms (time the user speaks), silent_ms (of that, the assistant silent)."""
    met = responses(turns)
    fair = ~F.col("interrupts") & F.col("user_turn").isNotNull()
    first = met.groupBy("conv_id", "user_turn").agg(
        F.count("*").alias("starts"), F.sum(F.col("interrupts").cast("long")).alias("early"), F.min(F.when(fair, F.col("latency_ms"))).alias("latency_ms")
    )
    assistant = first.groupBy("conv_id").agg(
        F.sum("starts").alias("assistant_turns"), F.sum("early").alias("false_interruptions"), F.count("latency_ms").alias("answered"), F.sum("latency_ms").alias("latency_ms"),
        F.min("latency_ms").alias("least_ms"), F.max("latency_ms").alias("most_ms"),
    )
    user = _spoken(turns).groupBy("conv_id").agg(F.sum((F.col("speaker") == "S0").cast("long")).alias("user_turns"))
    length = F.col("end_ms") - F.col("start_ms")
    time = segments(turns).where("user").groupBy("conv_id").agg(F.sum(length).alias("user_ms"), F.sum(F.when(~F.col("assistant"), length).otherwise(0)).alias("silent_ms"))
    whole = user.join(assistant, "conv_id", "left").join(time, "conv_id", "left")
    none = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return whole.select("conv_id", "user_turns", *map(none, ("assistant_turns", "false_interruptions", "answered", "latency_ms")), "least_ms", "most_ms", *map(none, ("user_ms", "silent_ms")))


def overlaps(turns: DataFrame, patience_ms: int = 1000) -> DataFrame:
    """One row for each segment in which both speak: conv_id, start_ms, label, overlap_ms, stop_ms (from the start to the stop of the one who gave way; null for a backchannel, where
    nobody needs to) and failed_to_stop (both went on for longer than ``patience_ms``)."""
    ms = F.col("end_ms") - F.col("start_ms")
    both = segments(turns).where("user AND assistant")
    return both.select("conv_id", "start_ms", "label", ms.alias("overlap_ms"), F.when(F.col("label") != "backchannel", ms).alias("stop_ms"), (ms > patience_ms).alias("failed_to_stop"))
