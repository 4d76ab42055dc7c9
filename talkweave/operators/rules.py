"""Rules on scripts, timelines and sequences.

Two forms: columns on nested records (no shuffle), and aggregates on turn rows, whose partial sums are made before the
shuffle. Script rules give the first failing reason; directory rules give every violation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkweave.functions import text as tx

DIRECTIONS, PUNCTUATION, ESTIMATE, UNKNOWN = "contains stage directions", "turn is missing terminal punctuation", "estimated duration is outside prompt tolerance", "unknown category"
ALTERNATION, EMPTY_TURN = "adjacent turns must alternate speakers", "turn text must not be empty"


def turn_fault(text: Column) -> Column:
    """The first rule that a turn's text breaks; null if none."""
    return F.when(text.rlike(tx.PARENTHETICAL) | text.rlike(tx.BRACKETED), DIRECTIONS).when(~text.rlike(tx.TERMINAL), PUNCTUATION)


def first_reason(n_turns: Column, n_words: Column, fault: Column, seconds: Column, bucket: str = "") -> Column:
    """The first failing rule of a script against its joined bucket's columns (null name: unknown category)."""
    b = lambda c: F.col(f"{bucket}{c}")
    return F.coalesce(
        F.when(b("name").isNull(), UNKNOWN),
        F.when(~n_turns.between(b("turn_min"), b("turn_max")), F.format_string("has %d turns, expected %d-%d", n_turns.cast("long"), b("turn_min"), b("turn_max"))),
        F.when(~n_words.between(b("words_min"), b("words_max")), F.format_string("has %d words, expected %d-%d", n_words.cast("long"), b("words_min"), b("words_max"))),
        fault,
        F.when(~F.coalesce(seconds.between(b("duration_min_sec") * F.lit(0.25), b("duration_max_sec") * F.lit(1.5)), F.lit(True)), ESTIMATE),
    )


def script_fault(turns: Column) -> Column:
    """Of the first failing turn."""
    return F.get(F.filter(F.transform(turns, lambda t: turn_fault(t["text"])), lambda x: x.isNotNull()), F.lit(0))


def alternates(turns: Column) -> Column:
    n = F.size(turns)
    same = F.exists(F.sequence(F.lit(1), n - 1), lambda i: F.get(turns, i)["speaker"] == F.get(turns, i - 1)["speaker"])
    return F.when(n < 2, True).otherwise(~same)


def has_empty_turn(turns: Column) -> Column:
    return F.exists(turns, lambda t: tx.strip(t["text"]) == "")


def times_hold(turns: Column) -> Column:
    return F.forall(turns, lambda t: t["end_ms"] > t["start_ms"])


def judged_scripts(scripts: DataFrame, buckets: DataFrame) -> DataFrame:
    """Nested scripts with ``reason``: the first rule each breaks, null if it is accepted. Buckets are a few rows."""
    b = F.broadcast(buckets.select([F.col(c).alias(f"b_{c}") for c in buckets.columns]))
    joined = scripts.join(b, F.col("category") == F.col("b_name"), "left")
    shape = F.when(has_empty_turn(F.col("turns")), EMPTY_TURN).when(~alternates(F.col("turns")), ALTERNATION)
    first = first_reason(F.size("turns"), tx.script_words(F.col("turns")), script_fault(F.col("turns")), F.col("estimated_duration_sec"), "b_")
    return joined.withColumn("reason", F.coalesce(shape, first)).select(*scripts.columns, "reason")


def judged_for(scripts: DataFrame, buckets: DataFrame, bucket: str) -> DataFrame:
    """Scripts that are meant for one bucket, with ``reason``: another category comes before all other rules."""
    fits = F.col("category") == bucket
    told = F.concat(F.lit("script category "), F.coalesce("category", F.lit("")), F.lit(f" does not match bucket {bucket}"))
    judged = judged_scripts(scripts, buckets)
    return judged.withColumn("reason", F.when(~F.coalesce(fits, F.lit(False)), told).otherwise(F.col("reason")))


def judged_turns(turns: DataFrame, buckets: DataFrame) -> DataFrame:
    """The same verdicts from turn rows: conv_id, category, turn, text. One row per conversation."""
    fault = turn_fault(F.col("text"))
    per = turns.groupBy("conv_id").agg(
        F.count("*").alias("n_turns"), F.sum(tx.words(F.col("text"))).alias("n_words"), F.sum(tx.space_words(F.col("text"))).alias("spaced"), F.sum(tx.openings(F.col("text"))).alias("open"),
        F.min(F.when(fault.isNotNull(), F.struct("turn", fault.alias("fault")))).alias("first"), F.first("category").alias("category"),
    )
    joined = per.join(F.broadcast(buckets), F.col("category") == F.col("name"), "left")
    seconds = tx.estimate(F.col("spaced"), F.col("open"))
    return joined.select("conv_id", "category", "n_turns", "n_words", first_reason(F.col("n_turns"), F.col("n_words"), F.col("first.fault"), seconds).alias("reason"))
