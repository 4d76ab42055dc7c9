"""Endpointing (an extension): the moments from which an answer may start, as a batch and as a stream.

Frames are conv_id, a time, and whether the user is heard in it. Speech goes on as long as active frames follow each other within ``hang_ms``; that long after its last frame
it has ended, and the guard opens. Both forms give conv_id, start_ms, last_ms and endpoint_ms (when the guard opens) of each stretch of speech.

The stream takes frames in any order. It keeps, per conversation, the stretches that may still grow, two numbers each, and a timer for each; when the watermark has passed a
stretch's endpoint, no frame in time can lengthen it any more, so it is given out and forgotten. Frames later than the watermark allows are left out by Spark before
they are seen; without such frames the stream gives what the batch gives. Frames that repeat change nothing; those with a null time, conversation or activity
are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

HANG_MS = 240
STATE = T.StructType([T.StructField("starts", T.ArrayType(T.LongType())), T.StructField("lasts", T.ArrayType(T.LongType()))])


def endpoints(frames: DataFrame, time_col: str = "at_ms", hang_ms: int = HANG_MS, last_col: str | None = None) -> DataFrame:
    """The batch form; times are whole milliseconds. With ``last_col``, a row is a run of frames from time_col to last_col that follow each other within ``hang_ms``, so
    speech that is known by its turns costs no more than these; runs may overlap, and those that end before they begin, or have no end, are left out."""
    at, last = F.col(time_col).cast("long"), F.col(last_col or time_col).cast("long")
    heard = frames.where(F.col("active") & F.col("conv_id").isNotNull()).select("conv_id", at.alias("at"), last.alias("last")).where("last >= at")
    by = Window.partitionBy("conv_id").orderBy("at")
    reach = F.max("last").over(by.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col("at") - reach > hang_ms, F.lit(True)).cast("int")
    numbered = heard.withColumn("begins", begins).withColumn("stretch", F.sum("begins").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    out = numbered.groupBy("conv_id", "stretch").agg(F.min("at").alias("start_ms"), F.max("last").alias("last_ms"))
    return out.select("conv_id", "start_ms", "last_ms", (F.col("last_ms") + hang_ms).alias("endpoint_ms"))


def stretches(times: list[int], starts: list[int], lasts: list[int], hang_ms: int) -> list[tuple[int, int]]:
    """Open stretches with more active frames."""
    out: list[list[int]] = []
    for a, b in sorted([*zip(starts, lasts), *((t, t) for t in times)]):
        if out and a - out[-1][1] <= hang_ms:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


class Guard(StatefulProcessor):
    def __init__(self, hang_ms: int):
        self.hang_ms = hang_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", STATE)

    def _stored(self) -> tuple[list[int], list[int]]:
        state = self.open.get()
        return (list(state[0]), list(state[1])) if state is not None else ([], [])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        starts, lasts = self._stored()
        before = set(lasts)
        times = [t for pdf in rows for t in pdf.loc[pdf["active"].fillna(False).astype(bool), "at_ms"].dropna().astype("int64").tolist()]
        if times:
            now = stretches(times, starts, lasts, self.hang_ms)
            after = {b for _, b in now}
            for b in before - after:
                self.handle.deleteTimer(b + self.hang_ms)
            for b in after - before:
                self.handle.registerTimer(b + self.hang_ms)
            self.open.update(([a for a, _ in now], [b for _, b in now]))
        yield pd.DataFrame({"conv_id": pd.Series([], dtype="int64"), "start_ms": pd.Series([], dtype="int64"), "last_ms": pd.Series([], dtype="int64"), "endpoint_ms": pd.Series([], dtype="int64")})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        starts, lasts = self._stored()
        ended = [(a, b) for a, b in zip(starts, lasts) if b + self.hang_ms <= end]
        left = [(a, b) for a, b in zip(starts, lasts) if b + self.hang_ms > end]
        if left:
            self.open.update(([a for a, _ in left], [b for _, b in left]))
        else:
            self.open.clear()
        yield pd.DataFrame([(key[0], a, b, b + self.hang_ms) for a, b in ended], columns=["conv_id", "start_ms", "last_ms", "endpoint_ms"])

    def close(self) -> None:
        pass


def endpoint_stream(frames: DataFrame, lateness: str = "2 seconds", hang_ms: int = HANG_MS) -> DataFrame:
    """The streaming form. frames: conv_id (long), ts, active. Needs the RocksDB state store; conversations are spread by their id."""
    timed = frames.where("conv_id IS NOT NULL AND ts IS NOT NULL AND active IS NOT NULL").withWatermark("ts", lateness)
    return timed.withColumn("at_ms", F.unix_millis("ts")).groupBy("conv_id").transformWithStateInPandas(
        Guard(hang_ms), "conv_id long, start_ms long, last_ms long, endpoint_ms long", outputMode="Append", timeMode="EventTime"
    )
