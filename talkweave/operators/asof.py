"""As-of joins of event streams: by a merged sort and a running last value, never by pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _free(taken: list[str], *names: str) -> list[str]:
    low = {c.lower() for c in taken}
    mark = "__"
    while any(f"{mark}{n}" in low for n in names):
        mark += "_"
    return [f"{mark}{n}" for n in names]


def asof_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, carry: list[str], order: Column | None = None, width: int | None = None) -> DataFrame:
    """left with the columns ``carry`` of the last row of right with the same key and a time not after the left row's; null where there is none.

    Both streams become one, sorted by key and time, in which the last right row so far is carried along. Of right rows at the same time the last by ``order`` counts
    (an expression over right's columns). With ``width``, a key is cut into stretches of so much time, each sorted by itself, with the last right
    row of all earlier stretches carried in: so a key with a third of all rows is many tasks. Rows whose key or time is null match nothing; left rows
    that repeat stay, each by itself. ``carry`` must not be names of left. Other columns may have any name."""
    if clash := {c.lower() for c in carry} & {c.lower() for c in left.columns}:
        raise ValueError(f"columns on both sides: {', '.join(sorted(clash))}")
    k, t, side, place, row, here, part, before = _free([*left.columns, *right.columns], "k", "t", "side", "place", "row", "here", "part", "before")
    kind = F.struct(*carry)
    width_of = lambda time: F.floor(F.col(time) / width) if width else F.lit(0).cast("long")
    null_left = F.lit(None)
    asked = left.select(F.col(key).alias(k), F.col(left_time).alias(t), F.lit(1).alias(side), null_left.alias(place), F.struct(*left.columns).alias(row), null_left.alias(here), width_of(left_time).alias(part))
    known = right.where(F.col(key).isNotNull() & F.col(right_time).isNotNull()).select(
        F.col(key).alias(k), F.col(right_time).alias(t), F.lit(0).alias(side), (order if order is not None else F.lit(0)).alias(place), F.lit(None).alias(row), kind.alias(here), width_of(right_time).alias(part)
    )
    both = asked.withColumn(place, F.lit(None).cast(known.schema[place].dataType)).withColumn(here, F.lit(None).cast(known.schema[here].dataType)).unionByName(known.withColumn(row, F.lit(None).cast(asked.schema[row].dataType)))
    # at one time right rows come first, so they count as "not after"
    running = Window.partitionBy(k, part).orderBy(t, side, place).rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(here, ignorenulls=True).over(running)
    if width:
        ends = known.groupBy(k, part).agg(F.max_by(here, F.struct(t, place)).alias(before))
        stretches = both.select(k, part).distinct().join(ends, [k, part], "left")
        earlier = Window.partitionBy(k).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
        carried = stretches.select(F.col(k).alias(f"{k}2"), F.col(part).alias(f"{part}2"), F.last(before, ignorenulls=True).over(earlier).alias(before))
        met = both.withColumn(here, last).where(F.col(side) == 1).join(carried, (F.col(k) == F.col(f"{k}2")) & (F.col(part) == F.col(f"{part}2")), "left")
        found = F.coalesce(here, before)
    else:
        met = both.withColumn(here, last).where(F.col(side) == 1)
        found = F.col(here)
    some = F.col(k).isNotNull() & F.col(t).isNotNull()
    return met.withColumn(here, F.when(some, found)).select(f"{row}.*", *(F.col(f"{here}.{c}").alias(c) for c in carry))
