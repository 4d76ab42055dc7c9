"""Column functions on turn durations and overlaps; times are whole milliseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GAP_MS = 100
BACKCHANNEL_OFFSET_MS = 250
KINDS = ("backchannel", "interruption", "simultaneous_start")
#: Shortest and longest overlap in ms, and the part of the shifted turn that it takes.
LENGTHS = {"backchannel": (300, 900, 2), "interruption": (500, 1400, 2), "simultaneous_start": (350, 1000, 3)}


def turn_samples(word_count: Column, rate: int) -> Column:
    """Samples of the stand-in voice: 2.8 words a second, 0.6 s at least."""
    seconds = F.greatest(F.lit(0.6).cast("double"), F.greatest(word_count, F.lit(1)) / F.lit(2.8).cast("double"))
    return F.floor(seconds * F.lit(rate)).cast("long")


def samples_ms(samples: Column, rate: int) -> Column:
    """Whole ms; halves go to the even number."""
    return F.rint(samples / F.lit(rate) * 1000).cast("long")


def overlap_ms(kind: Column, turn_ms: Column) -> Column:
    def of(k: str) -> Column:
        low, high, part = LENGTHS[k]
        return F.least(F.greatest(F.floor(turn_ms / part), F.lit(low)), F.lit(high)).cast("long")

    return F.when(kind == KINDS[0], of(KINDS[0])).when(kind == KINDS[1], of(KINDS[1])).otherwise(of(KINDS[2]))


def shifted_start(kind: Column, a_start: Column, a_end: Column, turn_ms: Column) -> Column:
    """Where the later turn starts after its shift; the overlap's length comes from a turn of ``turn_ms``."""
    early = a_end - overlap_ms(kind, turn_ms)
    return F.when(kind == KINDS[2], a_start).when(kind == KINDS[1], F.greatest(a_start, early)).otherwise(F.greatest(a_start + BACKCHANNEL_OFFSET_MS, early))


def draw(seed: int, key: Column, salt: str = "") -> Column:
    """A number in [0, 1) that any engine gets from seed and key."""
    h = F.sha1(F.concat(F.lit(f"{seed}:{salt}"), key.cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / float(1 << 32)


def overlap_kind(u: Column, backchannel: float = 0.70, interruption: float = 0.25) -> Column:
    return F.when(u < backchannel, KINDS[0]).when(u < backchannel + interruption, KINDS[1]).otherwise(KINDS[2])
