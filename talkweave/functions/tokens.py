"""Column functions on codec codes, array<array<int>> by codebook."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from talkweave.functions.text import split_words

FRAMES_PER_SECOND = 12.5
CODES = 2048
START_CODE = 2048
PADDING = -100


def frame_count(samples: Column, rate: int) -> Column:
    return F.greatest(F.lit(1), F.floor(samples / F.lit(rate) * F.lit(FRAMES_PER_SECOND)).cast("int"))


def first_codebooks(codes: Column, k: int) -> Column:
    return F.slice(codes, 1, k)


def shortest(codes: Column) -> Column:
    """Frames of the shortest codebook; 0 without any."""
    return F.coalesce(F.array_min(F.transform(codes, F.size)), F.lit(0))


def frame_major(codes: Column) -> Column:
    """All codes of the first frame, then of the next, as far as the shortest codebook goes."""
    n = shortest(codes)
    frames = F.transform(F.sequence(F.lit(0), n - 1), lambda f: F.transform(codes, lambda c: F.get(c, f)))
    return F.when(n > 0, F.flatten(frames)).otherwise(F.array().cast("array<int>"))


def text_tokens(turns: Column) -> Column:
    """Marker, words and audio marker of each turn; speakers are 0 and 1."""
    mark = lambda t, what: F.concat(F.lit("<|s"), t["speaker"].cast("string"), F.lit(f"_{what}|>"))
    return F.flatten(F.transform(turns, lambda t: F.concat(F.array(mark(t, "text")), split_words(t["text"]), F.array(mark(t, "audio")))))


def code_tokens(flat: Column) -> Column:
    return F.transform(flat, lambda c: F.concat(F.lit("<|mimi_"), c.cast("string"), F.lit("|>")))


def sequence_tokens(turns: Column, codes: Column) -> Column:
    """Text of all turns, then the codes frame by frame."""
    return F.concat(text_tokens(turns), code_tokens(frame_major(codes)))


def sequence_mask(turns: Column, codes: Column) -> Column:
    """1 on codes, 0 on text."""
    return F.concat(F.transform(text_tokens(turns), lambda _: F.lit(0)), F.transform(frame_major(codes), lambda _: F.lit(1)))


def previous_codes(codebook: Column) -> Column:
    """Codes one frame later, the start code first and wherever the frame itself is padding; a code before that is padding counts as 0."""
    n = F.size(codebook)
    before = F.concat(F.array(F.lit(START_CODE)), F.slice(F.transform(codebook, lambda c: F.greatest(c, F.lit(0))), F.lit(1), n - 1))
    return F.when(n == 0, codebook).otherwise(F.zip_with(codebook, before, lambda c, p: F.when(c == PADDING, START_CODE).otherwise(p)))


def padded_codes(codebook: Column, frames: Column) -> Column:
    """Cut or filled to so many frames."""
    frames = frames.cast("int")
    return F.slice(F.concat(codebook, F.array_repeat(F.lit(PADDING), frames)), F.lit(1), frames)


def frame_mask(n: Column, frames: Column) -> Column:
    frames = frames.cast("int")
    kept = F.least(n.cast("int"), frames)
    return F.concat(F.array_repeat(F.lit(1), kept), F.array_repeat(F.lit(0), frames - kept))


def codes_valid(codes: Column, n_frames: Column, k: int = 32) -> Column:
    """k codebooks, every code within range, as many frames as stated."""
    in_range = F.forall(codes, lambda c: F.forall(c, lambda v: v.between(0, CODES - 1)))
    return (F.size(codes) == k) & in_range & (F.size(F.get(codes, F.lit(0))) == n_frames)
