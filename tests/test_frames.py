"""Frames of 80 ms and their counts, against sets of frames."""

import random

from talkweave.operators.dialogue import frame_streams, speech_report

KIND = "conv_id long, turn int, speaker string, start_ms long, end_ms long"


def test_frames_of_overlapping_turns(spark):
    """Turns overlap, repeat, miss a time, end before they start, or are of neither speaker."""
    rng = random.Random(4)
    turns = []
    for conv in range(6):
        for turn in range(12):
            start = rng.randint(0, 9_000)
            turns.append((conv, turn, rng.choice(("S0", "S1", "S1", "S2", None)), start, start + rng.choice((-500, 0, 1, 79, 80, 81, 700, 2_500))))
    turns += [(1, 20, "S0", None, 80), (2, 20, "S1", 80, None), (7, 0, "S0", 80, 80), *turns[:9]]
    want: dict = {}
    for conv, _, speaker, a, b in turns:
        for frame in range(a // 80, (b - 1) // 80 + 1) if a is not None and b is not None else ():
            want.setdefault((conv, frame), set()).add(speaker)
    table = spark.createDataFrame(turns, KIND)
    assert sorted(tuple(r) for r in frame_streams(table).collect()) == sorted((c, f, int("S0" in s), int("S1" in s)) for (c, f), s in want.items())
    report = {c: [(f, s) for (k, f), s in want.items() if k == c] for c, _ in want}
    assert sorted(tuple(r) for r in speech_report(table).collect()) == sorted((c, len(fs), sum({"S0", "S1"} <= s for _, s in fs), max(f for f, _ in fs) + 1) for c, fs in report.items())


def test_long_turns_cost_no_frames(spark):
    """Ten thousand million frames, half of them of both speakers."""
    turns = spark.createDataFrame([(1, 0, "S0", 0, 800_000_000_000), (1, 1, "S1", 400_000_000_000, 800_000_000_000)], KIND)
    assert [tuple(r) for r in speech_report(turns).collect()] == [(1, 10_000_000_000, 5_000_000_000, 10_000_000_000)]
