"""Two-channel timelines, as-of joins, quantile sketches and code runs against brute force."""

import math
import random
from collections import Counter, defaultdict
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from talkweave.operators import corpus, duplex, quantiles
from talkweave.operators.asof import asof_join

TURNS = "conv_id long, turn long, speaker string, start_ms long, end_ms long"


def random_turns(seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(40):
        for turn in range(rng.randint(1, 9)):
            start = rng.randint(0, 40)
            rows.append((conv, turn, rng.choice(("S0", "S1")), start, start + rng.randint(-1, 15)))
    return rows + [(90, 0, "S0", None, 5), (90, 1, "S0", 5, None), (91, 0, "S2", 1, 5), (92, 0, "S0", 3, 7), (92, 0, "S0", 3, 7)]


def brute_segments(rows):
    """Millisecond by millisecond."""
    talk = defaultdict(lambda: defaultdict(set))
    end = Counter()
    for conv, _, speaker, a, b in rows:
        if speaker in ("S0", "S1") and a is not None and b is not None and b > a:
            end[conv] = max(end[conv], b)
            for t in range(a, b):
                talk[conv][t].add(speaker)
    out = []
    for conv in end:
        state = [frozenset(talk[conv][t]) for t in range(end[conv])]
        runs, at = [], 0
        for s, g in groupby(state):
            n = len(list(g))
            runs.append((at, at + n, s))
            at += n
        single = lambda s: len(s) == 1
        for i, (a, b, s) in enumerate(runs):
            p, pp, n = (runs[j][2] if 0 <= j < len(runs) else None for j in (i - 1, i - 2, i + 1))
            if not s:
                label = "silence"
            elif len(s) == 2:
                label = "simultaneous_start" if not (p is not None and single(p)) else "interruption" if n is not None and single(n) and n != p else "backchannel"
            elif p is not None and len(p) == 2:
                label = "continue_speaking" if pp == s else "yield"
            else:
                label = "normal_turn"
            out.append((conv, i, a, b, "S0" in s, "S1" in s, label))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_segments(spark, seed):
    rows = random_turns(seed)
    got = duplex.segments(spark.createDataFrame(rows, TURNS).withColumn("at", F.lit("x"))).collect()
    want = brute_segments(rows)
    assert sorted(map(tuple, got)) == sorted(want) and {r[-1] for r in want} == set(duplex.LABELS)
    assert duplex.segments(spark.createDataFrame([], TURNS)).count() == 0


@pytest.mark.parametrize("width", [None, 7])
def test_responses(spark, width):
    rows = random_turns(3)
    fair = [r for r in rows if r[2] in ("S0", "S1") and r[3] is not None and r[4] is not None and r[4] > r[3]]
    want = []
    for conv, turn, speaker, a, _ in fair:
        if speaker == "S1":
            user = max(((r[3], r[1], r[4]) for r in fair if r[0] == conv and r[2] == "S0" and r[3] <= a), default=None)
            want.append((conv, turn, a, *((user[1], user[2], a - user[2], a < user[2]) if user else (None, None, None, False))))
    got = duplex.responses(spark.createDataFrame(rows, TURNS), width).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_turn_taking(spark):
    rows = [(1, 0, "S0", 0, 10), (1, 1, "S1", 12, 20), (1, 2, "S0", 30, 40), (1, 3, "S1", 35, 50), (1, 4, "S0", 60, 70), (1, 5, "S1", 71, 72), (1, 6, "S1", 74, 80), (2, 0, "S0", 0, 5), (3, 0, "S1", 0, 5)]
    got = {r["conv_id"]: r.asDict() for r in duplex.turn_taking(spark.createDataFrame(rows, TURNS)).collect()}
    assert got[1] == {"conv_id": 1, "user_turns": 3, "assistant_turns": 4, "false_interruptions": 1, "answered": 2, "latency_ms": 3, "least_ms": 1, "most_ms": 2, "user_ms": 30, "silent_ms": 25}
    assert (got[2]["answered"], got[2]["assistant_turns"], got[2]["user_ms"]) == (0, 0, 5) and (got[3]["user_turns"], got[3]["assistant_turns"], got[3]["answered"]) == (0, 1, 0)


def test_overlaps(spark):
    rows = [(1, 0, "S0", 0, 3000), (1, 1, "S1", 1000, 4000), (2, 0, "S0", 0, 3000), (2, 1, "S1", 1000, 1500)]
    got = {r["conv_id"]: tuple(r)[1:] for r in duplex.overlaps(spark.createDataFrame(rows, TURNS)).collect()}
    assert got == {1: (1000, "interruption", 2000, 2000, True), 2: (1000, "backchannel", 500, None, False)}


@pytest.mark.parametrize("width", [None, 3, 1000])
def test_asof(spark, width):
    """Ties at one time, nulls in key and time, repeated rows, clashing names, a hot key."""
    rng = random.Random(9)
    left = [(rng.choice((1, 1, 1, 2, 3, None)), rng.choice((*range(40), None)), k % 20) for k in range(120)]
    right = [(rng.choice((1, 1, 1, 2, None)), rng.choice((*range(40), None)), k, f"v{k}") for k in range(80)]
    ldf = spark.createDataFrame(left, "k long, t long, side long")
    rdf = spark.createDataFrame(right, "k long, at long, n long, v string")
    got = asof_join(ldf, rdf, "k", "t", "at", ["n", "v"], F.col("n"), width).collect()
    want = []
    for k, t, s in left:
        best = max(((a, n, v) for kk, a, n, v in right if None not in (k, t, a) and kk == k and a <= t), default=(None, None, None))
        want.append((k, t, s, best[1], best[2]))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    with pytest.raises(ValueError, match="both sides"):
        asof_join(ldf, rdf, "k", "t", "at", ["k"])
    assert asof_join(ldf.limit(0), rdf, "k", "t", "at", ["v"], width=width).count() == 0


def test_quantiles(spark):
    """The stated error, and the same sketch in whatever order parts are merged."""
    rng = random.Random(7)
    rows = [("a", int(rng.expovariate(0.001))) for _ in range(4000)] + [("b", rng.randint(0, 50)) for _ in range(300)] + [("a", None), ("c", 2**62), ("d", 0)]
    df = spark.createDataFrame(rows, "g string, x long")
    whole = quantiles.sketch(df, "x", "g")
    parts = [quantiles.sketch(df.where(F.pmod(F.xxhash64("x"), F.lit(5)) == k), "x", "g") for k in range(5)]
    order = lambda d: sorted(map(tuple, d.collect()))
    assert order(whole) == order(quantiles.merge(*parts)) == order(quantiles.merge(parts[3], quantiles.merge(parts[0], parts[4]), quantiles.merge(*parts[1:3])))
    for r in quantiles.quantiles(whole, 1, 250, 500, 990, 1000).collect():
        exact = sorted(x for g, x in rows if g == r["g"] and x is not None)
        assert r["n"] == len(exact)
        for q in (1, 250, 500, 990, 1000):
            x = exact[max(1, math.ceil(len(exact) * q / 1000)) - 1]
            assert r[f"p{q}"] <= x and (x - r[f"p{q}"]) * 2**quantiles.BITS <= x
            # so its rank is short of the wanted one by that bucket's own rows at most
            assert sum(v < r[f"p{q}"] for v in exact) < math.ceil(len(exact) * q / 1000) or len(exact) == 1
    with pytest.raises(Exception, match="negative x"):
        quantiles.sketch(spark.createDataFrame([(-1,)], "x long"), "x").collect()


def test_runs(spark):
    rng = random.Random(2)
    codes = {i: [[rng.randint(0, 1) for _ in range(rng.choice((0, 1, 12)))] for _ in range(3)] for i in range(20)}
    rows = spark.createDataFrame(list(codes.items()), "conv_id long, codes array<array<int>>")
    want, frames = [], []
    for i, books in codes.items():
        for cb, c in enumerate(books):
            at = 0
            for code, g in groupby(c):
                n = len(list(g))
                want.append((i, cb, at, code, n))
                at += n
        at = 0
        for _, g in groupby(zip(*books)):
            n = len(list(g))
            frames += [(i, at, n)] if n > 1 else []
            at += n
    long = corpus.long_codes(rows)
    assert sorted(tuple(r) for r in corpus.code_runs(long).select("conv_id", "cb", "start", "code", "length").collect()) == sorted(want)
    assert sorted(tuple(r) for r in corpus.frame_runs(rows).select("conv_id", "start", "length").collect()) == sorted(frames)
    for r in corpus.collapse_report(long).collect():
        all_ = [x for books in codes.values() for x in books[r["cb"]]]
        mine = [n for _, cb, _, _, n in want if cb == r["cb"]]
        entropy = -sum(k / len(all_) * math.log2(k / len(all_)) for k in Counter(all_).values())
        assert (r["n"], r["n_runs"], r["longest"], r["in_repeats"], r["top"]) == (len(all_), len(mine), max(mine), sum(n for n in mine if n > 1), max(Counter(all_).values()))
        assert abs(r["entropy"] - entropy) < 1e-9
