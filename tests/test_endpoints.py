"""Endpointing as a stream against the batch form: frames out of order and late, over a restart."""

import os
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from talkweave.plans.queries import QUERIES
from talkweave.streaming.endpoints import endpoint_stream, endpoints, stretches

DATA = "/root/testdata/sf0.001"
KIND = "conv_id long, ts timestamp, active boolean"
ZERO = datetime(2024, 1, 1, tzinfo=timezone.utc)
STORE = "spark.sql.streaming.stateStore.providerClass"


def at(ms):
    return ZERO + timedelta(milliseconds=ms)


def slow(times, hang):
    out = []
    for t in sorted(set(times)):
        if out and t - out[-1][1] <= hang:
            out[-1] = (out[-1][0], t)
        else:
            out.append((t, t))
    return out


def test_stretches():
    rng = random.Random(1)
    for _ in range(300):
        times = [rng.randint(0, 60) for _ in range(rng.randint(0, 25))]
        cut = rng.randint(0, len(times))
        first = stretches(times[:cut], [], [], 3)
        assert stretches(times[cut:], [a for a, _ in first], [b for _, b in first], 3) == slow(times, 3)


@pytest.fixture
def rocks(spark):
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.set(STORE, before)


def test_stream_is_the_batch(spark, rocks, tmp_path):
    """Three runs from one checkpoint, stretches open between them; frames out of order within the allowed lateness."""
    rng = random.Random(6)
    frames = []
    for conv in range(4):
        for frame in range(150):
            active = (frame // rng.choice((5, 9, 14))) % 2 == 0
            frames.append((conv, at(frame * 80), None if rng.random() < 0.02 else active))
    frames.append((None, at(80), True))
    frames += rng.sample(frames, 20)
    order = sorted(frames, key=lambda f: f[1].timestamp() + rng.random() * 0.9)
    source, sink, mark = (str(tmp_path / x) for x in ("in", "out", "check"))
    parts = [order[:200], order[200:430], order[430:], [(9, at(100_000), True)], [(9, at(200_000), False)], [(9, at(300_000), False)]]
    for part in parts:
        spark.createDataFrame(part, KIND).coalesce(1).write.mode("append").parquet(source)
        stream = endpoint_stream(spark.readStream.schema(KIND).parquet(source), "1 second")
        stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
    late = spark.createDataFrame([(0, at(81), True)], KIND)
    late.write.mode("append").parquet(source)
    stream = endpoint_stream(spark.readStream.schema(KIND).parquet(source), "1 second")
    stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(sink).collect())
    everything = spark.createDataFrame([f for p in parts for f in p], KIND).withColumn("at_ms", F.unix_millis("ts"))
    want = sorted(tuple(r) for r in endpoints(everything).collect())
    assert got == want and len(want) > 20
    base = int(ZERO.timestamp() * 1000)
    brute = [(c, base + a, base + b, base + b + 240) for c in (0, 1, 2, 3, 9) for a, b in slow([int((t - ZERO).total_seconds() * 1000) for k, t, on in (f for p in parts for f in p) if k == c and on], 240)]
    assert want == sorted(brute)


def test_runs_are_their_frames(spark):
    """Runs of frames, overlapping, repeated, broken and unheard ones among them, give what their frames give; 80 ms or less between frames of a run."""
    rng = random.Random(3)
    runs = [(conv, rng.choice((-1, 1, 1, 1)) * 80 * rng.randint(0, 400), rng.choice((-1, 0, 1, 5, 30)), rng.choice((True, True, True, False, None))) for conv in (1, 2, 3, None) for _ in range(60)]
    runs = [(c, a, a + 80 * n, on) for c, a, n, on in runs] + [(1, None, 80, True), (2, 0, None, True)]
    runs += rng.sample(runs, 20)
    table = spark.createDataFrame(runs, "conv_id long, at_ms long, last_ms long, active boolean")
    frames = spark.createDataFrame([(c, t, on) for c, a, b, on in runs if a is not None and b is not None for t in range(a, b + 1, 80)], "conv_id long, at_ms long, active boolean")
    for hang in (80, 240, 250):
        heard = {c: [t for k, t, on in map(tuple, frames.collect()) if k == c and on] for c in (1, 2, 3)}
        brute = sorted((c, a, b, b + hang) for c, times in heard.items() for a, b in slow(times, hang))
        assert sorted(tuple(r) for r in endpoints(table, hang_ms=hang, last_col="last_ms").collect()) == brute and len(brute) > 8
        assert sorted(tuple(r) for r in endpoints(frames, hang_ms=hang).collect()) == brute
    single = frames.select("conv_id", (F.col("at_ms") / 80).cast("long").alias("at_ms"), "active")
    for hang in (0, 1, 2):
        brute = sorted((c, a, b, b + hang) for c, times in heard.items() for a, b in slow([t // 80 for t in times], hang))
        assert sorted(tuple(r) for r in endpoints(single, hang_ms=hang).collect()) == brute


def test_long_runs_cost_no_frames(spark):
    """Ten thousand million frames in one run."""
    table = spark.createDataFrame([(1, 0, 800_000_000_000, True), (1, 800_000_000_240, 800_000_000_240, True), (1, 900_000_000_000, 900_000_000_000, True)], "conv_id long, at_ms long, last_ms long, active boolean")
    assert sorted(tuple(r) for r in endpoints(table, last_col="last_ms").collect()) == [(1, 0, 800_000_000_240, 800_000_000_480), (1, 900_000_000_000, 900_000_000_000, 900_000_000_240)]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")
def test_query_makes_no_row_per_frame(spark):
    assert "Generate" not in QUERIES["endpoint_guard"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
