"""Rounds of generation: reservations, slow and generous clients, killed runs."""

import random
import time

import pytest
from pyspark.sql import functions as F

from talkweave.config import Bucket, Config
from talkweave.operators import generation
from talkweave.sources import files

BUCKETS = [Bucket("short", 9, 4, 6, 12, 20, 16, 28, 55), Bucket("medium", 14, 6, 8, 25, 40, 30, 70, 115), Bucket("long", 0, 8, 10, 40, 60, 50, 120, 200)]


def state(spark, path):
    rows = files.read_scripts(spark, path).collect()
    ids = [r["conversation_id"] for r in rows]
    assert len(set(ids)) == len(ids)
    return {b: sum(r["category"] == b for r in rows) for b in ("short", "medium")}, sorted(ids)


def test_reservations():
    rng = random.Random(2)
    for _ in range(200):
        wanted = {b: rng.randint(0, 9) for b in "abc"}
        done = {b: rng.randint(0, 12) for b in "ab"}
        got = generation.reservations(wanted, done, rng.choice((None, 3)))
        assert all(n > 0 and done.get(b, 0) + n <= wanted[b] for b, n in got.items())
        assert {b for b, n in wanted.items() if n > done.get(b, 0)} == set(got)


def test_slow_and_generous_clients(spark, tmp_path):
    """A client that is slow, rejects some and sends thrice what it was asked for: no bucket gets more than its target, ids have no gap."""
    asked = []

    def source(spark, bucket, count):
        asked.append((bucket.name, count))
        slow = F.udf(lambda x, i: (time.sleep(0.02), x if i % 3 else "nothing")[1])
        return generation.dry_run(spark, bucket, 3 * count).withColumn("response", slow("response", "response_id"))

    path = str(tmp_path / "s")
    c = Config(buckets=BUCKETS)
    assert generation.generate(spark, c, path, source=source, most=5) == {"short": 9, "medium": 14, "long": 0}
    counts, ids = state(spark, path)
    assert counts == {"short": 9, "medium": 14} and ids == [*(f"medium_{i:06d}" for i in range(14)), *(f"short_{i:06d}" for i in range(9))]
    assert asked == [("short", 5), ("medium", 5), ("short", 4), ("medium", 5), ("medium", 4)]
    assert spark.read.json(f"{path}.manifest").first().asDict() == {"target": 23, "completed": 23, "failed": 0}
    assert generation.generate(spark, c, path, source=source) == {"short": 9, "medium": 14, "long": 0} and len(asked) == 5


@pytest.mark.parametrize("when", ["before", "after"])
def test_killed_runs_resume(spark, tmp_path, monkeypatch, when):
    """Killed before or after the commit of a round: nothing is lost that was published, and nothing comes twice."""
    path = str(tmp_path / "s")
    c = Config(buckets=BUCKETS)
    whole = files.publish
    left = [1]

    def killed(spark, staged, final):
        if when == "after" or left[0]:
            whole(spark, staged, final)
        if not left[0]:
            raise KeyboardInterrupt
        left[0] -= 1

    monkeypatch.setattr(files, "publish", killed)
    with pytest.raises(KeyboardInterrupt):
        generation.generate(spark, c, path, most=4)
    counts, _ = state(spark, path)
    assert counts == ({"short": 4, "medium": 4} if when == "before" else {"short": 8, "medium": 8})
    assert len(files.rounds(spark, path)) == (1 if when == "before" else 2)
    monkeypatch.setattr(files, "publish", whole)
    assert generation.generate(spark, c, path, most=4) == {"short": 9, "medium": 14, "long": 0}
    counts, ids = state(spark, path)
    assert counts == {"short": 9, "medium": 14} and ids[0] == "medium_000000" and ids[-1] == "short_000008"
    # each round's manifest is part of what was published
    last = files.rounds(spark, path)[-1]
    assert spark.read.json(f"{path}/round={last}/_manifest/*.json").first().asDict() == {"target": 23, "completed": 23, "failed": 0}
    assert not files.exists(spark, f"{path}.staging/round={last}")


def test_publishing_never_overwrites(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x").write_text(name)
    with pytest.raises(FileExistsError):
        files.publish(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    assert (tmp_path / "b/x").read_text() == "b"
