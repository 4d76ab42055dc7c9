"""Training data: drift, roles, rejected rows, weights; rows by number; small documents; voices by name."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkweave import cli, schemas
from talkweave.config import bucket_table
from talkweave.operators import corpus, rules, training
from talkweave.sources import files
from tests.test_text import bad


def test_drift(spark):
    rows = spark.createDataFrame([("a", 24_000, 12), ("a", 48_000, 26), ("a", None, 3), ("b", 24_000, None), ("c", 0, 1)], "g string, samples long, frames int")
    got = {r["g"]: tuple(r)[1:] for r in training.duration_drift(rows, "g").collect()}
    assert got == {"a": (2, 3000, 3040, 40, 80), "c": (1, 0, 80, 80, 80)}


def test_roles(spark):
    turns = spark.range(400).select((F.col("id") / 2).cast("long").alias("conv_id"), F.when(F.col("id") % 2 == 0, "S0").otherwise("S1").alias("speaker"))
    got = training.roles(turns).groupBy("conv_id").agg(F.collect_set("role").alias("r"), F.max(F.when(F.col("speaker") == "S0", F.col("role"))).alias("first")).collect()
    assert all(len(r["r"]) == 2 for r in got)  # one of each in a conversation
    assert 60 < sum(r["first"] == "user" for r in got) < 140
    assert training.roles(turns).collect() == training.roles(turns.repartition(5)).orderBy("conv_id", "speaker").collect()
    assert training.roles(turns, locked=True).where("(speaker = 'S0') <> (role = 'user')").count() == 0


def test_rejected(spark):
    rows = spark.createDataFrame([("x", [[1, 2], [3, 4]], None), (" ", [[1], [2]], None), (None, [[1], [2]], None), ("x", [], None), ("x", [[1], []], None), ("x", None, None), ("x", [[1]], "broken"), ("x", [[1] * 9], None)], "t string, c array<array<int>>, e string")
    got = [r["v"] for r in rows.select(training.rejected(F.col("t"), F.col("c"), 8, F.col("e")).alias("v")).collect()]
    assert got == [None, "empty", "empty", "empty", "empty", "failed", "failed", "too long"]


def test_weighted_by_event(spark):
    rows = spark.createDataFrame([(1, 0, 100, "normal_turn", 1.0), (1, 100, 200, "interruption", 4.0), (1, 200, 400, "silence", 2.0)], "conv_id int, start_ms long, end_ms long, label string, loss double")
    (r,) = training.weighted_by_event(rows, F.col("loss")).collect()
    assert r["weight"] == 400 and abs(r["loss"] - (100 + 800 + 200) / 400) < 1e-12


def test_rows_by_number(spark):
    rows = spark.createDataFrame([(f"i{k}", "t", "s", [[k]], 1, 1, "more") for k in range(9)], "id string, text string, speaker_id string, codes array<array<int>>, n_frames int, k_codebooks int, other string")
    (r,) = corpus.token_rows(rows.repartition(4), "id", at=5).collect()
    assert r["id"] == "i5" and r["codes"] == [[5]] and "other" not in r.asDict() and corpus.token_rows(rows, "id").count() == 9


def test_scripts_for_a_bucket(spark):
    rows = spark.createDataFrame([bad(name="a"), bad(name="b", category="medium"), bad(name="c", category=None)], schemas.SCRIPT)
    got = {r["conversation_id"]: r["reason"] for r in rules.judged_for(rows, bucket_table(spark), "short").collect()}
    assert got == {"a": None, "b": "script category medium does not match bucket short", "c": "script category  does not match bucket short"}


def test_small_documents(spark, tmp_path):
    files.write_json(spark, f"{tmp_path}/a/b.json", {"é": [1, 2]})
    text = (tmp_path / "a/b.json").read_text(encoding="utf-8")
    assert json.loads(text) == {"é": [1, 2]} and "é" in text and "\n  " in text


def flat():
    return lambda speaker, text, attempt: np.full(24_000 * 4, 0.1 * (speaker + 1), np.float32)


def test_voices_by_name(spark, tmp_path, capsys):
    spark.createDataFrame([bad(name="short_000000")], schemas.SCRIPT).coalesce(1).write.json(str(tmp_path / "s"))
    assert cli.main(["synth-stage3", "--scripts", str(tmp_path / "s"), "-o", str(tmp_path / "3"), "--voice", "tests.test_training:flat"]) == 0
    assert json.loads(capsys.readouterr().out)["written"] == 1
    (r,) = files.read_stage(spark, str(tmp_path / "3")).collect()
    assert r["duration_sec"] == 4 * len(r["turns"]) + 0.1 * (len(r["turns"]) - 1)
    with pytest.raises(RuntimeError, match="can't go with"):
        cli.main(["synth-stage3", "--scripts", str(tmp_path / "s"), "-o", str(tmp_path / "4"), "--voice", "tests.test_training:flat", "--mock"])
