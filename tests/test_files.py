"""Files in the published form: indented metadata, broken files, missing audio, line numbers, codecs."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkweave import cli, schemas
from talkweave.config import Config
from talkweave.functions import tokens as tk
from talkweave.plans import stages
from talkweave.sources import audio, files

RATE = 24_000


def by_hand(folder, name, texts, seconds=1.0, **more):
    """A conversation as other programs write it: an indented document, with its WAV files."""
    turns, sound, at = [], [], 0
    for i, text in enumerate(texts):
        x = audio.tone(int(seconds * RATE), i % 2, RATE)
        path = f"audio/{name}/turn_{i:03d}.wav"
        (folder / f"audio/{name}").mkdir(parents=True, exist_ok=True)
        (folder / path).write_bytes(audio.encode(x, RATE))
        turns.append({"speaker": i % 2, "text": text, "audio_path": path, "start_ms": at, "end_ms": at + int(1000 * seconds)})
        at += int(1000 * seconds) + 100
        sound.append(x)
    whole = audio.joined(sound, RATE)
    (folder / f"audio/{name}.wav").write_bytes(audio.encode(whole, RATE))
    record = {"conversation_id": name, "category": "short", "language": "en", "duration_sec": len(whole) / RATE, "script_path": None, "mixed_audio_path": f"audio/{name}.wav", "turns": turns, "overlaps": []} | more
    (folder / "conversations").mkdir(parents=True, exist_ok=True)
    (folder / f"conversations/{name}.json").write_text(json.dumps(record, indent=2, ensure_ascii=False), encoding="utf-8")
    return record


@pytest.fixture
def call(spark, capsys):
    def run(*args):
        code = cli.main([str(a) for a in args])
        return code, json.loads(capsys.readouterr().out)

    return run


def test_a_folder_in_the_published_form(spark, tmp_path, call):
    three = tmp_path / "stage3"
    record = by_hand(three, "short_000000", ["Hé, are you free?", "Yes, I am.", "Good.", "See you."], 4.0)
    by_hand(three, "short_000001", ["One.", "Two.", "Three.", "Four."], 4.0)
    assert call("validate", "--path", three) == (0, {"ok": True, "checked": 2, "n_errors": 0, "errors": [], "audio_checked": True})
    assert call("inject-overlap", "--stage3", three, "-o", tmp_path / "stage4") == (0, {"written": 2, "skipped": 0})
    assert call("validate", "--subset", "stage4", "--path", tmp_path / "stage4")[1]["ok"]
    names = sorted(p.name for p in (tmp_path / "stage4/conversations").glob("*.json"))
    assert names == ["short_000000.json", "short_000001.json"]
    text = (tmp_path / "stage4/conversations/short_000000.json").read_text(encoding="utf-8")
    again = json.loads(text)
    assert again["turns"][0]["text"] == "Hé, are you free?" and "\\u" not in text and "\n  " in text and set(again) == set(record) and again["script_path"] is None
    assert call("tokenize", "--stage", three, "-o", tmp_path / "t", "--mock") == (0, {"written": 2})
    assert call("assemble-shards", "--tokens", tmp_path / "t", "--stage", three, "-o", tmp_path / "sh") == (0, {"written": 2})
    assert call("validate", "--subset", "shards", "--path", tmp_path / "sh")[0] == 0
    (token,) = spark.read.json(str(tmp_path / "t")).where("conversation_id = 'short_000000'").collect()
    assert (three / "conversations/short_000000.json").as_posix() == token["source_json"]


def test_broken_files_are_errors(spark, tmp_path, call):
    stage = tmp_path / "s"
    by_hand(stage, "short_000000", ["a", "b"], 8.0)
    by_hand(stage, "short_000001", ["a", "b"], 8.0)
    (stage / "conversations/bad.json").write_text('{"conversation_id": "x",\n "turns": 7}')
    (stage / "conversations/empty.json").write_text("")
    (stage / "conversations/half.json").write_text('{\n "conversation_id": "h", "category": "short"\n}')
    (stage / "audio/short_000001.wav").unlink()
    (stage / "audio/short_000001/turn_000.wav").write_bytes(b"not a wave")
    code, out = call("validate", "--path", stage)
    assert code == 1 and out["checked"] == 5 and out["errors"] == [
        "bad.json: invalid metadata: not of the schema", "empty.json: invalid metadata: empty file", "half.json: invalid metadata: missing duration_sec, turns", "short_000001: missing mixed audio audio/short_000001.wav",
    ]
    for args in (("inject-overlap", "--stage3", stage, "-o", tmp_path / "o"), ("tokenize", "--stage", stage, "-o", tmp_path / "t", "--mock")):
        with pytest.raises(Exception, match="invalid metadata in .*json"):
            cli.main([str(a) for a in args])


def test_a_stage_without_audio_fails(spark, tmp_path, call):
    by_hand(tmp_path, "short_000000", ["a", "b"], 8.0)
    (tmp_path / "audio").rename(tmp_path / "elsewhere")
    code, out = call("validate", "--path", tmp_path)
    assert code == 1 and out["errors"] == [f"short_000000: missing {x}" for x in ("mixed audio audio/short_000000.wav", "turn audio audio/short_000000/turn_000.wav", "turn audio audio/short_000000/turn_001.wav")]
    assert call("validate", "--path", tmp_path, "--metadata-only")[1]["ok"]


def test_line_numbers(spark, tmp_path, call):
    """Of every line of several files, in ranges smaller than a line too; blank lines count."""
    rng = random.Random(4)
    want = []
    (tmp_path / "in").mkdir()
    for f in range(3):
        lines = ["" if rng.random() < 0.2 else "x" * rng.randint(0, 60) + "é" * rng.randint(0, 3) for _ in range(rng.choice((1, 200)))]
        (tmp_path / f"in/{f}.jsonl").write_text("\n".join(lines) + "\n" * (f % 2), encoding="utf-8")
        want += [(f"{tmp_path}/in/{f}.jsonl", i + 1, x) for i, x in enumerate(lines) if i + 1 < len(lines) or x or f % 2]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "300b", "40b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert sorted(tuple(r) for r in files.numbered_lines(spark, f"{tmp_path}/in").collect()) == sorted(want), size
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    (tmp_path / "s.jsonl").write_text('{"conversation_id": "a", "category": "nope", "turns": []}\n\n{"conversation_id": 5, "turns": 7}\n{"category": "short"}\nrubbish\n')
    bad = files.bad_records(spark, f"{tmp_path}/s.jsonl", schemas.SCRIPT).collect()
    assert sorted((r["line"], r["record"]) for r in bad) == [(3, '{"conversation_id": 5, "turns": 7}'), (5, "rubbish")]
    code, out = call("validate", "--subset", "scripts", "--path", tmp_path / "s.jsonl")
    assert code == 1 and out["checked"] == 4
    assert out["errors"] == [f"{tmp_path}/s.jsonl:{n}: invalid record: {what}" for n, what in ((3, "not of the schema"), (4, "missing conversation_id, turns"), (5, "not of the schema"))] + ["a: unknown category"]


def energy():
    return lambda x, rate: [[int(abs(x[i * 1920 : (i + 1) * 1920]).sum()) % 2048 for i in range(len(x) // 1920)]] * 3


def test_a_codec_hears_the_mix(spark, tmp_path, call):
    by_hand(tmp_path, "short_000000", ["a", "b"], 2.0)
    assert call("tokenize", "--stage", tmp_path, "-o", tmp_path / "t", "--codec", "tests.test_files:energy") == (0, {"written": 1})
    (r,) = spark.read.json(str(tmp_path / "t")).collect()
    x, rate = audio.decode((tmp_path / "audio/short_000000.wav").read_bytes())
    assert r["codes_full"] == energy()(x, rate) and (r["codebook_count"], r["training_codebooks"]) == (3, 3) and r["codes_training"] == r["codes_full"]
    with pytest.raises(RuntimeError, match="name a codec"):
        cli.main(["tokenize", "--stage", str(tmp_path), "-o", str(tmp_path / "u")])
    (tmp_path / "audio/short_000000.wav").write_bytes(b"no")
    with pytest.raises(Exception, match="no codes of audio/short_000000.wav"):
        stages.tokenize(files.read_stage(spark, str(tmp_path)), Config(), str(tmp_path), encoder=energy).collect()


def test_stand_in_codes(spark, tmp_path):
    """Drawn by a generator that the SHA-1 of the audio's path seeds."""
    import hashlib

    by_hand(tmp_path, "short_000000", ["a", "b"], 2.0)
    (r,) = stages.tokenize(files.read_stage(spark, str(tmp_path)), Config(), str(tmp_path)).collect()
    path = f"{tmp_path}/audio/short_000000.wav"
    rng = np.random.default_rng(int(hashlib.sha1(path.encode()).hexdigest()[:8], 16))
    assert r["codes_full"] == rng.integers(0, 2048, size=(16, int(4.1 * 12.5))).tolist() and len(r["codes_training"]) == 8


def test_start_code_at_padding(spark):
    rows = [([5, 6, 7, -100, -100],), ([-100, 4],), ([9],), ([],), ([-100],)]
    got = [r["p"] for r in spark.createDataFrame(rows, "c array<int>").select(tk.previous_codes(F.col("c")).alias("p")).collect()]
    want = []
    for (c,) in rows:
        safe = np.maximum(np.array(c, int), 0)
        p = np.concatenate(([2048], safe[:-1])) if c else np.array([], int)
        want.append(np.where(np.array(c) == -100, 2048, p).tolist())
    assert got == want


def test_headers_without_samples(spark, tmp_path):
    """Extra chunks, a length beyond the file, stereo, and what is no WAV."""
    (tmp_path / "audio").mkdir()
    whole = audio.encode(audio.tone(2400, 0, RATE), RATE)
    extra = b"LIST" + (5).to_bytes(4, "little") + b"odd..\0"
    (tmp_path / "audio/a.wav").write_bytes(whole[:12] + extra + whole[12:36] + extra + whole[36:])
    (tmp_path / "audio/b.wav").write_bytes(whole[:40] + (1 << 31).to_bytes(4, "little") + whole[44:])
    (tmp_path / "audio/c.wav").write_bytes(b"RIFF")
    got = {r["path"]: r["seconds"] for r in files.stage_audio(spark, str(tmp_path)).collect()}
    assert got == {"audio/a.wav": 0.1, "audio/b.wav": 0.1, "audio/c.wav": None}


def test_written_audio(spark, tmp_path):
    rows = spark.createDataFrame([("x/000_decoded.wav", [[1, 2], [3, 4]]), ("x/001_decoded.wav", [[5], [6]])], "id string, codes array<array<int>>")
    sound = audio.decoded(rows, lambda: lambda codes: codes.sum(axis=0) / 16, RATE)
    out = files.write_audio(sound, str(tmp_path), "id").collect()
    assert {r["name"]: r["bytes"] for r in out} == {p.relative_to(tmp_path).as_posix(): p.stat().st_size for p in (tmp_path / "x").glob("*.wav")}
    assert np.allclose(audio.decode((tmp_path / "x/000_decoded.wav").read_bytes())[0], [4 / 16, 6 / 16], atol=1e-4)
