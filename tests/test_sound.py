"""Long recordings in pieces are equal to the whole."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkweave.sources import audio, sound


def sine(n, rate, hz):
    return 0.5 * np.sin(2 * np.pi * hz * np.arange(n) / rate)


@pytest.mark.parametrize("rate_in,rate_out", [(16_000, 24_000), (44_100, 24_000), (48_000, 24_000), (24_000, 24_000), (22_050, 48_000)])
def test_resampler(rate_in, rate_out):
    """Sines become the sines of the new rate; stretches computed apart are the whole."""
    n = rate_in // 2
    r = sound.Resampler(rate_in, rate_out)
    x = sine(n, rate_in, 440)
    pad = lambda a, b: np.concatenate((np.zeros(max(0, -a)), x[max(0, a) : min(n, b)], np.zeros(max(0, b - max(n, a)))))
    total = r.length(n)
    assert total == -(-n * rate_out // rate_in)
    whole = r.samples(pad(*r.needs(0, total)), 0, total)
    middle = slice(total // 10, total - total // 10)
    assert np.abs(whole - sine(total, rate_out, 440))[middle].max() < 2e-4
    for cut in (1, 777, 5000):
        parts = [r.samples(pad(*r.needs(a, min(cut, total - a))), a, min(cut, total - a)) for a in range(0, total if cut > 1 else 50, cut)]
        assert np.array_equal(np.concatenate(parts), whole[: sum(map(len, parts))])


def test_reading_with_resampling(spark, tmp_path):
    rates = {"a": 16_000, "b/c": 44_100, "d": 24_000}
    for name, rate in rates.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / f"{name}.wav").write_bytes(audio.encode(sine(rate + 17, rate, 300).astype(np.float32), rate))
    (tmp_path / "e.wav").write_bytes(audio.encode(np.zeros(0, np.float32), 16_000))
    (tmp_path / "notes.txt").write_text("no audio")
    got = {}
    for chunk, each in ((1 << 18, 16), (1000, 2), (777, 1)):
        rows = sound.read_audio(spark, str(tmp_path), 24_000, chunk, each).orderBy("path", "chunk").collect()
        found = {}
        for r in rows:
            assert r["start"] == r["chunk"] * chunk == len(found.get(r["path"], [])) and r["rate"] == 24_000
            found.setdefault(r["path"], []).extend(r["samples"])
        got[chunk] = {p[len(str(tmp_path)) + 1 : -4]: np.array(x) for p, x in found.items()}
    for name, rate in rates.items():
        x = got[1 << 18][name]
        assert len(x) == -(-(rate + 17) * 24_000 // rate) and np.abs(x - sine(len(x), 24_000, 300))[300:-300].max() < 5e-4
        assert all(np.array_equal(x, got[c][name]) for c in got)
    assert sound.read_audio(spark, str(tmp_path), 24_000, 1000, 2).rdd.getNumPartitions() > 20
    (tmp_path / "bad.wav").write_bytes(b"no")
    with pytest.raises(Exception, match="no WAV"):
        sound.read_audio(spark, str(tmp_path), 24_000).count()


def test_mixing_by_chunks(spark, tmp_path):
    """Byte for byte the mix of the whole: turns over each other, over chunk borders, longer than said, from a later start, stereo."""
    rng = np.random.default_rng(4)
    rate = 8000
    turns, want = [], {}
    for conv in ("x", "y", "z"):
        parts = []
        (tmp_path / f"audio/{conv}").mkdir(parents=True)
        for t in range(7):
            start = int(rng.integers(0, 3000))
            n = int(rng.integers(1, 9000))
            end = start + int(n / rate * 1000) + int(rng.integers(-20, 20))
            path = f"audio/{conv}/turn_{t:03d}.wav"
            content = audio.encode(rng.uniform(-1, 1, n).astype(np.float32), rate)
            (tmp_path / path).write_bytes(content)
            parts.append((start, end, audio.decode(content)[0]))
            turns.append((conv, t, start, end, path))
        want[conv] = audio.encode(audio.mix(parts, rate, 0.82, 5.0 if conv == "z" else 0.0), rate)
    df = spark.createDataFrame(turns, "conv_id string, turn int, start_ms long, end_ms long, audio_path string").repartition(3)
    least = spark.createDataFrame([("z", 5.0)], "conv_id string, least_sec double")
    for chunk in (1000, 1 << 20):
        out = tmp_path / f"o{chunk}"
        out.mkdir()
        chunks = sound.mixed_chunks(df, str(tmp_path), rate, least=least, chunk=chunk)
        seconds = {r["conv_id"]: r["seconds"] for r in sound.write_mixes(chunks, str(out), rate).collect()}
        for conv, content in want.items():
            assert (out / f"audio/{conv}.wav").read_bytes() == content
            assert seconds[conv] == (len(content) - 44) / 2 / rate
    with pytest.raises(Exception, match="same sample rate"):
        sound.mixed_chunks(df, str(tmp_path), 16_000).count()


def test_augmentation_by_chunks(spark):
    """Chunks of any size give what the whole gives; draws depend on seed and id only."""
    rng = np.random.default_rng(2)
    rate, n = 8000, 10_000
    wave = {(i, c): rng.uniform(-0.3, 0.3, n + 300 * (c == "user")) for i in ("r1", "r2") for c in ("user", "assistant")}

    def run(chunk, seed=13):
        rows = [(i, c, k, x[k * chunk : (k + 1) * chunk].tolist()) for (i, c), x in wave.items() for k in range(-(-len(x) // chunk))]
        out = sound.augmented(spark.createDataFrame(rows, "id string, channel string, chunk long, samples array<double>").repartition(4), rate, chunk, seed).orderBy("chunk").collect()
        found = {}
        for r in out:
            found.setdefault((r["id"], r["channel"]), []).extend(r["samples"])
        return {k: np.array(v) for k, v in found.items()}

    whole = run(1 << 16)
    for chunk in (700, 4096):
        part = run(chunk)
        for key, x in whole.items():
            assert len(x) == len(wave[key]) and np.abs(part[key] - x).max() < 1e-12
            assert np.array_equal(np.rint(part[key] * 32767), np.rint(x * 32767))
    other = run(4096, seed=14)
    assert all(np.abs(other[k] - whole[k]).max() > 0.01 for k in whole)
    # the same by hand
    room = sound.Room(13, "r1", rate)
    u, a = wave["r1", "user"], wave["r1", "assistant"]
    want = np.convolve(u, room.response("user", "user"))[: len(u)] + np.pad(np.convolve(a, room.response("assistant", "user")), (0, len(u)))[: len(u)] + room.hiss("user", 0, len(u))
    assert np.abs(np.clip(want, -1, 1) - whole["r1", "user"]).max() < 1e-9
    assert len(room.response("user", "assistant")) == 0 and abs(room.hiss("user", 0, 50_000).std() - room.noise) < 0.05 * room.noise
    assert np.array_equal(room.hiss("user", 0, 100)[40:], room.hiss("user", 40, 60))
