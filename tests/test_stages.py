import http.server
import json
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkweave import cli, schemas
from talkweave.config import Bucket, Config, bucket_table
from talkweave.functions import tokens as tk
from talkweave.operators import corpus, generation, validate
from talkweave.operators.ordinal import ordinal, ordinal_within
from talkweave.plans import stage_audio, stages
from talkweave.sources import audio, client, files
from talkweave.storage import stored
from talkweave.streaming.ingest import ingest
from tests.test_text import GOOD, bad


@pytest.fixture(scope="module")
def scripts(spark):
    return spark.createDataFrame([bad(name="short_000000"), bad(GOOD[:2], name="short_000001"), bad(category="other", name="z")], schemas.SCRIPT)


def test_stage3_and_4(spark, scripts):
    c = Config()
    rows = {r["conversation_id"]: r for r in stages.synthesize(scripts, c).collect()}
    r = rows["short_000000"]
    assert [(t["start_ms"], t["end_ms"]) for t in r["turns"]] == [(0, 3929), (4029, 7958), (8058, 11987), (12087, 15658)]
    assert r["turns"][1]["audio_path"] == "audio/short_000000/turn_001.wav" and round(r["duration_sec"] * 24000) == 375769 and r["accepted"]
    assert not rows["short_000001"]["accepted"] and not rows["z"]["accepted"]
    done = stages.synthesize(scripts, c).drop("accepted")
    four = stages.inject_overlaps(done, c)
    out = {r["conversation_id"]: r for r in four.collect()}
    assert set(out) == {"short_000000", "z"}  # two turns are too few
    for r in out.values():
        (o,) = r["overlaps"]
        assert o["turn_a"] + 1 == o["turn_b"] and o["overlap_end_ms"] > o["overlap_start_ms"]
    buckets = bucket_table(spark)
    ok = four.where("category = 'short'")
    assert validate.report(ok, validate.stage_violations(ok, buckets, require_overlaps=True), "x")["ok"]
    assert [e["error"] for e in validate.stage_violations(ok, buckets).collect()] == [f"turn {out['short_000000']['overlaps'][0]['turn_b']} starts before previous turn ends"]
    assert not validate.report(done.where("conversation_id = 'short_000000'"), validate.stage_violations(done.where("conversation_id = 'short_000000'"), buckets, require_overlaps=True), "x")["ok"]
    have = spark.createDataFrame([("audio/short_000000.wav", 10.0)], "path string, seconds double")
    errors = {e["error"] for e in validate.stage_violations(done.where("conversation_id = 'short_000000'"), buckets, have).collect()}
    assert "metadata duration does not match WAV" in errors and "missing turn audio audio/short_000000/turn_000.wav" in errors


def test_overlap_of_a_short_turn(spark):
    """The overlap's length comes from the shifted turn: half of 600 ms for a backchannel, not half of the 3000 ms before it."""
    turns = [(0, "a", "", 0, 1000), (0, "b", "", 1100, 4100), (1, "c", "", 4200, 4800)]
    c = Config()
    c.overlap.backchannel_ratio, c.overlap.interruption_ratio = 1.0, 0.0
    r = stages.inject_overlaps(spark.createDataFrame([("x", "short", "en", 4.8, None, "", turns, [])], schemas.CONVERSATION), c).first()
    (o,) = r["overlaps"]
    assert (o["turn_a"], o["turn_b"], o["type"], o["overlap_start_ms"], o["overlap_end_ms"]) == (1, 2, "backchannel", 3800, 4100)
    assert (r["turns"][2]["start_ms"], r["turns"][2]["end_ms"]) == (3800, 4400)


def test_tokens(spark, scripts):
    c = Config()
    done = stages.synthesize(scripts, c).where("accepted").drop("accepted")
    t = stages.tokenize(done, c, "s")
    r = t.first()
    assert len(r["codes_full"]) == 16 and len(r["codes_training"]) == 8 and len(r["codes_full"][0]) == 195
    s = stages.assemble(t, done)
    r = s.first()
    assert len(r["tokens"]) == 1611 and sum(r["loss_mask"]) == 1560 and r["tokens"][0] == "<|s0_text|>" and r["loss_mask"][:51] == [0] * 51
    assert validate.report(s, validate.sequence_violations(s), "x")["ok"]
    spoiled = spark.createDataFrame([("a", "", ["x"], [0]), ("b", "", [], []), ("c", "", ["x", "y", "z"], [1, 1])], schemas.SEQUENCE)
    assert validate.sequence_violations(spoiled).count() == 4


def test_assemble_matches_stage_and_id(spark, scripts):
    c = Config()
    done = stages.synthesize(scripts, c).where("accepted").drop("accepted")
    t = stages.tokenize(done, c, "d/3")
    twice = stages.assemble(t.unionAll(t).unionAll(t), done, "d/3/").collect()
    assert [r["source_json"] for r in twice] == ["d/3/conversations/short_000000.json"] * 3
    for lost in (t.withColumn("conversation_id", F.lit("gone")), t.unionAll(stages.tokenize(done, c, "d/4"))):
        with pytest.raises(ValueError, match="1 token records without a conversation"):
            stages.assemble(lost, done, "d/3")


def test_validate_reads_audio(spark, scripts, tmp_path, capsys):
    stage = tmp_path / "3"
    files.write_stage(stages.synthesize(scripts, Config()).where("accepted").drop("accepted"), str(stage))
    (stage / "audio/short_000000").mkdir(parents=True)
    (stage / "audio/short_000000.wav").write_bytes(audio.encode(audio.tone(24000, 0, 24000), 24000))
    for i in range(3):
        (stage / f"audio/short_000000/turn_{i:03d}.wav").write_bytes(audio.encode(audio.tone(2400, 0, 24000), 24000))
    assert cli.main(["validate", "--path", str(stage)]) == 1
    out = json.loads(capsys.readouterr().out)
    assert out["audio_checked"] and out["errors"] == ["short_000000: metadata duration does not match WAV", "short_000000: missing turn audio audio/short_000000/turn_003.wav"]


def test_stages_write_audio(spark, scripts, tmp_path, capsys):
    c, three, four = Config(), str(tmp_path / "3"), str(tmp_path / "4")
    scripts.coalesce(1).write.json(str(tmp_path / "s"))
    call = lambda *a: (cli.main(list(a)), json.loads(capsys.readouterr().out))
    assert call("synth-stage3", "--scripts", str(tmp_path / "s"), "-o", three) == (0, {"written": 1, "skipped": 2})
    (r,) = files.read_stage(spark, three).collect()
    (plan,) = stages.synthesize(scripts, c).where("accepted").collect()
    assert r["turns"] == plan["turns"] and r["duration_sec"] == plan["duration_sec"]  # the closed form agrees with the audio
    assert sorted(p.name for p in (tmp_path / "3/audio").rglob("*.wav")) == ["short_000000.wav", *(f"turn_{i:03d}.wav" for i in range(4))]
    assert call("validate", "--path", three)[1] == {"ok": True, "checked": 1, "n_errors": 0, "errors": [], "audio_checked": True}
    assert call("inject-overlap", "--stage3", three, "-o", four) == (0, {"written": 1, "skipped": 0})
    assert call("validate", "--subset", "stage4", "--path", four)[1]["ok"]
    (q,) = files.read_stage(spark, four).collect()
    mix, rate = audio.decode((tmp_path / "4" / q["mixed_audio_path"]).read_bytes())
    assert len(mix) / rate == q["duration_sec"] >= r["duration_sec"]
    for t in q["turns"]:
        assert (tmp_path / "4" / t["audio_path"]).read_bytes() == (tmp_path / "3" / t["audio_path"]).read_bytes()
    (tmp_path / "4/audio/short_000000/turn_002.wav").unlink()
    assert call("validate", "--subset", "stage4", "--path", four)[1]["errors"] == ["short_000000: missing turn audio audio/short_000000/turn_002.wav"]


def test_voices_plug_in(spark, scripts, tmp_path):
    """The first attempts are too long; the third lies in the bucket. A voice that never does leaves nothing."""
    c = Config()
    rate = c.synthesis.output_sample_rate
    place = str(tmp_path / "v")
    r = stored(stage_audio.render(scripts.where("conversation_id = 'short_000000'"), c, place, lambda: lambda speaker, text, attempt: np.zeros(rate * (9 - 2 * attempt - (attempt == 2)), np.float32))).first()
    assert r["accepted"] and r["duration_sec"] == 4 * 4 + 0.3 and r["turns"][3]["start_ms"] == 12300
    never = stored(stage_audio.render(scripts, c, str(tmp_path / "n"), lambda: lambda speaker, text, attempt: np.zeros(rate, np.float32)))
    assert never.where("accepted").count() == 0 and never.count() == 3 and not list(tmp_path.glob("n/audio/*"))
    assert list(stage_audio.tagged(lambda text: [len(text)])(1, "abc", 0)) == [8]
    with pytest.raises(Exception, match="no file name"):
        stage_audio.render(scripts.limit(1).withColumn("conversation_id", F.lit("../x")), c, str(tmp_path / "x")).collect()


def test_codec_leaves(spark, tmp_path):
    assert audio.peak_limited([[[1.0, -4.0]]]).tolist() == [0.25, -1.0] and audio.peak_limited([0.5]).tolist() == [0.5] and audio.peak_limited([]).tolist() == []
    assert audio.checked_codes(np.zeros((1, 32, 5)), 32).shape == (32, 5)
    for codes in (np.zeros((2, 32, 5)), np.zeros((31, 5)), np.zeros(5)):
        with pytest.raises(ValueError):
            audio.checked_codes(codes, 32)
    rows = spark.createDataFrame([(None, None, None, "a/b", i, [[i, 2], [3, 4]], 4800) for i in range(5)], "id string, speaker string, text string, split string, idx int, codes array<array<int>>, n_samples long")
    sound = audio.decoded(rows.select(F.col("idx").alias("id"), "codes"), lambda: lambda codes: codes.sum(axis=0) / 4, 24_000).where("id = 1").first()["audio"]
    assert np.allclose(audio.decode(sound)[0], [4 / 6, 1.0], atol=1e-4)
    made = corpus.codec_rows(rows, "d", 24_000)
    assert made.schema.simpleString() == schemas.CODEC_ROW.simpleString()
    files.write_numbered_shards(made, str(tmp_path / "sh"), "source_split", "id", size=2, offset=7)
    back = spark.read.parquet(str(tmp_path / "sh"))
    assert sorted((r["shard"], r["id"], r["split"], r["speaker_id"], r["n_frames"], r["k_codebooks"]) for r in back.collect()) == [(7 + i // 2, f"a_b_{i:09d}", "a_b", "unknown", 2, 2) for i in range(5)]
    assert len(list((tmp_path / "sh").rglob("*.parquet"))) == 3


def test_code_columns(spark):
    x = lambda codes, f: spark.range(1).select(f(F.lit(codes).cast("array<array<int>>")).alias("x")).first()["x"]
    assert x([[1, 2, 3], [4, 5, 6, 7]], tk.frame_major) == [1, 4, 2, 5, 3, 6]
    assert x([], tk.frame_major) == []
    assert x([[5, 6]], lambda c: tk.previous_codes(F.get(c, F.lit(0)))) == [2048, 5]
    rows = spark.createDataFrame([(1, [[1, 2, 3]], 3), (2, [[4]], 1)], "conv_id int, codes array<array<int>>, n_frames int")
    out = {r["conv_id"]: r for r in corpus.collated(rows, F.lit(0), budget=2).collect()}
    assert out[1]["codes"] == [[1, 2]] and out[2]["codes"] == [[4, -100]] and out[2]["code_mask"] == [1, 0]


def test_numbers(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).withColumn("g", F.when(F.col("k") < 900, "hot").otherwise("cold"))
    assert all(r["k"] == r["idx"] for r in ordinal(df, "k").collect())
    assert all(r["idx"] == r["k"] - (900 if r["g"] == "cold" else 0) for r in ordinal_within(df, "g", "k").collect())
    assert ordinal(df.limit(0), "k").count() == 0
    parts = corpus.train_eval(df, "k")
    assert parts.where("part = 'eval'").count() == 50
    shards = corpus.sharded(df, "g", "k", size=500, offset=3).groupBy("g", "shard").count().collect()
    assert sorted((r["g"], r["shard"], r["count"]) for r in shards) == [("cold", 3, 100), ("hot", 3, 500), ("hot", 4, 400)]


def test_numbers_of_wide_rows(spark):
    """The shuffled payload fills several partitions, its keys alone only one."""
    wide = F.concat(*(F.sha2(F.concat(F.col("id").cast("string"), F.lit(f":{i}")), 512) for i in range(4)))
    df = spark.range(40000).select((F.col("id") * 7919 % 40000).alias("k"), wide.alias("text"))
    out = ordinal(df, "k").select("k", "idx", F.length("text").alias("n")).collect()
    assert len(out) == 40000 and all(r["k"] == r["idx"] and r["n"] == 512 for r in out)


def test_numbers_in_a_null_group(spark):
    df = spark.createDataFrame([(0, None), (1, "en"), (2, None), (3, "en"), (4, None)], "k int, g string")
    out = {r["k"]: (r["g"], r["shard"]) for r in corpus.sharded(df, "g", "k", size=2, offset=1).collect()}
    assert out == {0: (None, 1), 1: ("en", 1), 2: (None, 1), 3: ("en", 1), 4: (None, 2)}


def test_generation_resumes(spark, tmp_path):
    c = Config(buckets=[Bucket("short", 5, 4, 6, 12, 20, 16, 28, 55), Bucket("medium", 20, 6, 8, 25, 40, 30, 70, 115)])
    path = str(tmp_path / "scripts")
    assert generation.generate(spark, c, path, limit=7) == {"short": 5, "medium": 2}
    assert generation.generate(spark, c, path, limit=9) == {"short": 5, "medium": 4}
    rows = files.read_scripts(spark, path)
    ids = sorted(r["conversation_id"] for r in rows.collect())
    assert len(set(ids)) == 9 and ids[0] == "medium_000000" and ids[-1] == "short_000004"
    assert validate.report(rows, validate.script_violations(rows, bucket_table(spark, c.buckets)), "scripts")["ok"]
    assert validate.script_violations(rows.unionAll(rows.limit(1)), bucket_table(spark, c.buckets)).count() == 1
    files.write_by_bucket(rows.where("category = 'short'"), ["short", "medium"], str(tmp_path / "by"))
    assert files.read_scripts(spark, str(tmp_path / "by/bucket=medium")).count() == 0 and files.exists(spark, str(tmp_path / "by/bucket=medium"))
    with pytest.raises(RuntimeError):
        generation.generate(spark, c, str(tmp_path / "none"), source=lambda s, b, n: generation.dry_run(s, b, n).withColumn("response", F.lit("nothing")))


def test_completions_retry(spark):
    requests = spark.createDataFrame([(i, f"p{i}") for i in range(4)], "request_id long, prompt string")

    def complete(prompt):
        complete.calls = getattr(complete, "calls", 0) + 1
        if complete.calls == 1:
            raise TimeoutError("once")
        return prompt.upper()

    got = generation.completions(requests, complete, 0, 2, backoff=0.0).collect()
    assert sorted(r["response"] for r in got) == ["P0", "P1", "P2", "P3"]


def test_sampled_topics(spark):
    draw = lambda topics, n, seed=1: {r["request_id"]: r["topics"] for r in generation.sampled_topics(spark.range(40).withColumnRenamed("id", "request_id"), topics, n, seed).collect()}
    many = [f"t{i}" for i in range(12)]
    first = draw(many, 5)
    assert all(len(set(t)) == 5 for t in first.values()) and {x for t in first.values() for x in t} == set(many) and first != draw(many, 5, 2)
    assert all(len(t) == 3 and set(t) <= {"a", "b"} for t in draw(["a", "b"], 3).values())


class _Server(http.server.BaseHTTPRequestHandler):
    """429 at first, then answers; refuses a wrong key."""

    calls: list = []

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        self.calls.append(body)
        status = 400 if self.headers["Authorization"] != "Bearer k" else 429 if len(self.calls) == 1 else 200
        topics = [x.split(". ", 1)[1] for x in body["messages"][0]["content"].splitlines() if x[:1].isdigit()]
        block = "\n".join(f"[S{i % 2 + 1}] {' '.join(['word'] * 10)}." for i in range(4))
        out = json.dumps({"choices": [{"message": {"content": "\n---\n".join([block, "no script", *[block] * (len(topics) - 2)])}}]}).encode()
        self.send_response(status)
        self.end_headers()
        self.wfile.write(out)

    def log_message(self, *a):
        pass


def test_client(spark, tmp_path, monkeypatch, capfd):
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), _Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    c = Config(buckets=[Bucket("short", 7, 4, 6, 12, 20, 16, 28, 55)])
    g = c.generation
    g.base_url, g.model, g.api_key_env, g.api_retry_backoff_sec, g.requests_per_minute, g.conversations_per_request, g.concurrency = f"http://127.0.0.1:{server.server_port}/v1", "m", "TEST_KEY", 0.0, 0, 4, 2
    g.topics, g.progress_every = [f"topic {i}" for i in range(9)], 5
    monkeypatch.delenv("TEST_KEY", raising=False)
    assert client.from_settings(g) is None
    monkeypatch.setenv("TEST_KEY", "bad")
    with pytest.raises(RuntimeError, match="status 400"):
        client.from_settings(g)("1. x")
    _Server.calls.clear()
    monkeypatch.setenv("TEST_KEY", "k")
    path = str(tmp_path / "s")
    assert generation.generate(spark, c, path, source=generation.client_source(c, client.from_settings(g))) == {"short": 7}
    rows = files.read_scripts(spark, path).collect()
    assert len({r["conversation_id"] for r in rows}) == 7 and {r["topic"] for r in rows} <= set(g.topics) and len({r["topic"] for r in rows}) > 1
    assert spark.read.json(f"{path}.manifest").first().asDict() == {"target": 7, "completed": 7, "failed": 0}
    told = capfd.readouterr().err
    assert "accepted 6 of 7; rejected" in told and "completed 6 of 7, 6 in bucket short" in told
    assert all(b["model"] == "m" and b["max_tokens"] == 4096 for b in _Server.calls)
    server.shutdown()


def test_export(spark, tmp_path):
    for i, who in enumerate(("a", "b")):
        d = tmp_path / "prompts" / f"pair_{i}"
        d.mkdir(parents=True)
        (d / "meta.json").write_text(json.dumps({"s1_prompt_transcription": f'He said "{who}"', "s2_prompt_transcription": "", "s1_prompt_wav": "s1.wav", "s2_prompt_wav": "/abs.wav"}))
    prompts = files.read_prompts(spark, str(tmp_path / "prompts"))
    rows = spark.createDataFrame([bad(name=f"c{i}", category="short" if i != 1 else "long") for i in range(3)], schemas.SCRIPT)
    out = corpus.tsv_rows(rows, prompts, "conversation_id").where("category = 'short'")
    files.write_tsv(out.orderBy("idx").drop("idx", "category").coalesce(1), str(tmp_path / "t"))
    lines = next((tmp_path / "t").glob("part*")).read_text().splitlines()
    assert [x.split("\t")[0] for x in lines] == ["c0.wav", "c2.wav"] and all('"He said ""a"""' in x for x in lines)
    assert lines[0].split("\t")[3:5] == [f"{tmp_path}/prompts/pair_0/s1.wav", "/abs.wav"]
    with pytest.raises(ValueError):
        corpus.with_prompts(rows, prompts.limit(0), "conversation_id")


def test_typed_reads(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"conversation_id": "a", "turns": []}\n\n{"conversation_id": 5, "turns": 7}\n')
    assert files.read_scripts(spark, str(tmp_path / "absent")).count() == 0
    with pytest.raises(Exception):
        files.read_scripts(spark, str(tmp_path / "a.jsonl")).collect()
    assert files.bad_records(spark, str(tmp_path / "a.jsonl"), schemas.SCRIPT).count() == 1
    plan = files.upload_plan(files.inventory(spark, str(tmp_path)), "me/repo", "scripts").first()
    assert plan["file_count"] == 1 and plan["total_bytes"] > 0 and files.inventory(spark, str(tmp_path / "absent")).count() == 0


def test_audio(spark):
    rate = 24_000
    x = audio.tone(2400, 0, rate)
    y, r = audio.decode(audio.encode(x, rate))
    assert r == rate and np.abs(x - y).max() < 1e-3
    assert audio.mono(np.zeros((2, 10))).shape == (10,) and audio.mono(np.zeros((10, 2))).shape == (10,)
    with pytest.raises(ValueError):
        audio.strict_mono(np.array([np.nan]))
    assert len(audio.joined([x, x], rate)) == 2 * 2400 + 2400
    both = audio.mix([(0, 100, np.full(2400, 0.5, np.float32)), (50, 150, np.full(2400, 0.5, np.float32))], rate)
    assert len(both) == 3600 and np.allclose(both[[0, 1300, 3000]], [0.5, 0.82, 0.5])
    rows = spark.createDataFrame([(1, 0, 0, 100, 2400, 0), (1, 1, 50, 150, 2400, 1)], "conv_id int, turn int, start_ms long, end_ms long, n long, speaker int").withColumn("audio", audio.voiced(F.col("n"), F.col("speaker"), rate))
    assert audio.mixed(rows).first()["seconds"] == 0.15
    assert rows.select(audio.wav_header(F.col("audio")).alias("h")).first()["h"]["frames"] == 2400
    codes = audio.encoded(rows.select(F.col("turn").alias("id"), "audio").unionAll(spark.createDataFrame([(9, b"no")], "id int, audio binary")), lambda: lambda x, r: [[len(x) % 7]] * 32, rate)
    assert codes.where("error IS NOT NULL").count() == 1 and codes.where("id = 0").first()["n_samples"] == 2400


def test_stream(spark, tmp_path):
    src, ok, no, ck = (str(tmp_path / x) for x in ("in", "ok", "no", "ck"))
    b = bucket_table(spark)
    for k in range(2):
        rows = spark.createDataFrame([bad(name="a"), bad(name=f"b{k}"), bad(GOOD[:3], name=f"c{k}")], schemas.SCRIPT)
        rows.write.mode("append").json(src)
        ingest(spark, src, ok, no, ck, b)
    assert sorted(r["conversation_id"] for r in spark.read.parquet(ok).collect()) == ["a", "b0", "b1"]
    assert spark.read.parquet(no).count() == 2


def test_cli(spark, tmp_path, capsys):
    p = lambda x: str(tmp_path / x)
    call = lambda *a: cli.main(list(a))
    assert call("show-config") == 0
    assert call("generate-dialog-scripts", "-o", p("s"), "--limit", "3", "--dry-run") == 0
    scripts = p("s/dialog_scripts")
    assert call("validate", "--subset", "scripts", "--path", scripts) == 0
    assert call("synth-stage3", "--scripts", scripts, "-o", p("3")) == 0
    assert call("inject-overlap", "--stage3", p("3"), "-o", p("4")) == 0
    assert call("validate", "--subset", "stage4", "--path", p("4")) == 0 and call("validate", "--subset", "stage3", "--path", p("none")) == 1
    assert call("tokenize", "--stage", p("3"), "-o", p("t"), "--mock") == 0
    assert call("assemble-shards", "--tokens", p("t"), "--stage", p("3"), "-o", p("sh")) == 0
    assert call("validate", "--subset", "shards", "--path", p("sh")) == 0
    assert '"written": 3' in capsys.readouterr().out


def test_cli_published_names(spark, tmp_path, capsys):
    p = lambda x: str(tmp_path / x)
    call = lambda *a: cli.main(list(a))
    assert call("generate-zipvoice-dialog-scripts", "-o", p("s"), "--limit", "2", "--dry-run") == 0
    assert call("synth-stage3", "--scripts", p("s/dialog_scripts"), "-o", p("3"), "--mock") == 0 and call("tokenize-mimi", "--stage", p("3"), "-o", p("t"), "--mock") == 0
    assert call("validate", "--subset", "stage4", "--path", p("3"), "--errors", p("e")) == 1
    assert {(r["conversation_id"], r["error"]) for r in spark.read.json(p("e")).collect()} == {(f"short_00000{i}", "missing overlaps") for i in range(2)}


@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("parts", ["1", "8", "50"])
def test_numbers_of_many_rows(spark, adaptive, parts):
    """Exact numbers whatever the partitions, with adaptive execution on and off."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        n = 300_000
        df = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("wide"))
        out = ordinal(df, "k").agg(F.count("*"), F.countDistinct("idx"), F.sum((F.col("k") != F.col("idx")).cast("long"))).first()
        assert tuple(out) == (n, n, 0)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
