import pytest
from pyspark.sql import functions as F

from talkweave.config import Config, bucket_table, load_config
from talkweave.functions import text as tx
from talkweave.operators.rules import judged_scripts
from talkweave.schemas import SCRIPT

LINES = ["Hey, are you free tonight after work for a quick movie?", "Yeah, I think so, as long as it starts after dinner.", "Perfect, there is a new one at seven near the station.", "Sure, that works for me, send me the ticket link."]
GOOD = [("S0", LINES[0]), ("S1", LINES[1]), ("S0", LINES[2]), ("S1", LINES[3])]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "raw, want",
    [
        (": Perfect! I'll book the cabin. (checks list) [laugh]", "Perfect! I'll book the cabin."), ("Will you be free after work", "Will you be free after work?"),
        ("Sounds good Will you be free after work", "Sounds good Will you be free after work."), ("I will reserve a table", "I will reserve a table."), ("Are you free?", "Are you free?"),
        ("(x)", ""), ("a (b (c) d) e", "a d) e."), ("[] x", "[] x."), ("：ok", "ok."), ("— hi  there [S1] keep [sigh]", "hi there [S1] keep."),
    ],
)
def test_sanitize(spark, raw, want):
    assert one(spark, tx.sanitize(F.lit(raw))) == want


def test_parse(spark):
    raw = "[S1]: Hey, are you free tonight? (smiles) [laugh]\n[S2]: Yeah, I am free after dinner. [sigh]\nstray\n\n[S0] ok\n --- \n\n---\n[S2] Bye"
    blocks = one(spark, F.transform(tx.blocks(F.lit(raw)), tx.parse_turns))
    assert [[tuple(t) for t in b] for b in blocks] == [[("S0", "Hey, are you free tonight?"), ("S1", "Yeah, I am free after dinner."), ("S0", "ok.")], [("S1", "Bye.")]]
    assert one(spark, tx.blocks(F.lit(" --- \n"))) is not None


def test_counts(spark):
    rows = spark.createDataFrame([("a", "short", "t", GOOD, None)], SCRIPT)
    r = rows.select(tx.script_words(F.col("turns")).alias("w"), tx.script_estimate(F.col("turns")).alias("e"), tx.linear(F.col("turns")).alias("l")).first()
    assert r["w"] == 43 and abs(r["e"] - 43 / 2.6) < 1e-9 and r["l"].startswith("[S1] Hey") and "[S2] Yeah" in r["l"]


def bad(turns=GOOD, category="short", seconds=16.0, name="x"):
    return (name, category, "t", turns, seconds)


@pytest.mark.parametrize(
    "row, want",
    [
        (bad(), None), (bad(GOOD[:3]), "has 3 turns"), (bad([("S0", "Hi there."), ("S1", "Hi there.")] * 2), "has 8 words"), (bad([GOOD[0], ("S1", LINES[1] + " (laughs)."), *GOOD[2:]]), "contains stage directions"),
        (bad([*GOOD[:2], ("S0", LINES[2][:-1]), GOOD[3]]), "missing terminal"), (bad([("S0", LINES[0][:-1]), ("S1", LINES[1] + " (x)."), *GOOD[2:]]), "missing terminal"), (bad(seconds=31.0), "outside prompt"),
        (bad(seconds=None), None), (bad(category="other"), "unknown category"), (bad([GOOD[0], ("S0", LINES[1]), *GOOD[2:]]), "alternate"), (bad([]), "has 0 turns"),
    ],
)
def test_first_reason(spark, row, want):
    reason = judged_scripts(spark.createDataFrame([row], SCRIPT), bucket_table(spark)).first()["reason"]
    assert reason == want if want is None else want in reason


def test_small_functions(spark):
    assert one(spark, tx.short_reason(F.lit("id: too " + "long" * 50))).endswith("...") and len(one(spark, tx.short_reason(F.lit("a: " + "b" * 200)))) == 140
    assert one(spark, tx.next_mark(F.lit(501), 500)) == 1000 and one(spark, tx.next_mark(F.lit(5), 0)) == 0
    assert one(spark, tx.row_id(F.lit(None).cast("string"), F.lit("a/b.c-d"), F.lit(7))) == "a_b_c_d_000000007"
    assert one(spark, tx.relative_path(F.lit("/a/b/c.wav"), "/a")) == "b/c.wav" and one(spark, tx.relative_path(F.lit("/x/c.wav"), "/a")) == "/x/c.wav"
    assert one(spark, tx.prompt(F.lit(" hi "))) == "<speech_text> hi\n<audio_codes>"
    assert one(spark, tx.beside(F.lit("file:///p/pair/meta.json"), F.lit("s1.wav"))) == "/p/pair/s1.wav"


def test_config(tmp_path):
    c = Config()
    assert sum(b.count for b in c.buckets) == 50_000 and round(sum(b.count * b.duration_avg_sec for b in c.buckets) / 3600) == 449
    p = tmp_path / "c.toml"
    p.write_text("[overlap]\nattenuation = 0.5\n[codec]\ntraining_codebooks = 4\n")
    assert load_config(p).overlap.attenuation == 0.5 and load_config(p).codec.training_codebooks == 4 and len(load_config(p).buckets) == 4
    with pytest.raises(ValueError):
        load_config(tmp_path / "c.yaml")


def test_published_settings(tmp_path):
    """Every published name is taken, and an unknown one is an error."""
    p = tmp_path / "c.toml"
    p.write_text(
        'output_dir = "out"\n[script_generation]\nbase_url = "http://x"\nmodel = "m"\napi_retries = 2\napi_timeout_sec = 9\napi_retry_backoff_sec = 1\nprogress_every = 7\n'
        '[dia]\nsample_rate = 8000\n[overlap]\noverlap_attenuation = 0.4\ntarget_hours = 3.0\n[mimi]\ntoken_count = 64\n[huggingface]\nrepo_env = "R"\n'
    )
    c = load_config(p)
    g = c.generation
    assert (c.output_dir, g.base_url, g.model, g.api_retries, g.api_timeout_sec, g.api_retry_backoff_sec, g.progress_every) == ("out", "http://x", "m", 2, 9, 1, 7)
    assert (c.synthesis.sample_rate, c.overlap.overlap_attenuation, c.overlap.target_hours, c.codec.token_count, c.hub.repo_env) == (8000, 0.4, 3.0, 64, "R")
    assert list(c.as_dict()) == ["output_dir", "buckets", "script_generation", "dia", "overlap", "mimi", "huggingface"] and load_config(None).hub.repo_env == "HF_DATASET_REPO"
    for text in ("[mimi]\ntoken_counts = 1\n", "[other]\nx = 1\n"):
        p.write_text(text)
        with pytest.raises(ValueError, match="unknown"):
            load_config(p)
