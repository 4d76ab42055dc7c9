"""The stages from scripts to training shards, on nested records. Times are closed forms of the stand-in voice, so no audio is needed; any
voice or codec that gives lengths and codes can take its place through talkweave.sources.audio."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkweave.config import Config, bucket_table
from talkweave.functions import text as tx
from talkweave.functions import timeline as tl
from talkweave.functions import tokens as tk
from talkweave.operators import corpus, dialogue
from talkweave.schemas import CONVERSATION
from talkweave.sources import audio, files

Encoder = Callable[[], Callable[[np.ndarray, int], "np.ndarray | list"]]
CODEBOOKS = 16
TURN = "array<struct<speaker: int, text: string, audio_path: string, start_ms: bigint, end_ms: bigint>>"


def _laid(turns: Column, conversation: Column, rate: int) -> Column:
    """Turns with times and paths, one after the other."""

    def step(acc: Column, t: Column) -> Column:
        ms = tl.samples_ms(tl.turn_samples(tx.space_words(t["text"]), rate), rate)
        path = F.format_string("audio/%s/turn_%03d.wav", conversation, F.size(acc["out"]))
        turn = F.struct(F.when(t["speaker"] == "S0", 0).otherwise(1).alias("speaker"), t["text"].alias("text"), path.alias("audio_path"), acc["at"].alias("start_ms"), (acc["at"] + ms).alias("end_ms"))
        return F.struct((acc["at"] + ms + tl.GAP_MS).alias("at"), F.concat(acc["out"], F.array(turn)).alias("out"))

    return F.aggregate(turns, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(TURN).alias("out")), step, lambda acc: acc["out"])


def synthesize(scripts: DataFrame, config: Config, limit: int | None = None) -> DataFrame:
    """Conversations, with ``accepted``: the bucket is known and the duration lies in it. A limit counts scripts before that test."""
    rate = config.synthesis.output_sample_rate
    rows = corpus.first_rows(scripts, limit, "conversation_id") if limit is not None else scripts
    b = bucket_table(scripts.sparkSession, config.buckets).select(F.col("name").alias("b_name"), "duration_min_sec", "duration_max_sec")
    total = F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + tl.turn_samples(tx.space_words(t["text"]), rate)) + F.greatest(F.size("turns") - 1, F.lit(0)) * (rate // 10)
    seconds = total / rate
    out = rows.join(F.broadcast(b), F.col("category") == F.col("b_name"), "left")
    return out.select(
        "conversation_id", "category", F.lit("en").alias("language"), seconds.alias("duration_sec"), F.lit(None).cast("string").alias("script_path"),
        F.format_string("audio/%s.wav", "conversation_id").alias("mixed_audio_path"), _laid(F.col("turns"), F.col("conversation_id"), rate).alias("turns"), F.array().cast(CONVERSATION["overlaps"].dataType).alias("overlaps"),
        ((F.size("turns") > 0) & F.coalesce(seconds.between(F.col("duration_min_sec"), F.col("duration_max_sec")), F.lit(False))).alias("accepted"),
    )


def turn_rows(conversations: DataFrame) -> DataFrame:
    each = conversations.select(F.col("conversation_id").alias("conv_id"), F.posexplode("turns").alias("turn", "t"))
    return each.select("conv_id", "turn", "t.*", (F.col("t.end_ms") - F.col("t.start_ms")).alias("ms"))


def inject_overlaps(conversations: DataFrame, config: Config, seed: int = 13, limit: int | None = None) -> DataFrame:
    """Conversations of three turns or more with one shifted turn and its marker; others are left out."""
    rows = corpus.first_rows(conversations, limit, "conversation_id") if limit is not None else conversations
    o = config.overlap
    plan = dialogue.overlap_plan(turn_rows(rows), seed, o.backchannel_ratio, o.interruption_ratio)
    marker = F.array(F.struct(F.col("turn_a").cast("int").alias("turn_a"), F.col("turn_b").cast("int").alias("turn_b"), "overlap_start_ms", "overlap_end_ms", F.col("kind").alias("type")))
    moved = F.transform(
        "turns",
        lambda t, i: F.when(i == F.col("turn_b"), F.struct(t["speaker"].alias("speaker"), t["text"].alias("text"), t["audio_path"].alias("audio_path"), F.col("new_start").alias("start_ms"), F.col("new_end").alias("end_ms"))).otherwise(t),
    )
    rate = config.synthesis.output_sample_rate
    return rows.join(plan, rows["conversation_id"] == plan["conv_id"]).select(
        "conversation_id", "category", "language", _mixed_samples(moved, F.col("duration_sec"), rate).alias("samples"), "script_path", "mixed_audio_path", moved.alias("turns"), marker.alias("overlaps")
    ).withColumn("duration_sec", F.col("samples") / rate).select(*CONVERSATION.names)


def _mixed_samples(turns: Column, least_sec: Column, rate: int) -> Column:
    ends = F.array_max(F.transform(turns, lambda t: F.floor(t["end_ms"] * rate / 1000)))
    return F.greatest(F.floor(least_sec * rate), ends)


def stand_in_codes(path: str, frames: int, codes: int = tk.CODES) -> np.ndarray:
    """The stand-in of a codec: codes[codebook][frame] drawn by a generator that the audio's path seeds."""
    seed = int(hashlib.sha1(path.encode()).hexdigest()[:8], 16)
    return np.random.default_rng(seed).integers(0, codes, size=(CODEBOOKS, frames))


def tokenize(conversations: DataFrame, config: Config, stage: str, limit: int | None = None, encoder: Encoder | None = None) -> DataFrame:
    """Token records, all codebooks and the first ones for training. ``encoder()`` is called once per task and gives a function from samples and rate to codes[codebook][frame]; it
    hears the mixed audio below ``stage``, one file at a time, and audio that can't be read or encoded stops the job, named. Without one codes are a stand-in, as
    many frames as the recorded duration has, and no audio is read. Conversations without mixed audio have no record."""
    rows = corpus.first_rows(conversations, limit, "conversation_id") if limit is not None else conversations
    rate, codes, root = config.synthesis.output_sample_rate, config.codec.token_count, stage.rstrip("/")
    path = F.format_string("%s/conversations/%s.json", F.lit(root), "conversation_id")
    frames = tk.frame_count(F.rint(F.col("duration_sec") * rate), rate)
    heard = rows.where("mixed_audio_path IS NOT NULL AND mixed_audio_path <> ''").select("conversation_id", path.alias("source_json"), F.col("mixed_audio_path").alias("audio"), frames.alias("frames"))
    place = files.qualified(rows.sparkSession, root) if encoder else ""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = encoder() if encoder else None

        def of(path: str, frames: int) -> list[list[int]]:
            if model is None:
                return stand_in_codes(f"{root}/{path}", frames, codes).tolist()
            try:
                return audio.checked_codes(model(*audio.decode(files.get(place, path))), None).astype(int).tolist()
            except Exception as e:
                raise RuntimeError(f"no codes of {path}: {e}") from e

        for pdf in batches:
            yield pdf[["conversation_id", "source_json"]].assign(codes_full=[of(*r) for r in zip(pdf["audio"], pdf["frames"])])

    out = heard.mapInPandas(run, "conversation_id string, source_json string, codes_full array<array<int>>")
    n = F.size("codes_full")
    k = F.least(F.lit(config.codec.training_codebooks), n)
    return out.select("conversation_id", "source_json", n.alias("codebook_count"), k.alias("training_codebooks"), "codes_full", F.slice("codes_full", F.lit(1), k).alias("codes_training"))


def assemble(tokens: DataFrame, conversations: DataFrame, stage: str | None = None) -> DataFrame:
    """Training sequences, one for each token record, with the conversations of ``stage``. Records are matched by stage, which their
    source_json names, and id (by id alone without a stage); raises where a record has no conversation."""
    named = tokens.select("conversation_id", "source_json", "codes_training")
    keys = ["conversation_id"]
    if stage is not None:
        named = named.withColumn("stage", F.regexp_extract("source_json", "^(.*?)/+conversations/[^/]*$", 1))
        conversations = conversations.withColumn("stage", F.lit(stage.rstrip("/")))
        keys = ["stage", *keys]
    lost = named.join(conversations.select(*keys), keys, "left_anti")
    if n := lost.count():
        some = ", ".join(sorted(str(r["source_json"]) for r in lost.select("source_json").limit(5).collect()))
        raise ValueError(f"{n} token records without a conversation, as {some}")
    return corpus.sequences(named, conversations, keys, "source_json").select("conversation_id", "source_json", "tokens", "loss_mask")
