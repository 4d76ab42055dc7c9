"""Audio files of the stages. A task renders one conversation after the other and writes its files at once, so that no samples cross a
shuffle or the driver, and a worker holds one conversation's sound. Files are moved to their names when complete: a task that runs again
writes the same ones. The folders must be shared by all machines, as any output is."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.config import Config, bucket_table
from talkweave.operators import corpus
from talkweave.schemas import CONVERSATION
from talkweave.sources import audio, files

#: speaker (0 or 1), text and number of the attempt to samples at the output rate. The same call should give the same samples, since a lost
#: task is run again. A task makes its voice once, by a factory.
Voice = Callable[[int, str, int], np.ndarray]
GAP_SEC = 0.1


def stand_in(rate: int) -> Voice:
    """A tone of 2.8 words a second, 0.6 s at least."""
    return lambda speaker, text, attempt: audio.tone(int(max(0.6, max(1, len(text.split())) / 2.8) * rate), speaker, rate)


def tagged(generate: Callable[[str], np.ndarray]) -> Voice:
    """A voice from a model that takes its speaker from a mark before the text."""
    return lambda speaker, text, attempt: np.asarray(generate(f"[S{speaker + 1}] {text}"), np.float32)


def _turn_path(conversation: str, i: int) -> str:
    if not conversation or "/" in conversation or conversation in (".", ".."):
        raise ValueError(f"conversation_id {conversation!r} is no file name")
    return f"audio/{conversation}/turn_{i:03d}.wav"


def render(scripts: DataFrame, config: Config, root: str, voice: Callable[[], Voice] | None = None, limit: int | None = None) -> DataFrame:
    """Writes the audio of scripts below ``root`` and gives the conversations as measured, with ``accepted``. A conversation outside its bucket's
    duration is voiced again, ``duration_regen_limit`` times at most (the stand-in always says the same, so once), and then not accepted;
    nor is one of an unknown bucket or without turns, which writes nothing. Run it once: evaluating it writes the files. A limit takes the
    first scripts by id."""
    rate, tries = config.synthesis.output_sample_rate, 1 if voice is None else config.synthesis.duration_regen_limit + 1
    make = voice or (lambda: stand_in(rate))
    rows = corpus.first_rows(scripts, limit, "conversation_id") if limit is not None else scripts
    b = F.broadcast(bucket_table(scripts.sparkSession, config.buckets).select(F.col("name").alias("b_name"), "duration_min_sec", "duration_max_sec"))
    place = files.qualified(scripts.sparkSession, root)

    def one(say: Voice, name: str, turns: list, least: float, most: float) -> tuple[float, list, bool]:
        out, seconds = [], 0.0
        for attempt in range(tries if least == least and len(turns) else 0):
            sound = [audio.mono(say(int(t["speaker"] != "S0"), t["text"] or "", attempt)) for t in turns]
            seconds = len(whole := audio.joined(sound, rate, GAP_SEC)) / rate
            if least <= seconds <= most or attempt + 1 == tries:
                break
        else:
            return 0.0, [], False
        at = 0
        for i, (t, x) in enumerate(zip(turns, sound)):
            ms = round(len(x) / rate * 1000)
            path = _turn_path(name, i)
            out.append({"speaker": int(t["speaker"] != "S0"), "text": t["text"], "audio_path": path, "start_ms": at, "end_ms": at + ms})
            at += ms + int(GAP_SEC * 1000)
            if least <= seconds <= most:
                files.put(place, path, audio.encode(x, rate))
        if least <= seconds <= most:
            files.put(place, f"audio/{name}.wav", audio.encode(whole, rate))
        return seconds, out, bool(least <= seconds <= most)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        say = make()
        for pdf in batches:
            done = [one(say, *r) for r in zip(pdf["conversation_id"], pdf["turns"], pdf["duration_min_sec"].astype(float), pdf["duration_max_sec"].astype(float))]
            yield pdf[["conversation_id", "category"]].assign(duration_sec=[d[0] for d in done], turns=[d[1] for d in done], accepted=[d[2] for d in done])

    turns = F.coalesce("turns", F.array().cast(scripts.schema["turns"].dataType)).alias("turns")
    known = rows.join(b, F.col("category") == F.col("b_name"), "left").select("conversation_id", "category", turns, "duration_min_sec", "duration_max_sec")
    kind = CONVERSATION["turns"].dataType.simpleString()
    made = known.mapInPandas(run, f"conversation_id string, category string, duration_sec double, turns {kind}, accepted boolean")
    return made.select(
        "conversation_id", "category", F.lit("en").alias("language"), "duration_sec", F.lit(None).cast("string").alias("script_path"),
        F.format_string("audio/%s.wav", "conversation_id").alias("mixed_audio_path"), "turns", F.array().cast(CONVERSATION["overlaps"].dataType).alias("overlaps"), "accepted",
    )


def remix(conversations: DataFrame, config: Config, source: str, root: str) -> DataFrame:
    """Copies the turn audio of shifted conversations from ``source`` to ``root``, mixes it anew at their times, and gives the conversations with
    their new paths and measured duration (at least the one they had). Missing audio, or turns of different rates, stop the job. Run it once."""
    spark = conversations.sparkSession
    there, place = files.qualified(spark, source), files.qualified(spark, root)
    attenuation = config.overlap.attenuation

    def one(name: str, turns: list, least: float) -> tuple[float, list]:
        out, parts, rates = [], [], set()
        for i, t in enumerate(turns):
            content = files.get(there, t["audio_path"])
            x, rate = audio.decode(content)
            rates.add(rate)
            path = _turn_path(name, i)
            files.put(place, path, content)
            parts.append((t["start_ms"], t["end_ms"], x))
            out.append({"speaker": t["speaker"], "text": t["text"], "audio_path": path, "start_ms": t["start_ms"], "end_ms": t["end_ms"]})
        if len(rates) != 1:
            raise ValueError(f"{name}: all turn audio must have the same sample rate")
        whole = audio.mix(parts, rate, attenuation, least)
        files.put(place, f"audio/{name}.wav", audio.encode(whole, rate))
        return len(whole) / rate, out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            done = [one(*r) for r in zip(pdf["conversation_id"], pdf["turns"], pdf["duration_sec"])]
            mixed = "audio/" + pdf["conversation_id"] + ".wav"
            yield pdf.assign(duration_sec=[d[0] for d in done], turns=[d[1] for d in done], mixed_audio_path=mixed)

    return conversations.select(*CONVERSATION.names).mapInPandas(run, CONVERSATION)


def has_audio(spark: SparkSession, root: str) -> bool:
    return files.exists(spark, f"{root.rstrip('/')}/audio")
