"""WAV as columns: the leaves that need array code, in Arrow batches. A conversation's mix is one group: its size is that of
one recording."""

from __future__ import annotations

import io
import struct
import wave
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def decode(content: bytes) -> tuple[np.ndarray, int]:
    """16-bit PCM as mono float32, and its rate."""
    with wave.open(io.BytesIO(content)) as w:
        x = np.frombuffer(w.readframes(w.getnframes()), "<i2").reshape(-1, w.getnchannels())
        return mono(x.astype(np.float32) / 32768), w.getframerate()


def wav_head(frames: int, rate: int) -> bytes:
    """The header that so many mono frames need."""
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + 2 * frames, b"WAVE", b"fmt ", 16, 1, 1, rate, 2 * rate, 2, 16, b"data", 2 * frames)


def encode(x: np.ndarray, rate: int) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(np.clip(np.rint(mono(x) * 32767), -32768, 32767).astype("<i2").tobytes())
    return out.getvalue()


def mono(x: np.ndarray, channels_first: int = 2, clip: bool = True) -> np.ndarray:
    """The mean of the channels; an array of few rows and more columns has its channels first."""
    x = np.asarray(x, np.float32)
    if x.ndim == 2:
        x = x.mean(axis=0 if x.shape[0] <= channels_first and x.shape[1] > x.shape[0] else 1)
    return np.clip(x, -1, 1) if clip else x


def strict_mono(x: np.ndarray) -> np.ndarray:
    """For corpora: up to eight channels first, no clipping; an error unless one-dimensional and finite."""
    x = mono(x, channels_first=8, clip=False)
    if x.ndim != 1 or not np.isfinite(x).all():
        raise ValueError("audio must be one-dimensional and finite")
    return x


def tone(samples: int, speaker: int, rate: int) -> np.ndarray:
    """The stand-in voice: a soft sine that rises at its start; each speaker has a pitch."""
    t = np.arange(samples, dtype=np.float32) / rate
    ramp = np.minimum(1, np.linspace(0, 1, samples, dtype=np.float32) * 10) if samples else t
    return (0.08 * np.sin(2 * np.pi * (220 if speaker == 0 else 330) * t) * ramp).astype(np.float32)


class Layout(NamedTuple):
    """Where a WAV file's samples are: bytes before them, frames, channels, rate."""

    start: int
    frames: int
    channels: int
    rate: int


def wav_layout(f) -> Layout:
    """The layout of 16-bit PCM in an open file, from its chunk headers; ValueError where it is none. A length that goes beyond the file is cut to what is there."""
    head = f.read(12)
    if head[:4] != b"RIFF" or head[8:12] != b"WAVE":
        raise ValueError("no WAV file")
    at, channels, rate = 12, 0, 0
    while len(head := f.read(8)) == 8:
        size, at = int.from_bytes(head[4:], "little"), at + 8
        if head[:4] == b"fmt ":
            kind, channels, rate, _, _, bits = struct.unpack("<HHIIHH", f.read(16))
            if kind not in (1, 0xFFFE) or bits != 16 or not channels or not rate:
                raise ValueError("no 16-bit PCM")
        elif head[:4] == b"data":
            if not rate:
                break
            f.seek(0, 2)
            return Layout(at, min(size, f.tell() - at) // (2 * channels), channels, rate)
        at += size + size % 2
        f.seek(at)
    raise ValueError("no WAV file")


def wav_header(content: Column) -> Column:
    """struct<frames, rate, seconds> from the header of WAV bytes."""

    @F.pandas_udf("struct<frames: bigint, rate: int, seconds: double>")
    def read(content: pd.Series) -> pd.DataFrame:
        rows = []
        for c in content:
            with wave.open(io.BytesIO(c)) as w:
                rows.append((w.getnframes(), w.getframerate(), w.getnframes() / w.getframerate()))
        return pd.DataFrame(rows, columns=["frames", "rate", "seconds"])

    return read(content)


def voiced(samples: Column, speaker: Column, rate: int) -> Column:
    """The stand-in voice's WAV bytes."""

    @F.pandas_udf("binary")
    def make(n: pd.Series, s: pd.Series) -> pd.Series:
        return pd.Series([encode(tone(int(a), int(b), rate), rate) for a, b in zip(n, s)])

    return make(samples, speaker)


def mix(parts: list[tuple[int, int, np.ndarray]], rate: int, attenuation: float = 0.82, least_sec: float = 0.0) -> np.ndarray:
    """(start_ms, end_ms, samples) laid on one line; where turns meet, both are softened."""
    total = max(int(least_sec * rate), max((int(end * rate / 1000) for _, end, _ in parts), default=0))
    out, taken = np.zeros(total, np.float32), np.zeros(total, bool)
    for start_ms, _, x in parts:
        at = int(start_ms * rate / 1000)
        x = x[: max(0, total - at)]
        here = slice(at, at + len(x))
        both = taken[here].copy()
        out[here] = np.where(both, (out[here] + x) * np.float32(attenuation), out[here] + x)
        taken[here] = True
    return np.clip(out, -1, 1)


def mixed(turns: DataFrame, rate: int = 24_000, attenuation: float = 0.82) -> DataFrame:
    """turns: conv_id, turn, start_ms, end_ms, audio (WAV). Gives conv_id, audio, seconds."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("turn")
        sound = [decode(a) for a in pdf["audio"]]
        if {r for _, r in sound} - {rate}:
            raise ValueError("all turn audio must have the same sample rate")
        x = mix([(s, e, a) for s, e, (a, _) in zip(pdf["start_ms"], pdf["end_ms"], sound)], rate, attenuation)
        return pd.DataFrame({"conv_id": [key[0]], "audio": [encode(x, rate)], "seconds": [len(x) / rate]})

    return turns.select("conv_id", "turn", "start_ms", "end_ms", "audio").groupBy("conv_id").applyInPandas(run, f"conv_id {kind}, audio binary, seconds double")


def joined(chunks: list[np.ndarray], rate: int, gap_sec: float = 0.1) -> np.ndarray:
    """Chunks with silence between."""
    silence = np.zeros(int(gap_sec * rate), np.float32)
    return np.concatenate([p for i, c in enumerate(chunks) for p in ((silence, c) if i else (c,))]) if chunks else silence[:0]


def peak_limited(x: np.ndarray) -> np.ndarray:
    """Decoded samples, one-dimensional, divided by their peak where it is over 1."""
    x = np.asarray(x, np.float32)
    while x.ndim > 1:
        x = x[0]
    peak = float(np.abs(x).max()) if x.size else 0.0
    return x / np.float32(peak) if peak > 1 else x


def checked_codes(codes, codebooks: int | None) -> np.ndarray:
    """codes[codebook][frame], from that or from a batch of one; an error where the number of codebooks isn't ``codebooks``."""
    codes = np.asarray(codes)
    shape = codes.shape
    if codes.ndim == 3 and shape[0] == 1:
        codes = codes[0]
    if codes.ndim != 2 or (codebooks is not None and codes.shape[0] != codebooks):
        raise ValueError(f"codes have shape {shape}")
    return codes


def decoded(rows: DataFrame, decoder, rate: int) -> DataFrame:
    """id, codes to id, audio (WAV) by any codec: ``decoder()`` is called once per task and gives a function from codes[codebook][frame] to samples."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = decoder()
        for pdf in frames:
            for i, codes in zip(pdf["id"], pdf["codes"]):
                yield pd.DataFrame({"id": [i], "audio": [encode(peak_limited(model(np.array([list(c) for c in codes]))), rate)]})

    return rows.select("id", "codes").mapInPandas(run, f"id {rows.schema['id'].dataType.simpleString()}, audio binary")


def encoded(audio: DataFrame, encoder, sample_rate: int, codebooks: int | None = None) -> DataFrame:
    """id, audio (WAV) to id, codes, n_samples by any codec: ``encoder()`` is called once per task and gives a function from samples and
    rate to codes[codebook][frame], or a batch of one such; their shape is checked. Rows that fail are returned with the error, not dropped unseen."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = encoder()
        for pdf in frames:
            rows = []
            for i, content in zip(pdf["id"], pdf["audio"]):
                try:
                    x, rate = decode(content)
                    rows.append((i, [list(map(int, c)) for c in checked_codes(model(strict_mono(x), rate), codebooks)], len(x), None))
                except Exception as e:  # noqa: BLE001  any failure of a model becomes the row's error
                    rows.append((i, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["id", "codes", "n_samples", "error"])

    kind = audio.schema["id"].dataType.simpleString()
    return audio.select("id", "audio").mapInPandas(run, f"id {kind}, codes array<array<int>>, n_samples bigint, error string")
