"""Long recordings in pieces: reading with resampling by byte ranges, mixing by stretches of time, augmentation by overlap-add. No task holds a whole recording, and samples
of a recording of hours are spread over many."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from talkweave.sources import audio, files

# --- resampling


class Resampler:
    """From one rate to another by a polyphase filter: a windowed sinc, ``half`` zero crossings to each side. An output sample depends on its place and the input around it only, so
    stretches computed apart are equal to the whole."""

    def __init__(self, rate_in: int, rate_out: int, half: int = 24):
        g = math.gcd(rate_in, rate_out)
        self.up, self.down = rate_out // g, rate_in // g
        cut = min(1.0, self.up / self.down)
        self.reach = math.ceil(half / cut)  # input samples to each side
        k = np.arange(1 - self.reach, self.reach + 1)
        u = np.arange(self.up)[:, None] / self.up - k  # distance of each tap, by phase
        window = np.where(np.abs(u) < half / cut, 0.5 + 0.5 * np.cos(np.pi * u * cut / half), 0)
        taps = cut * np.sinc(cut * u) * window
        self.taps = taps / taps.sum(axis=1, keepdims=True)

    def length(self, n: int) -> int:
        """Output samples of n input samples."""
        return -(-n * self.up // self.down)

    def needs(self, first: int, count: int) -> tuple[int, int]:
        """The input samples, from and to, that output samples depend on; they may go beyond the recording."""
        return first * self.down // self.up + 1 - self.reach, (first + count - 1) * self.down // self.up + self.reach + 1

    def samples(self, x: np.ndarray, first: int, count: int, block: int = 1 << 14) -> np.ndarray:
        """Output samples from ``first`` on; x: what they need, silence beyond the recording."""
        begin, _ = self.needs(first, count)
        if self.up == self.down:
            return np.asarray(x[-begin + first : -begin + first + count], np.float64)
        out = np.empty(count)
        for at in range(0, count, block):
            n = np.arange(first + at, min(first + at + block, first + count), dtype=np.int64)
            base = n * self.down // self.up + 1 - self.reach - begin
            out[at : at + len(n)] = (x[base[:, None] + np.arange(2 * self.reach)] * self.taps[n * self.down % self.up]).sum(axis=1)
        return out


def read_frames(store: fs.FileSystem, path: str, at: audio.Layout, begin: int, end: int) -> np.ndarray:
    """Frames of a WAV file as mono samples, by their byte range; silence before and after the recording."""
    a, b = max(0, begin), min(at.frames, end)
    out = np.zeros(end - begin, np.float32)
    if b > a:
        with store.open_input_file(path) as f:
            f.seek(at.start + 2 * at.channels * a)
            x = np.frombuffer(f.read(2 * at.channels * (b - a)), "<i2").reshape(-1, at.channels)
        out[a - begin : a - begin + len(x)] = np.clip((x.astype(np.float32) / 32768).mean(axis=1), -1, 1)
    return out


class _Range(InputPartition):
    def __init__(self, path: str, first: int, count: int):
        self.path, self.first, self.count = path, first, count


class _WavReader(DataSourceReader):
    def __init__(self, options: dict):
        self.uri = options["path"]
        self.rate = int(options["rate"])
        self.chunk = int(options.get("chunk", 1 << 18))
        self.pieces = int(options.get("chunksperpartition", 16))

    def _store(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.uri)

    def _layout(self, store: fs.FileSystem, path: str) -> audio.Layout:
        with store.open_input_file(path) as f:
            try:
                return audio.wav_layout(f)
            except ValueError as e:
                raise ValueError(f"{path}: {e}") from e

    def partitions(self) -> list[InputPartition]:
        """Files are listed here and only their headers read; a partition is a stretch of one file."""
        store, base = self._store()
        info = store.get_file_info(base)
        listed = [info] if info.type == fs.FileType.File else [x for x in store.get_file_info(fs.FileSelector(base, recursive=True)) if x.type == fs.FileType.File and x.path.endswith(".wav")]
        out = []
        for x in sorted(listed, key=lambda x: x.path):
            at = self._layout(store, x.path)
            n = Resampler(at.rate, self.rate).length(at.frames)
            step = self.chunk * self.pieces
            out += [_Range(x.path, first, min(step, n - first)) for first in range(0, max(n, 1), step)]
        return out or [_Range("", 0, 0)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        if not partition.count:
            return
        store, _ = self._store()
        at = self._layout(store, partition.path)
        filter_ = Resampler(at.rate, self.rate)
        for first in range(partition.first, partition.first + partition.count, self.chunk):
            count = min(self.chunk, partition.first + partition.count - first)
            x = filter_.samples(read_frames(store, partition.path, at, *filter_.needs(first, count)), first, count)
            yield pa.RecordBatch.from_arrays(
                [pa.array([partition.path]), pa.array([first // self.chunk], pa.int64()), pa.array([first], pa.int64()), pa.array([self.rate], pa.int32()), pa.array([x.astype(np.float32)], pa.list_(pa.float32()))],
                ["path", "chunk", "start", "rate", "samples"],
            )


class WavSource(DataSource):
    """spark.read.format("talkweave_wav").option("rate", 24000).load(folder): chunks of all WAV files below a folder, mono, at that rate. Options: chunk (output samples in a row),
    chunksPerPartition."""

    @classmethod
    def name(cls) -> str:
        return "talkweave_wav"

    def schema(self) -> str:
        return "path string, chunk long, start long, rate int, samples array<float>"

    def reader(self, schema) -> DataSourceReader:
        return _WavReader(dict(self.options))


def read_audio(spark: SparkSession, path: str, rate: int, chunk: int = 1 << 18, chunks_per_partition: int = 16) -> DataFrame:
    """path, chunk, start, rate and samples of all WAV files at a path, resampled. Rows of one chunk each, so a recording of hours is many rows."""
    spark.dataSource.register(WavSource)
    return spark.read.format("talkweave_wav").option("rate", rate).option("chunk", chunk).option("chunksPerPartition", chunks_per_partition).load(files.qualified(spark, path))


# --- mixing


def turn_lengths(turns: DataFrame, root: str) -> DataFrame:
    """Adds rate and frames of each turn's WAV file (audio_path below root), from its header."""
    place = files.qualified(turns.sparkSession, root)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = fs.FileSystem.from_uri(place)
        for pdf in batches:
            found = []
            for path in pdf["audio_path"]:
                with store.open_input_file(f"{base}/{path}") as f:
                    found.append(audio.wav_layout(f))
            yield pdf.assign(rate=[x.rate for x in found], frames=[x.frames for x in found])

    kind = turns.schema["conv_id"].dataType.simpleString()
    return turns.select("conv_id", "turn", "audio_path", F.col("start_ms").cast("long"), F.col("end_ms").cast("long")).mapInPandas(run, f"conv_id {kind}, turn long, audio_path string, start_ms long, end_ms long, rate int, frames long")


def mixed_chunks(turns: DataFrame, root: str, rate: int = 24_000, attenuation: float = 0.82, least: DataFrame | None = None, chunk: int = 1 << 20) -> DataFrame:
    """turns: conv_id, turn, start_ms, end_ms, audio_path; least: conv_id and least_sec of recordings that may not get shorter. Gives conv_id, chunk, total (samples of the whole recording) and
    pcm, the mix as 16-bit samples, in chunks. Each chunk is mixed by itself, from the turns that reach into it in their order, of which only the bytes
    that it needs are read; only places and names of turns cross the shuffle. What audio.mix gives for the whole, byte for byte."""
    known = turn_lengths(turns, root)
    wrong = F.raise_error(F.concat(F.lit("all turn audio must have the same sample rate: "), "audio_path")).cast("boolean")
    known = known.where(F.when(F.col("rate") == rate, F.lit(True)).otherwise(wrong))
    sample = lambda ms: F.floor(F.col(ms) * rate / 1000)
    ends = known.groupBy("conv_id").agg(F.max(sample("end_ms")).alias("total"))
    if least is not None:
        ends = ends.join(least.select("conv_id", "least_sec"), "conv_id", "left").select("conv_id", F.greatest("total", F.coalesce(F.floor(F.col("least_sec") * rate), F.lit(0))).alias("total"))
    number = lambda x: F.floor(x / chunk)
    every = ends.where("total > 0").select("conv_id", "total", F.explode(F.sequence(F.lit(0).cast("long"), number(F.col("total") - 1))).alias("chunk"))
    at, length = F.col("at"), F.col("frames")
    laid = known.withColumn("at", sample("start_ms")).where("frames > 0").select("conv_id", "turn", "audio_path", "at", F.explode(F.sequence(number(at), number(at + length - 1))).alias("chunk"))
    parts = laid.groupBy("conv_id", "chunk").agg(F.array_sort(F.collect_list(F.struct("turn", "at", "audio_path"))).alias("parts"))
    place = files.qualified(turns.sparkSession, root)
    weight = np.float32(attenuation)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = fs.FileSystem.from_uri(place)
        for pdf in batches:
            for i, k, total, turns_ in zip(pdf["conv_id"], pdf["chunk"], pdf["total"], pdf["parts"]):
                begin, end = int(k) * chunk, min(int(k + 1) * chunk, int(total))
                out, taken = np.zeros(end - begin, np.float32), np.zeros(end - begin, bool)
                for t in turns_ if turns_ is not None else ():
                    path = f"{base}/{t['audio_path']}"
                    with store.open_input_file(path) as f:
                        layout = audio.wav_layout(f)
                    a, b = max(begin, t["at"]), min(end, t["at"] + layout.frames)
                    if b > a:
                        x = read_frames(store, path, layout, a - t["at"], b - t["at"])
                        here = slice(a - begin, b - begin)
                        out[here] = np.where(taken[here], (out[here] + x) * weight, out[here] + x)
                        taken[here] = True
                pcm = np.clip(np.rint(np.clip(out, -1, 1) * 32767), -32768, 32767).astype("<i2").tobytes()
                yield pd.DataFrame({"conv_id": [i], "chunk": [k], "total": [total], "pcm": [pcm]})

    kind = turns.schema["conv_id"].dataType.simpleString()
    # one conversation's chunks go to many tasks
    return every.join(parts, ["conv_id", "chunk"], "left").select("conv_id", "chunk", "total", "parts").mapInPandas(run, f"conv_id {kind}, chunk long, total long, pcm binary")


def write_mixes(chunks: DataFrame, root: str, rate: int = 24_000) -> DataFrame:
    """Writes audio/<conv_id>.wav below root from what mixed_chunks gives; conv_id and seconds. A recording's chunks pass through one task in order, one after the other, into its file, which
    gets its name when complete. Evaluating it writes the files."""
    place = files.qualified(chunks.sparkSession, root)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, writer, total = None, None, 0
        for pdf in batches:
            for i, n, pcm in zip(pdf["conv_id"], pdf["total"], pdf["pcm"]):
                if i != here:
                    if writer:
                        writer.finish()
                        yield pd.DataFrame({"conv_id": [here], "seconds": [total / rate]})
                    here, total, writer = i, int(n), files.Draft(place, f"audio/{i}.wav")
                    writer.write(audio.wav_head(total, rate))
                writer.write(bytes(pcm))
        if writer:
            writer.finish()
            yield pd.DataFrame({"conv_id": [here], "seconds": [total / rate]})

    kind = chunks.schema["conv_id"].dataType.simpleString()
    return chunks.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").select("conv_id", "total", "pcm").mapInPandas(run, f"conv_id {kind}, seconds double")


# --- augmentation


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Room:
    """What happens to one recording, drawn from seed and id only: gains of both channels, a shift of each, the room's response, how loud the assistant comes back in the user's
    microphone and when, and the noise."""

    def __init__(self, seed: int, key: str, rate: int, echo: float = 0.2, reverb_sec: float = 0.12, noise: float = 0.003, gain_db: float = 6.0, jitter_ms: float = 15.0):
        self.key = int.from_bytes(hashlib.sha1(f"{seed}:{key}".encode()).digest()[:8], "little")
        u = self.uniform(0, 8)
        self.gain = {c: float(10 ** ((2 * x - 1) * gain_db / 20)) for c, x in zip(("user", "assistant"), u)}
        self.shift = {c: int(x * jitter_ms * rate / 1000) for c, x in zip(("user", "assistant"), u[2:])}
        self.noise = noise * float(u[4])
        n = max(1, int(reverb_sec * rate * (0.5 + 0.5 * u[5])))
        tail = (2 * self.uniform(1 << 20, n) - 1) * np.exp(-6.9 * np.arange(n) / n) * 0.1
        self.room = np.concatenate(([1.0], tail[1:]))
        late = int(rate * (0.02 + 0.08 * u[6]))
        self.echo = np.concatenate((np.zeros(late), self.room * (echo * float(u[7]))))

    def uniform(self, first: int, n: int) -> np.ndarray:
        """Numbers in [0, 1) by their place."""
        with np.errstate(over="ignore"):
            i = np.arange(first, first + n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(self.key)
            return (_mix64(i) >> np.uint64(11)) / float(1 << 53)

    def response(self, source: str, target: str) -> np.ndarray:
        """How a channel is heard in a channel; empty if it isn't."""
        if source == target:
            return np.concatenate((np.zeros(self.shift[source]), self.room * self.gain[source]))
        if source == "assistant":
            return np.concatenate((np.zeros(self.shift[source]), self.echo * self.gain["user"]))
        return np.empty(0)

    def hiss(self, target: str, first: int, n: int) -> np.ndarray:
        base = (1 << 40) * (1 + (target == "user")) + 4 * first
        return self.noise * (self.uniform(base, 4 * n).reshape(-1, 4).sum(axis=1) - 2) * math.sqrt(3)


def convolved(x: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Linear convolution by FFT."""
    n = len(x) + len(h) - 1
    size = 1 << (n - 1).bit_length()
    return np.fft.irfft(np.fft.rfft(x, size) * np.fft.rfft(h, size), size)[:n]


def augmented(chunks: DataFrame, rate: int, chunk: int, seed: int = 13, **room: float) -> DataFrame:
    """chunks: id, channel (user or assistant), chunk (number) and samples, ``chunk`` of them in each but a recording's last. The same with echo of the assistant in the user's channel, reverb,
    noise, gain and a shift of each channel, as long as before.

    Overlap-add: a chunk is convolved by itself, and what reaches beyond it, the tail, is added where it belongs, by number of chunk; so a recording's chunks are spread over all tasks. Sums are
    made in the order of the chunks that they come from. An id whose channels differ in length keeps each as long as it was; null samples count as an empty chunk."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i, channel, k, samples in zip(pdf["id"], pdf["channel"], pdf["chunk"], pdf["samples"]):
                here = Room(seed, str(i), rate, **room)
                x = np.asarray(samples if samples is not None else [], np.float64)
                yield pd.DataFrame({"id": [i], "channel": [channel], "chunk": [k], "source": [-1], "n": [len(x)], "part": [here.hiss(channel, int(k) * chunk, len(x))]})
                for target in ("user", "assistant"):
                    h = here.response(channel, target)
                    if not len(h) or not len(x):
                        continue
                    y = convolved(x, h)
                    for at in range(0, len(y), chunk):
                        yield pd.DataFrame({"id": [i], "channel": [target], "chunk": [k + at // chunk], "source": [2 * k + (channel != target)], "n": [None], "part": [y[at : at + chunk]]}).astype({"n": "Int64"})

    kind = chunks.schema["id"].dataType.simpleString()
    parts = chunks.select("id", "channel", F.col("chunk").cast("long"), "samples").mapInPandas(run, f"id {kind}, channel string, chunk long, source long, n long, part array<double>")

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sums = []
            for n, given in zip(pdf["n"], pdf["parts"]):
                y = np.zeros(int(n))
                for p in given:
                    x = np.asarray(p["part"])[: len(y)]
                    y[: len(x)] += x
                sums.append(np.clip(y, -1, 1))
            yield pdf[["id", "channel", "chunk"]].assign(samples=sums)

    # a chunk gets one part for each chunk that the responses reach, which their length bounds
    gathered = parts.groupBy("id", "channel", "chunk").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("source", "part"))).alias("parts")).where("n IS NOT NULL")
    return gathered.mapInPandas(add, f"id {kind}, channel string, chunk long, samples array<double>")
