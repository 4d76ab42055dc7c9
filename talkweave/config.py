"""Settings of the pipeline, and the bucket dimension."""

from __future__ import annotations

import json
import tomllib
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, fields, replace
from functools import partial
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from talkweave.schemas import BUCKET


@dataclass
class Bucket:
    name: str
    count: int
    turn_min: int
    turn_max: int
    duration_min_sec: float
    duration_max_sec: float
    duration_avg_sec: float
    words_min: int
    words_max: int
    description: str = ""


# The names of sections and settings in published settings files, and their defaults.


@dataclass
class Generation:
    base_url: str | None = None
    api_key_env: str = "LLM_API_KEY"
    model: str | None = None
    temperature: float = 0.9
    top_p: float = 1.0
    max_tokens: int | None = 4096
    api_timeout_sec: float = 240.0
    api_retries: int = 5
    api_retry_backoff_sec: float = 5.0
    requests_per_minute: int = 35
    conversations_per_request: int = 5
    concurrency: int = 1
    progress_every: int = 500
    max_retries: int = 3
    topics: list[str] = field(default_factory=list)


@dataclass
class Synthesis:
    model_id: str = "nari-labs/Dia-1.6B"
    sample_rate: int = 44_100
    output_sample_rate: int = 24_000
    precision: str = "bfloat16"
    compile: bool = True
    duration_regen_limit: int = 2


@dataclass
class Overlap:
    target_hours: float = 200.0
    backchannel_ratio: float = 0.70
    interruption_ratio: float = 0.25
    simultaneous_start_ratio: float = 0.05
    overlap_attenuation: float = 0.82

    @property
    def attenuation(self) -> float:
        return self.overlap_attenuation


@dataclass
class Codec:
    model_id: str = "kyutai/mimi"
    training_codebooks: int = 8
    token_count: int = 2048


@dataclass
class Hub:
    repo_env: str = "HF_DATASET_REPO"
    token_env: str = "HF_TOKEN"


# The default bucket dimension.
DEFAULT_BUCKETS = (
    Bucket("short", 15000, 4, 6, 12, 20, 16, 28, 55, "Fast alternation, greetings, quick plans, yes/no exchanges."),
    Bucket("medium", 20000, 6, 8, 25, 40, 30, 70, 115, "Natural conversational flow and main workhorse examples."),
    Bucket("long", 10000, 8, 10, 40, 55, 45, 115, 170, "Sustained attention and nuanced topic development."),
    Bucket("extended", 5000, 10, 14, 55, 90, 65, 170, 260, "Story arcs, debates, and long-range coherence."),
)


@dataclass
class Config:
    output_dir: str = "data"
    buckets: list[Bucket] = field(default_factory=lambda: [*DEFAULT_BUCKETS])
    generation: Generation = field(default_factory=Generation)
    synthesis: Synthesis = field(default_factory=Synthesis)
    overlap: Overlap = field(default_factory=Overlap)
    codec: Codec = field(default_factory=Codec)
    hub: Hub = field(default_factory=Hub)

    def as_dict(self) -> dict[str, Any]:
        """By the published names of sections."""
        return {SECTIONS.get(k, k): v for k, v in asdict(self).items()}


#: What each section is called in settings files (its own name will do, too), and earlier names of settings.
SECTIONS = {"generation": "script_generation", "synthesis": "dia", "overlap": "overlap", "codec": "mimi", "hub": "huggingface"}
EARLIER = {"timeout_sec": "api_timeout_sec", "retries": "api_retries", "retry_backoff_sec": "api_retry_backoff_sec", "progress_interval": "progress_every", "attenuation": "overlap_attenuation", "codebook_size": "token_count"}


def _filled(kind: type, raw: dict[str, Any], where: str) -> Any:
    """A setting that isn't known is an error, so that none is dropped unseen."""
    known = {f.name for f in fields(kind)}
    named = {k if k in known else EARLIER.get(k, k): v for k, v in raw.items()}
    if unknown := sorted(named.keys() - known):
        raise ValueError(f"unknown settings in {where}: {', '.join(unknown)}")
    return kind(**named)


#: What reads settings, by a file's ending.
PARSERS = {".json": json.loads, ".toml": tomllib.loads, ".tml": tomllib.loads}


def from_settings(raw: dict[str, Any]) -> Config:
    """A configuration from parsed settings: a reader for each part, by each of its names; what is absent stays as it is by default."""
    plain = Config()
    readers: dict[str, tuple[str, Callable[[Any], Any]]] = {"output_dir": ("output_dir", str), "buckets": ("buckets", lambda rows: [_filled(Bucket, b, "buckets") for b in rows])}
    for name, published in SECTIONS.items():
        for key in (name, published):
            readers[key] = name, partial(_filled, type(getattr(plain, name)), where=key)
    if unknown := sorted(raw.keys() - readers.keys()):
        raise ValueError(f"unknown sections: {', '.join(unknown)}")
    return replace(plain, **{name: read(raw[key]) for key, (name, read) in readers.items() if key in raw})


def load_config(path: str | Path | None = None) -> Config:
    """Settings from a file of one of the endings in PARSERS, in any case; defaults without one. Unknown names raise."""
    if path is None:
        return Config()
    parse = PARSERS.get(Path(path).suffix.lower())
    if parse is None:
        raise ValueError(f"{path}: settings are read from {', '.join(PARSERS)}")
    return from_settings(parse(Path(path).read_text(encoding="utf-8")))


def bucket_table(spark: SparkSession, buckets: list[Bucket] | tuple[Bucket, ...] = DEFAULT_BUCKETS) -> DataFrame:
    """The dimension as a table of a few rows."""
    rows = [tuple(float(v) if "sec" in k else v for k, v in asdict(b).items()) for b in buckets]
    return spark.createDataFrame(rows, BUCKET)
