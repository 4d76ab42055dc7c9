"""Command line: each command reads and writes folders through Spark and prints one JSON result."""

from __future__ import annotations

import argparse
import importlib
import json
import os
import sys
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.config import bucket_table, load_config
from talkweave.operators import corpus, generation, validate
from talkweave.plans import stage_audio, stages
from talkweave.schemas import SCRIPT, SEQUENCE, TOKENS
from talkweave.sources import client, files
from talkweave.storage import stored

# The names that commands were published by.
PUBLISHED = {"generate-zipvoice-dialog-scripts": "generate-dialog-scripts", "export-zipvoice-dialog-tsv": "export-dialog-tsv", "tokenize-mimi": "tokenize"}
SUBSETS = ("scripts", "stage3", "stage4", "shards")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="talkweave")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *options: tuple[tuple[str, ...], dict[str, Any]]) -> None:
        c = sub.add_parser(name, aliases=[k for k, v in PUBLISHED.items() if v == name])
        c.add_argument("--config", "-c")
        for names, kw in options:
            c.add_argument(*names, **kw)

    limit = (("--limit",), {"type": int})
    mock = (("--mock",), {"action": "store_true", "help": "the stand-in, which is what runs in any case: voices and codecs plug in as functions"})
    out = lambda default: (("--output", "-o"), {"default": default})
    command("show-config")
    command("generate-scripts", out("data/scripts/dialogues"), limit, (("--dry-run",), {"action": "store_true"}))
    command("generate-dialog-scripts", (("--output-dir", "-o"), {"default": "data/scripts/dialog"}), limit, (("--dry-run",), {"action": "store_true"}))
    command("export-dialog-tsv", (("--scripts",), {"required": True}), (("--voice-prompts",), {"default": "voice_prompts"}), out("data/dialog/test.tsv"), (("--bucket",), {}))
    silent = (("--metadata-only",), {"action": "store_true", "help": "times and paths, no audio files"})
    command("synth-stage3", (("--scripts",), {"required": True}), out("data/stage3"), limit, mock, silent, (("--voice",), {"help": "module:factory of a function from speaker, text and attempt to samples"}))
    command("inject-overlap", (("--stage3",), {"default": "data/stage3"}), out("data/stage4"), limit, (("--seed",), {"type": int, "default": 13}))
    command("tokenize", (("--stage",), {"default": "data/stage3"}), out("data/tokens/stage3"), limit, (("--mock",), {"action": "store_true", "help": "stand-in codes, no audio is read"}), (("--codec",), {"help": "module:factory of a function from samples and rate to codes"}))
    command("assemble-shards", (("--tokens",), {"required": True}), (("--stage",), {"default": "data/stage3"}), out("data/shards/stage3_train"))
    command("validate", (("--subset",), {"default": "stage3", "choices": SUBSETS}), (("--path",), {"default": "data/stage3"}), (("--metadata-only",), {"action": "store_true", "help": "don't look at audio files"}), (("--errors",), {"help": "a folder that takes every violation, as JSON; the report itself lists 1000 at most"}))
    command("upload-hf", (("--data-dir",), {"default": "data"}), (("--subset",), {"default": "all", "choices": ("all", *SUBSETS)}), (("--dry-run",), {"action": "store_true"}))
    return p


def plugged(name: str):
    """What module:attribute names."""
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def run(spark: SparkSession, a: argparse.Namespace) -> Any:
    config = load_config(a.config)
    a.command = PUBLISHED.get(a.command, a.command)

    def report(rows: DataFrame, found: DataFrame, what: str) -> dict[str, Any]:
        if a.errors:
            found.write.mode("overwrite").json(a.errors)
        return validate.report(rows, found, what)

    if a.command == "show-config":
        return config.as_dict()
    if a.command in ("generate-scripts", "generate-dialog-scripts"):
        complete = None if a.dry_run else client.from_settings(config.generation)
        if not a.dry_run and complete is None:
            raise RuntimeError(f"no client is configured: set base_url, model and {config.generation.api_key_env}, or use --dry-run")
        path = a.output if a.command == "generate-scripts" else f"{a.output_dir}/dialog_scripts"
        done = generation.generate(spark, config, path, a.limit, complete and generation.client_source(config, complete))
        if a.command == "generate-dialog-scripts":
            files.write_by_bucket(files.read_scripts(spark, path), [b.name for b in config.buckets], f"{a.output_dir}/buckets")
        return {"completed": done}
    if a.command == "export-dialog-tsv":
        rows = corpus.tsv_rows(files.read_scripts(spark, a.scripts), files.read_prompts(spark, a.voice_prompts), "conversation_id")
        rows = rows.where(F.col("category") == a.bucket) if a.bucket else rows
        files.write_tsv(rows.orderBy("idx").drop("idx", "category"), a.output)
        return {"written": rows.count(), "output": a.output}
    if a.command == "synth-stage3":
        scripts = files.read_scripts(spark, a.scripts)
        if a.voice and (a.mock or a.metadata_only):
            raise RuntimeError("--voice can't go with --mock or --metadata-only")
        done = stages.synthesize(scripts, config, a.limit) if a.metadata_only else stored(stage_audio.render(scripts, config, a.output, a.voice and plugged(a.voice), a.limit))
        files.write_stage(done.where("accepted").drop("accepted"), a.output)
        n = done.agg(F.sum(F.col("accepted").cast("long")).alias("written"), F.sum((~F.col("accepted")).cast("long")).alias("skipped")).first()
        return {k: n[k] or 0 for k in ("written", "skipped")}
    if a.command == "inject-overlap":
        before = files.read_stage(spark, a.stage3).drop("path")
        done = stages.inject_overlaps(before, config, a.seed, a.limit)
        if stage_audio.has_audio(spark, a.stage3):
            done = stage_audio.remix(done, config, a.stage3, a.output)
        files.write_stage(done, a.output)
        written = files.read_stage(spark, a.output).count()
        return {"written": written, "skipped": min(before.count(), a.limit if a.limit is not None else 1 << 62) - written}
    if a.command == "tokenize":
        if not (a.mock or a.codec):
            raise RuntimeError("name a codec by --codec module:factory, or use --mock for the stand-in")
        done = stored(stages.tokenize(files.read_stage(spark, a.stage).drop("path"), config, a.stage, a.limit, a.codec and plugged(a.codec)))
        done.write.mode("overwrite").json(a.output)
        return {"written": done.count()}
    if a.command == "assemble-shards":
        done = stages.assemble(files.read_json(spark, a.tokens, TOKENS), files.read_stage(spark, a.stage).drop("path"), a.stage)
        done.write.mode("overwrite").json(a.output)
        return {"written": done.count()}
    if a.command == "validate":
        buckets = bucket_table(spark, config.buckets)
        if a.subset in ("scripts", "shards"):
            kind, needed, broken, what = {
                "scripts": (SCRIPT, ("conversation_id", "category", "turns"), lambda rows: validate.script_violations(rows, buckets), "scripts"),
                "shards": (SEQUENCE, ("conversation_id", "tokens", "loss_mask"), validate.sequence_violations, "shard records"),
            }[a.subset]
            rows = files.json_lines(spark, a.path, kind, needed)
            good = rows.where("error IS NULL").drop("error", "path", "line")
            return report(rows, broken(good).unionAll(validate.line_violations(rows)), what)
        rows = files.stage_files(spark, a.path)
        audio = None if a.metadata_only else stored(files.stage_audio(spark, a.path))
        found = validate.stage_violations(rows, buckets, audio, require_overlaps=a.subset == "stage4")
        return report(rows, found, "conversation metadata") | {"audio_checked": audio is not None}
    if not a.dry_run:
        raise RuntimeError("uploading is left to the hub's own tools; use --dry-run for the plan")
    repo = os.environ.get(config.hub.repo_env, "")
    if not repo:
        raise RuntimeError(f"set {config.hub.repo_env}")
    subsets = SUBSETS if a.subset == "all" else (a.subset,)
    return [files.upload_plan(files.inventory(spark, f"{a.data_dir}/{s}"), repo, s).first().asDict() for s in subsets]


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("talkweave").getOrCreate()
    result = run(spark, args)
    print(json.dumps(result, indent=2, ensure_ascii=False))
    return int(args.command == "validate" and not result["ok"])


if __name__ == "__main__":
    sys.exit(main())
