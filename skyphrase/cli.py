"""Command line: python -m skyphrase.cli data sample | generate | benchmark | regenerate | inspect | push, voices build, version."""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import asdict
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config as region_config
from .plans import generate, voices
from .plans.scenario import Sampler
from .progress import Progress, log_file, watched
from .sinks.folder import Folder
from .sinks.shards import FingerprintMismatch, Manifest, push
from .sources import corpora, dims, registry, replay

VERSION = "0.1.0"
WEIGHTERS = ("tier", "uniform", "custom")


class BadArgument(ValueError):
    """An argument that can't be worked with; exit code 2."""


def names(text: str | None, what: str) -> list[str]:
    found = [x.strip() for x in (text or "").split(",") if x.strip()]
    if text is not None and not found:
        raise BadArgument(f"{what} must list at least one name")
    return found


def numbers(text: str) -> list[int]:
    try:
        found = [int(x) for x in text.split(",") if x.strip()]
    except ValueError as error:
        raise BadArgument(f"not whole numbers: {text}") from error
    if not found or min(found) < 1:
        raise BadArgument("concurrencies must be 1 or more")
    return found


LEAST = {"n": 0, "count": 0, "target": 0, "per_point": 1, "shard_size": 1, "concurrency": 1, "max_tokens": 1, "max_retries": 1, "max_parse_retries": 1, "min_duration_s": 0, "temperature": 0, "log_every": 0}


def checked(args: argparse.Namespace) -> None:
    """Counts and sizes that can't be worked with are refused before anything is read or written."""
    for name, least in LEAST.items():
        if getattr(args, name, least) < least:
            raise BadArgument(f"--{name.replace('_', '-')} must be {least} or more")
    if getattr(args, "max_duration_s", 0) < getattr(args, "min_duration_s", 0):
        raise BadArgument("--max-duration-s is less than --min-duration-s")


def log_path(args: argparse.Namespace) -> str:
    return args.log_file or f"{args.out.rstrip('/')}/run.log"


def logged(spark: SparkSession, args: argparse.Namespace, total: int, there: int = 0):
    """A hook that writes progress lines to the log file (run.log in the output folder unless named).  What was ``there``
    before counts toward the share, and not toward the rate."""
    progress = Progress(total, log_file(spark, log_path(args)), args.log_every, there)

    def hook(stats) -> None:
        counts = asdict(stats)
        progress.log(there + counts["ok"] + counts["failed"] if "ok" in counts else counts["kept"], **counts)

    return hook


def contents(rows: DataFrame, *columns: str) -> int:
    """A digest of rows, whatever their order."""
    return rows.agg(F.coalesce(F.sum(F.xxhash64(*columns).cast("decimal(20,0)")), F.lit(0)).alias("h")).first()["h"]


def sampler(spark: SparkSession, args: argparse.Namespace) -> tuple[Sampler, str]:
    """The sampler of the arguments, and the name of its weighter."""
    settings = region_config.load(args.config)
    regions = names(args.regions, "--regions")
    if odd := [r for r in regions if r not in region_config.REGIONS]:
        raise BadArgument(f"no region {', '.join(odd)}; there are {', '.join(region_config.REGIONS)}")
    if args.weighter not in WEIGHTERS:
        raise BadArgument(f"no weighter {args.weighter!r}; there are {', '.join(WEIGHTERS)}")
    weights, name = None, f"{args.weighter}_v1"
    ports = dims.airports(spark, args.airports)
    if args.weighter == "uniform":
        weights = dims.uniform_weights(ports)
    elif args.weighter == "custom":
        if not args.airports_weights:
            raise BadArgument("--weighter custom needs --airports-weights")
        weights = dims.custom_weights(spark, args.airports_weights)
        # what the file says belongs to the run, not only its name
        name = f"custom:{contents(weights, 'icao', 'weight')}"
    if args.airports:
        name += f"+airports:{contents(ports, 'icao', 'region')}"
    return Sampler(spark, settings, args.seed, airports=ports, weights=weights, regions=regions), name


def run_config(args: argparse.Namespace, weighter: str, count: int) -> generate.RunConfig:
    regions = tuple(names(args.regions, "--regions")) or tuple(region_config.load(args.config).allowed_regions)
    keys = ("base_url", "api_key", "concurrency", "temperature", "max_tokens", "shard_size", "max_retries", "max_parse_retries", "seed", "model")
    return generate.RunConfig(count=count, weighter_name=weighter, regions=regions, config_name=args.config, config_contents=region_config.digest(args.config), **{k: getattr(args, k) for k in keys if hasattr(args, k)})


def client_of(args: argparse.Namespace):
    return generate.stub_client if args.model == "stub" else generate.chat_client


def do_sample(spark, args) -> int:
    draws, _ = sampler(spark, args)
    for line in draws.rows(args.n).orderBy("id").select(F.to_json("scenario", {"ignoreNullFields": "false"})).toLocalIterator():
        print(line[0])
    return 0


def do_generate(spark, args) -> int:
    draws, weighter = sampler(spark, args)
    settings = run_config(args, weighter, args.count)
    # the folder is opened first: it may be emptied, and what it holds counts toward the share done
    sink = generate.open_sink(spark, args.out, settings, resume=args.resume, overwrite=args.overwrite)
    if args.overwrite:
        sink.close()
    held = sink.manifest.settled
    there = args.count - len(held.missing(args.count)) if held is not None else sink.manifest.total_rows
    hook = logged(spark, args, args.count, there)
    print(generate.run(draws, args.out, settings, client_of(args), resume=args.resume or args.overwrite, hook=hook, watch=hook))
    return 0


def do_benchmark(spark, args) -> int:
    draws, weighter = sampler(spark, args)
    found = generate.sweep(draws, run_config(args, weighter, args.per_point), numbers(args.concurrencies), args.per_point, client_of(args))
    text = json.dumps(found, indent=2)
    if args.results_json:
        Path(args.results_json).write_text(text)
    print(text)
    return 0


def do_regenerate(spark, args) -> int:
    folder = Folder(spark, args.out)
    if not folder.exists("manifest.json"):
        print(f"{args.out} has no manifest", file=sys.stderr)
        return 1
    meta = Manifest.load(folder.read("manifest.json")).meta or {}
    settings = generate.RunConfig(**{k: tuple(v) if k == "regions" else v for k, v in meta.items() if k in generate.RunConfig.__dataclass_fields__})
    settings = generate.replace(settings, max_parse_retries=args.max_parse_retries, model=args.model or settings.model, api_key=args.api_key, base_url=args.base_url or settings.base_url)
    args.model = settings.model
    hook = logged(spark, args, replay.inspect(spark, args.out)["failures"])
    print(generate.rerun(spark, args.out, settings, client_of(args), hook, hook))
    return 0


def do_inspect(spark, args) -> int:
    folder = Folder(spark, args.out)
    found = replay.inspect(spark, args.out)
    if folder.exists("manifest.json"):
        found["manifest"] = json.loads(folder.read("manifest.json"))
    print(json.dumps(found, indent=2))
    return 0


def do_push(spark, args) -> int:
    if not Folder(spark, args.out).exists("manifest.json"):
        print(f"{args.out} has no manifest", file=sys.stderr)
        return 1
    for name in push(spark, args.out, args.to):
        print(name)
    return 0


def do_voices(spark, args) -> int:
    corpora.register_corpora(args.libritts, args.mls)
    wanted = names(args.sources, "--sources")
    try:
        found = [registry.get(n) for n in wanted]
    except KeyError as error:
        raise BadArgument(error.args[0]) from error
    params = voices.Filter(args.min_duration_s, args.max_duration_s, args.min_rms_dbfs)
    folder = Folder(spark, args.out)
    there = Manifest.load(folder.read("manifest.json")).total_rows if folder.exists("manifest.json") else 0
    with watched(spark, log_file(spark, log_path(args)), args.log_every or 1.0):
        print(voices.build(spark, found, args.out, args.target, params, shard_size=args.shard_size, resume=args.resume, hook=logged(spark, args, args.target, there), seed=args.seed))
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="skyphrase", description=__doc__)
    groups = top.add_subparsers(dest="group", required=True)
    groups.add_parser("version").set_defaults(run=None)
    data = groups.add_parser("data").add_subparsers(dest="command", required=True)

    def drawn(name, run):
        p = data.add_parser(name)
        p.add_argument("--seed", type=int, default=42)
        p.add_argument("--config", default="us")
        p.add_argument("--weighter", default="tier")
        p.add_argument("--airports", help="a CSV with icao and country, instead of the bundled airports")
        p.add_argument("--airports-weights")
        p.add_argument("--regions")
        p.set_defaults(run=run)
        return p

    def asking(p):
        p.add_argument("--model", required=True)
        p.add_argument("--base-url", default="http://localhost:30000/v1")
        p.add_argument("--api-key", default="EMPTY")
        p.add_argument("--temperature", type=float, default=0.9)
        p.add_argument("--max-tokens", type=int, default=2048)
        p.add_argument("--max-retries", type=int, default=5)
        p.add_argument("--max-parse-retries", type=int, default=5)

    def logs(p):
        p.add_argument("--log-file")
        p.add_argument("--log-every", type=float, default=5.0)

    drawn("sample", do_sample).add_argument("-n", type=int, default=5)
    p = drawn("generate", do_generate)
    asking(p)
    p.add_argument("--count", type=int, required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--concurrency", type=int, default=96)
    p.add_argument("--shard-size", type=int, default=10_000)
    p.add_argument("--resume", action=argparse.BooleanOptionalAction, default=True)
    p.add_argument("--overwrite", action="store_true")
    logs(p)
    p = drawn("benchmark", do_benchmark)
    asking(p)
    p.add_argument("--concurrencies", default="16,32,64,96,128")
    p.add_argument("--per-point", type=int, default=200)
    p.add_argument("--results-json")
    p = data.add_parser("regenerate")
    p.add_argument("--out", required=True)
    p.add_argument("--model")
    p.add_argument("--base-url")
    p.add_argument("--api-key", default="EMPTY")
    p.add_argument("--max-parse-retries", type=int, default=10)
    logs(p)
    p.set_defaults(run=do_regenerate)
    p = data.add_parser("inspect")
    p.add_argument("--out", required=True)
    p.set_defaults(run=do_inspect)

    p = data.add_parser("push")
    p.add_argument("--out", required=True)
    p.add_argument("--to", required=True)
    p.set_defaults(run=do_push)

    p = groups.add_parser("voices").add_subparsers(dest="command", required=True).add_parser("build")
    p.add_argument("--out", required=True)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--target", type=int, default=100)
    p.add_argument("--sources", default="libritts-r")
    p.add_argument("--libritts")
    p.add_argument("--mls")
    p.add_argument("--min-duration-s", type=float, default=voices.Filter.min_seconds)
    p.add_argument("--max-duration-s", type=float, default=voices.Filter.max_seconds)
    p.add_argument("--min-rms-dbfs", type=float, default=-40.0)
    p.add_argument("--shard-size", type=int, default=500)
    p.add_argument("--resume", action=argparse.BooleanOptionalAction, default=True)
    logs(p)
    p.set_defaults(run=do_voices)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    if args.run is None:
        print(VERSION)
        return 0
    try:
        checked(args)
        return args.run(spark or SparkSession.builder.appName("skyphrase").getOrCreate(), args)
    except (BadArgument, FingerprintMismatch, region_config.ConfigNotFound, ValueError) as error:
        print(error, file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
