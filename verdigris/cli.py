"""python -m verdigris: rules, sampling, report, mirror, deploy."""

from __future__ import annotations

import argparse
import csv
import json
import os
import sys

from pyspark.sql import SparkSession

from .functions.settings import Settings, configure_logging, load_env_file
from .plans import metastore as ms
from .plans import reporting
from .plans.mirror import Mirror
from .plans.rules import RuleRunner
from .plans.sampling import SamplingRunner
from .sources.resolver import SourceResolver


def pairs(given: list[str] | None) -> dict[str, str]:
    """KEY=VALUE texts as a dict, split at the first =."""
    out = {}
    for text in given or []:
        key, sep, value = text.partition("=")
        if not sep or not key.strip():
            raise ValueError(f"{text!r} is not KEY=VALUE")
        out[key.strip()] = value
    return out


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="verdigris", description=__doc__)
    top.add_argument("--meta", help="folder of the metadata store")
    top.add_argument("--log-level", default="ERROR")
    top.add_argument("--log-folder")
    sub = top.add_subparsers(dest="command", required=True)
    rules, sampling, report, mirror, deploy = (sub.add_parser(n) for n in ("rules", "sampling", "report", "mirror", "deploy"))
    for p in (rules, sampling):
        p.add_argument("--project")
        p.add_argument("--process")
        p.add_argument("--run-key")
        p.add_argument("--param", action="append", metavar="KEY=VALUE")
        p.add_argument("--triggered-by", default="CLI")
    rules.add_argument("--group")
    rules.add_argument("--variant")
    rules.add_argument("--filter", action="append", metavar="KEY=VALUE")
    rules.add_argument("--text-param", action="append", metavar="KEY=VALUE")
    rules.add_argument("--batch", action="store_true", help="find the keys of a group's rules in one job")
    rules.add_argument("--strict", action="store_true", help="exit with 1 also if a rule could not be run")
    sampling.add_argument("--config", type=int)
    sampling.add_argument("--seed", type=int)
    sampling.add_argument("--random-mode", choices=("seeded", "hash"), default="seeded")
    which = report.add_mutually_exclusive_group(required=True)
    which.add_argument("--rule-id", type=int)
    which.add_argument("--process")
    report.add_argument("--run-key", required=True)
    report.add_argument("--project")
    report.add_argument("--rule-name")
    report.add_argument("--output", help="a CSV file; without it rows go to standard output")
    mirror.add_argument("--target", required=True)
    mirror.add_argument("--tables", nargs="*")
    mirror.add_argument("--full-refresh", action="store_true")
    mirror.add_argument("--dry-run", action="store_true")
    deploy.add_argument("--drop-first", action="store_true")
    deploy.add_argument("--dry-run", action="store_true")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None, sources: SourceResolver | None = None) -> int:
    load_env_file()
    args = parser().parse_args(argv)
    configure_logging(args.log_folder, level=args.log_level)
    settings = Settings.from_env()
    spark = spark or SparkSession.builder.appName("verdigris").getOrCreate()
    store = ms.MetaStore(spark, args.meta or settings.meta_path)
    sources = sources or SourceResolver(spark, settings, os.environ)
    try:
        return {"rules": _rules, "sampling": _sampling, "report": _report, "mirror": _mirror, "deploy": _deploy}[args.command](args, store, sources, settings)
    except ValueError as e:
        print(e, file=sys.stderr)
        return 1


def _rules(args, store, sources, settings) -> int:
    """0 if all groups completed, even if rules of them could not be run, unless --strict."""
    out = RuleRunner(store, sources, settings).run_scope(
        args.run_key, args.project, args.process, args.group, triggered_by=args.triggered_by, params=pairs(args.param), variant=args.variant, filters=pairs(args.filter), text_params=pairs(args.text_param), batch=args.batch
    )
    print(json.dumps(out, default=str, indent=1))
    return int(any(s["status"] != "COMPLETED" or args.strict and s["errored"] for s in out.values()))


def _sampling(args, store, sources, settings) -> int:
    runner = SamplingRunner(store, sources, args.random_mode)
    options = {"seed": args.seed, "params": pairs(args.param), "triggered_by": args.triggered_by}
    if args.config is not None:
        out = {args.config: runner.run(args.config, args.run_key, **options)}
    elif args.process:
        out = runner.run_process(args.process, args.run_key, args.project, **options)
    else:
        raise ValueError("give --config or --process")
    print(json.dumps(out, default=str, indent=1))
    return int(any(s["status"] != "COMPLETED" for s in out.values()))


def _report(args, store, sources, settings) -> int:
    if args.rule_id is not None:
        rows = reporting.source_records(store, sources, args.rule_id, args.run_key)
    else:
        rows = reporting.source_records_for_process(store, sources, args.process, args.run_key, args.project, args.rule_name)
    if args.output:
        if not reporting.to_csv(rows, args.output):
            print("no matching records, nothing to write", file=sys.stderr)
        return 0
    out, n = csv.writer(sys.stdout), 0
    for n, row in enumerate(rows.toLocalIterator(), 1):  # partition by partition
        if n == 1:
            out.writerow(rows.columns)
        out.writerow(row)
    if not n:
        print("no records", file=sys.stderr)
    return 0


def _mirror(args, store, sources, settings) -> int:
    out = Mirror(store, ms.MetaStore(store.spark, args.target), settings.lookback_minutes).sync(args.tables or None, args.full_refresh, args.dry_run)
    print(json.dumps(out, indent=1))
    return int("ERROR" in out.values())


def _deploy(args, store, sources, settings) -> int:
    print("\n".join(store.create_all(args.drop_first, args.dry_run)))
    return 0
