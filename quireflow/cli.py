"""Command lines: ``python -m quireflow.cli restore ...`` and ``python -m quireflow.cli evaluate ...``."""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import SparkSession

from .operators import evaluate
from .plans import dataset
from .plans.restore import Run
from .sources import readers, sinks


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="quireflow")
    kinds = top.add_subparsers(dest="kind", required=True)
    a = kinds.add_parser("restore", help="restore images to a CSV of texts")
    a.add_argument("--input_dir", action="append", required=True)
    a.add_argument("--output_csv", required=True)
    a.add_argument("--work_dir", default="outputs/run")
    a.add_argument("--config", default="configs/default.yaml")
    a.add_argument("--service", help="module:function that recognises one chunk, (fields, user) -> (status, text)")
    a.add_argument("--limit", type=int)
    a.add_argument("--limit_per_dir", "--limit-per-dir", type=int)
    a.add_argument("--resume", action=argparse.BooleanOptionalAction, default=True)
    a.add_argument("--force_api", "--force-api", action="store_true")
    a.add_argument("--dry_run", "--dry-run", action="store_true")
    b = kinds.add_parser("evaluate", help="compare a folder of texts with ground truth")
    b.add_argument("--pred_dir", required=True)
    b.add_argument("--gt_dir", required=True)
    b.add_argument("--mapping_csv")
    b.add_argument("--output", required=True)
    c = kinds.add_parser("profile", help="statistics of the images in folders, as a Markdown report")
    c.add_argument("--input_dir", action="append", required=True)
    c.add_argument("--output", required=True)
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("quireflow").getOrCreate()
    if args.kind == "evaluate":
        mapping = readers.read_mapping(spark, args.mapping_csv) if args.mapping_csv else None
        records, missing = evaluate.evaluate(readers.read_markdown_dir(spark, args.pred_dir), readers.read_markdown_dir(spark, args.gt_dir), mapping)
        records = records.cache()
        sinks.write_json(records, f"{args.output}/files")
        sinks.write_json(missing, f"{args.output}/missing_gt")
        sinks.write_json(evaluate.summary(records), f"{args.output}/summary")
        return 0
    if args.kind == "profile":
        dataset.report(spark, args.input_dir, args.output)
        return 0
    service = None
    if args.service:
        module, _, name = args.service.partition(":")
        service = getattr(importlib.import_module(module), name)
    try:
        config = readers.load_config(args.input_dir, args.output_csv, args.work_dir, args.config, resume=args.resume, force_api=args.force_api, dry_run=args.dry_run, limit=args.limit, limit_per_dir=args.limit_per_dir)
    except readers.ConfigError as e:
        raise SystemExit(str(e)) from e
    Run(spark, config, service).run()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
