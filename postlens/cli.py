"""Command line: run the monthly job (or its incremental stream).

    spark-submit -m postlens INPUTS OUTPUTS [options]
    python -m postlens INPUTS OUTPUTS [options]

The session comes from ``SparkSession.builder.getOrCreate()``, so master,
memory and the shared ``spark.checkpoint.dir`` are whatever spark-submit or
the cluster defaults provide.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from postlens.operators.preprocess import DEFAULT_SNAPSHOT_MONTHS
from postlens.plans.monthly import run_monthly_job


def _year_month(text: str) -> tuple[int, int]:
    try:
        year, month = text.split("-")
        ym = (int(year), int(month))
    except ValueError:
        raise argparse.ArgumentTypeError(f"expected YYYY-MM, got {text!r}") from None
    if not 1 <= ym[1] <= 12:
        raise argparse.ArgumentTypeError(f"month out of range in {text!r}")
    return ym


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(
        prog="postlens",
        description="Monthly summary (JSON) and tag analysis (Parquet) of posts and users.",
    )
    p.add_argument("inputs", nargs="?",
                   help="folder with <year>/<month>/posts.csv and users.csv")
    p.add_argument("outputs", nargs="?", help="folder for summary/ and tag_analysis/")
    p.add_argument("--config", metavar="YAML",
                   help="read INPUTS_FOLDER and OUTPUTS_FOLDER from a YAML file "
                        "(other keys are ignored)")
    p.add_argument("--how", choices=["left", "inner"], default="left",
                   help="join of posts to users in the tag analysis (default left)")
    p.add_argument("--one-users-table", action="store_true",
                   help="match posts against all users files, not their month's only")
    p.add_argument("--snapshot", type=_year_month, action="append", metavar="YYYY-MM",
                   help="a folder holding all users created so far (repeatable; "
                        "default 2016-01)")
    p.add_argument("--no-snapshot", action="store_true", help="no snapshot folder")
    p.add_argument("--multi-line", action="store_true",
                   help="CSV fields may hold line breaks (files are then not split)")
    p.add_argument("--split-lines", action="store_true",
                   help="CSV fields may hold line breaks, and files are split; "
                        "reads the text once more to count quotes")
    p.add_argument("--by-name", action="store_true",
                   help="take CSV columns by the names in each file's header")
    p.add_argument("--malformed", choices=["fail", "null", "reject"], default="fail",
                   help="broken CSV rows: stop (default), null values, or write them "
                        "to rejected/ and go on")
    p.add_argument("--allow-missing", action="store_true",
                   help="go on when a month folder lacks posts.csv or users.csv")
    p.add_argument("--months", type=_year_month, action="append", metavar="YYYY-MM",
                   help="rebuild only these months (repeatable)")
    p.add_argument("--join-first", action="store_true",
                   help="tag analysis with --one-users-table: join every post instead "
                        "of folding posts per owner first")
    p.add_argument("--salt", type=int, default=1, metavar="S",
                   help="split every owner's posts S ways in the join")
    p.add_argument("--no-staging", action="store_true",
                   help="do not stage the parsed CSV as Parquet first")
    p.add_argument("--stream", action="store_true",
                   help="process month folders as they arrive (file-name stream)")
    p.add_argument("--poll", metavar="INTERVAL",
                   help="with --stream: keep running, polling every INTERVAL "
                        "(e.g. '5 minutes'); default: handle present files and stop")
    p.add_argument("--checkpoint", help="with --stream: checkpoint folder")
    return p


# Key names of the YAML configuration file.
CONFIG_INPUTS_KEY = "INPUTS_FOLDER"
CONFIG_OUTPUTS_KEY = "OUTPUTS_FOLDER"


def read_config(path: str) -> tuple[str, str]:
    """Inputs and outputs folders from a YAML configuration file."""
    try:
        import yaml
    except ImportError as exc:  # pragma: no cover - gated optional dependency
        raise SystemExit("--config needs PyYAML") from exc
    with open(path) as fh:
        conf = yaml.safe_load(fh) or {}
    try:
        return str(conf[CONFIG_INPUTS_KEY]), str(conf[CONFIG_OUTPUTS_KEY])
    except KeyError as exc:
        raise SystemExit(f"{path}: missing key {exc.args[0]}") from None


def job_options(args: argparse.Namespace) -> dict:
    if args.no_snapshot:
        snapshot = ()
    else:
        snapshot = tuple(args.snapshot) if args.snapshot else DEFAULT_SNAPSHOT_MONTHS
    return {
        "how": args.how,
        "join_on_month": not args.one_users_table,
        "snapshot_months": snapshot,
        "multiline": "split" if args.split_lines else args.multi_line,
        "by_name": args.by_name,
        "malformed": args.malformed,
        "stage_inputs": not args.no_staging,
        "pre_aggregate": False if args.join_first else None,
        "salt_buckets": args.salt,
        **({"strict": False} if args.allow_missing else {}),
    }


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = build_parser()
    args = parser.parse_args(argv)
    if args.config:
        conf_in, conf_out = read_config(args.config)
        args.inputs = args.inputs or conf_in
        args.outputs = args.outputs or conf_out
    if not args.inputs or not args.outputs:
        parser.error("give INPUTS and OUTPUTS, or --config")
    spark = spark or SparkSession.builder.appName("postlens").getOrCreate()
    options = job_options(args)
    if args.stream:
        from postlens.streaming import start_month_stream

        query = start_month_stream(
            spark,
            args.inputs,
            args.outputs,
            checkpoint=args.checkpoint,
            available_now=args.poll is None,
            processing_time=args.poll or "1 minute",
            **options,
        )
        query.awaitTermination()
        return 0
    result = run_monthly_job(spark, args.inputs, args.outputs, months=args.months, **options)
    print(f"summary: {result.summary}")
    print(f"tag analysis: {result.tag_analysis}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
