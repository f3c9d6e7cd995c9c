"""Runs from the command line: ``python -m caseloom run ...`` or ``tables ...``."""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from caseloom.plans.run import RunConfig, run, run_stored_silver
from caseloom.plans.silver import Registries


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="caseloom")
    commands = parser.add_subparsers(dest="command", required=True)
    whole = commands.add_parser("run", help="landed cells to unified cases and tables")
    whole.add_argument("--cells", required=True, help="Parquet table of landed cells")
    whole.add_argument("--silver", required=True, help="folder of the unified cases")
    whole.add_argument("--gold", help="folder of the tables")
    whole.add_argument("--layer", choices=["silver", "gold"], default="silver")
    whole.add_argument("--salt-variable", default="CASELOOM_SALT", help="environment variable that holds the salt")
    stored = commands.add_parser("tables", help="tables from stored cases")
    stored.add_argument("--silver-path", required=True)
    stored.add_argument("--output", required=True)
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> int:
    args = _arguments(argv)
    spark = SparkSession.builder.appName("caseloom").getOrCreate()
    if args.command == "tables":
        return run_stored_silver(spark, args.silver_path, args.output)
    salt = os.environ.get(args.salt_variable)
    if not salt:
        print(f"no salt in {args.salt_variable}", file=sys.stderr)
        return 1
    return run(spark, RunConfig(args.cells, args.silver, Registries(salt), args.gold), args.layer)


if __name__ == "__main__":
    sys.exit(main())
