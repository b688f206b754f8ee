"""Command line: ``spark-submit -m crashgrid --input ... --output ...`` or
``python -m crashgrid ...`` (local session when none is configured)."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .plans import runner
from .session import apply_runtime_conf


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="crashgrid", description="Write the collision reports.")
    ap.add_argument("--input", help="collision table: CSV (headered) or .parquet, any Hadoop path")
    ap.add_argument("--output", help="folder that receives one sub-folder per result")
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--only", default="", help="comma-separated result names (default: all)")
    ap.add_argument("--list", action="store_true", help="print the result names and exit")
    args = ap.parse_args(argv)
    if args.list:
        print("\n".join(runner.RESULTS))
        return 0
    if not (args.input and args.output):
        ap.error("--input and --output are required")
    spark = SparkSession.builder.appName("crashgrid").getOrCreate()
    apply_runtime_conf(spark)
    names = [n for n in args.only.split(",") if n] or None
    written = runner.run(spark, args.input, args.output, names, fmt=args.format)
    for name, path in written.items():
        print(f"{name}\t{path}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
