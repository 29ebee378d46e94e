"""Command line: ``python -m crease --root DIR --matches CSV --deliveries CSV [--only STAGE]``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from crease.plans.incremental import update
from crease.plans.stages import STAGES, Layout, run_pipeline
from crease.session import ensure_checkpoint_dir


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="crease", description=__doc__)
    ap.add_argument("--root", required=True, help="folder holding the layer tables")
    ap.add_argument("--matches", help="raw matches files (bronze input)")
    ap.add_argument("--deliveries", help="raw deliveries files (bronze input)")
    ap.add_argument("--source-format", default="csv")
    ap.add_argument("--table-format", default="parquet")
    ap.add_argument("--match-buckets", type=int, help="bucket the silver tables by match")
    ap.add_argument("--update", action="store_true",
                    help="append the raw files to bronze and rebuild what they change")
    ap.add_argument("--only", choices=STAGES, help="run a single stage")
    ap.add_argument("--master", help="only to override the master spark-submit provides")
    args = ap.parse_args(argv)
    builder = (SparkSession.builder.appName("crease")
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    if args.master:
        builder = builder.master(args.master)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    layout = Layout(args.root, args.matches, args.deliveries, args.source_format,
                    args.table_format, match_buckets=args.match_buckets)
    if args.update:
        print(json.dumps(update(spark, layout)))
        return
    stages = [args.only] if args.only else list(STAGES)
    print(json.dumps(run_pipeline(spark, layout, stages)))


if __name__ == "__main__":
    main()
