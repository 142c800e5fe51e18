"""Command line: build the warehouse from CSV feeds, optionally with quality checks.

    python -m clickloom DATA_DIR [--step setup|load|staging|intermediate|marts|all]
                        [--quality] [--sample] [--prefix NAME_] [--location FOLDER]
                        [--runs FOLDER] [--metrics FOLDER] [--max-bad-records N]
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from clickloom.observability import QualityTracker, latest_by_suite
from clickloom.plans.build import ALL_STEPS, Build
from clickloom.quality import SUITES, sample_rows
from clickloom.schemas import RAW_TABLES
from clickloom.session import configure, write_down
from clickloom.sources import Warehouse


def check_quality(build: Build, runs: str, metrics: str, sample: bool) -> bool:
    """Validate the raw tables and the daily report, and record runs and metrics."""
    tracker = QualityTracker(build.warehouse.spark, runs, metrics)
    passed = True
    for suite in SUITES.values():
        table = build.table(suite.dataset)
        if sample:
            table = write_down(sample_rows(table))
        tracker.track(table, suite, sampled=sample)
        failed = latest_by_suite(tracker.runs).filter(F.col("suite_name") == suite.name).first().failed
        print(f"{suite.name}: {'PASS' if not failed else f'{failed} checks failed'}")
        passed = passed and not failed
    tracker.health_bundle()["health_summary"].show(truncate=False)
    return passed


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="clickloom")
    parser.add_argument("data_dir", help="folder with <table>.csv for each raw table")
    parser.add_argument("--step", choices=(*ALL_STEPS, "all"), default="all")
    parser.add_argument("--quality", action="store_true")
    parser.add_argument("--sample", action="store_true")
    parser.add_argument("--prefix", default="")
    parser.add_argument("--location")
    parser.add_argument("--runs", default="quality_runs")
    parser.add_argument("--metrics", default="quality_metrics")
    parser.add_argument("--max-bad-records", type=int, default=0,
                        help="bad records per feed up to which a load goes on (default: fail on any)")
    args = parser.parse_args(argv)

    spark = configure(SparkSession.builder.appName("clickloom").getOrCreate())
    build = Build(Warehouse(spark, args.prefix, args.location))
    for step in ALL_STEPS if args.step == "all" else (args.step,):
        if step == "setup":
            build.setup()
        elif step == "load":
            build.load({name: f"{args.data_dir}/{name}.csv" for name in RAW_TABLES}, args.max_bad_records)
        else:
            build.run_step(step)
    build.counts().show(truncate=False)
    if args.quality and not check_quality(build, args.runs, args.metrics, args.sample):
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
