"""Command line: refresh a warehouse from an export, and report its quality checks.

    spark-submit ... -m trailweave --daily s3a://b/daily --intraday s3a://b/intraday --out s3a://b/wh
"""

from __future__ import annotations

import argparse
import sys
from datetime import date

from pyspark.sql import SparkSession

from . import EngineConfig, configure
from .plans.pipeline import MARTS, Warehouse
from .plans.quality import all_checks
from .plans.rules import RULES
from .sources.export import read_shards


def failing_checks(warehouse: Warehouse, daily_root: str, intraday_root: str) -> list[str]:
    """One line per check or rule that found something. Only counts reach the driver."""
    spark = warehouse.spark
    daily, intraday = read_shards(spark, daily_root), read_shards(spark, intraday_root)
    failures = []
    for name, found in all_checks(spark, daily, intraday, warehouse.staged(), warehouse.cfg).items():
        rows = found.count()
        if rows:
            failures.append(f"{name}: {rows} failing rows")
    tables = {"sessions": warehouse.sessions, "first_visits": warehouse.first_visits}
    for name, rules in RULES.items():
        table = tables[name]() if name in tables else warehouse.mart(name)
        failures += [f"{name}: {r.rule}: {r.failures} failures" for r in rules.violations(table).collect()]
    return failures


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="trailweave", description="Refresh the warehouse of an event export.")
    parser.add_argument("--daily", required=True, help="root of the daily shards")
    parser.add_argument("--intraday", required=True, help="root of the intraday shards")
    parser.add_argument("--out", required=True, help="root of the warehouse")
    parser.add_argument("--as-of", type=date.fromisoformat, default=date.today(), help="date of the run (yyyy-mm-dd)")
    parser.add_argument("--week-start", default="MONDAY")
    parser.add_argument("--lookback-days", type=int, default=3)
    parser.add_argument("--plp-until", type=date.fromisoformat, help="list-page report ignores events from this date on")
    parser.add_argument("--max-null-user-pct", type=float, default=1.0, help="events without a user id that a check lets pass")
    parser.add_argument("--max-missing-engagement-pct", type=float, default=60.0, help="sessions without the engagement parameter")
    parser.add_argument("--min-volume-vs-median-pct", type=float, default=5.0, help="share of the median day below which volume collapsed")
    parser.add_argument("--keep-snapshots", type=int, default=3, help="versions kept of tables that are rewritten whole")
    parser.add_argument("--incremental", action="store_true", help="recompute the trailing window only")
    parser.add_argument("--only", nargs="*", choices=sorted(MARTS), help="refresh these marts from the stored tables")
    parser.add_argument("--checks", action="store_true", help="run the quality checks afterwards; failures set the exit code")
    args = parser.parse_args(argv)

    spark = configure(SparkSession.builder.appName("trailweave").getOrCreate())
    cfg = EngineConfig(
        as_of_date=args.as_of,
        week_start_day=args.week_start,
        lookback_days=args.lookback_days,
        plp_until_date=args.plp_until,
        max_null_user_pct=args.max_null_user_pct,
        max_missing_engagement_pct=args.max_missing_engagement_pct,
        min_volume_vs_median_pct=args.min_volume_vs_median_pct,
        keep_snapshots=args.keep_snapshots,
    )
    warehouse = Warehouse(spark, cfg, args.out)
    if args.only:
        for name in args.only:
            warehouse.refresh_mart(name, args.incremental)
    else:
        warehouse.refresh(args.daily, args.intraday, args.incremental)
    failures = failing_checks(warehouse, args.daily, args.intraday) if args.checks else []
    print("\n".join(failures) or "no failing checks" if args.checks else "done")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
