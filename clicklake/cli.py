"""Job entry points (``python -m clicklake.cli`` locally, ``run_job.py`` with spark-submit).

    spark-submit --py-files clicklake.zip run_job.py bronze --process-datetime 2024-01-02 \
        --source s3a://raw/events/ --bronze ...
    spark-submit --py-files clicklake.zip run_job.py silver --process-datetime 2024-01-02 --bronze ... --silver ...
    spark-submit --py-files clicklake.zip run_job.py hourly --process-datetime 2024-01-02T05:00:00 --source ... --table ...

``--process-datetime`` may be repeated or given as a range ``START..END`` to
backfill several days in one pass.  A failed quality gate exits with code 1.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import logging
import sys

from .plans import bronze as bronze_plan
from .plans import silver as silver_plan
from .session import CLUSTER_PROFILE, build_session
from .sinks import ddl, writers


def parse_days(values: list[str]) -> list[dt.date]:
    days: list[dt.date] = []
    for v in values:
        if ".." in v:
            lo, hi = (dt.date.fromisoformat(x) for x in v.split(".."))
            days += [lo + dt.timedelta(days=i) for i in range((hi - lo).days + 1)]
        else:
            days.append(dt.date.fromisoformat(v[:10]))
    return sorted(set(days))


def main(argv: list[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s [%(levelname)s] %(message)s")
    p = argparse.ArgumentParser(prog="clicklake")
    sub = p.add_subparsers(dest="job", required=True)

    b = sub.add_parser("bronze", help="daily drop -> gate -> bronze")
    b.add_argument("--process-datetime", action="append", required=True)
    b.add_argument("--source", required=True, help="folder holding events_YYYY-MM-DD.jsonl.gz")
    b.add_argument("--bronze", required=True, help="bronze table path")
    b.add_argument("--metrics", help="quality metrics history path")
    b.add_argument("--layout", choices=("processing_date", "event_date"), default="processing_date")
    b.add_argument("--no-gate", action="store_true")
    b.add_argument("--size-change-bounds", nargs=2, type=float, metavar=("LOW", "HIGH"), help="allowed day-to-day change of rows")
    b.add_argument("--bad-lines", help="table path of lines that do not parse (default: <bronze>_bad_lines)")
    b.add_argument("--catalog", help="catalog prefix for the namespaces")

    s = sub.add_parser("silver", help="bronze -> validate -> sessionize -> merge")
    s.add_argument("--process-datetime", action="append", required=True)
    s.add_argument("--bronze", required=True)
    s.add_argument("--silver", required=True)
    s.add_argument("--quarantine")
    s.add_argument("--mode", choices=("merge", "overwrite", "sql", "table"), default="merge")
    s.add_argument("--location", help="with --mode table: folder of the table where it is to be created")

    h = sub.add_parser("hourly", help="Hive-partitioned raw Parquet hour -> bronze snapshot")
    h.add_argument("--process-datetime", required=True)
    h.add_argument("--source", required=True)
    h.add_argument("--table", required=True)
    h.add_argument("--mode", choices=("replace", "partitions"), default="replace")

    p.add_argument("--conf", action="append", default=[], help="key=value session setting")
    p.add_argument("--cluster-profile", action="store_true", help="start from session.CLUSTER_PROFILE")
    args = p.parse_args(argv)
    conf = dict(kv.split("=", 1) for kv in args.conf)

    spark = build_session(f"clicklake-{args.job}", conf, profile=CLUSTER_PROFILE if args.cluster_profile else None)
    try:
        if args.job == "bronze":
            writers.create_databases(spark, bronze_plan.NAMESPACES, args.catalog)
            bounds = {"size_change_bounds": tuple(args.size_change_bounds)} if args.size_change_bounds else {}
            res = bronze_plan.land_daily(spark, args.source, args.bronze, parse_days(args.process_datetime),
                                         layout=args.layout, gate=not args.no_gate, metrics_path=args.metrics,
                                         bad_lines_path=args.bad_lines, **bounds)
            print(json.dumps({"status": res.status, "published": [str(d) for d in res.published_days]}))
        elif args.job == "silver":
            if args.mode == "table" and args.location:
                ddl.create_silver_table(spark, args.silver, args.location)
            print(silver_plan.run(spark, args.bronze, args.silver, parse_days(args.process_datetime),
                                  quarantine_path=args.quarantine, mode=args.mode))
        else:
            n, sample = bronze_plan.ingest_hourly(spark, args.source, args.table,
                                                  dt.datetime.fromisoformat(args.process_datetime), args.mode)
            print(json.dumps({"rows": n, "sample": [r.asDict() for r in sample]}, default=str))
        return 0
    except bronze_plan.GateFailed as e:
        logging.error("%s", e)
        return 1
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
