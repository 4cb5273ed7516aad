"""Cluster entry points (``spark-submit -m``-style): one command per job.

    python -m kollektiv.jobs static  --landing L --bronze B [--date D] [--ts T]
    python -m kollektiv.jobs live    --landing L --bronze B [--date D] [--ts T]
    python -m kollektiv.jobs stream  --landing L --bronze B --checkpoint C [--once]
    python -m kollektiv.jobs silver  --bronze B --silver S [--days D1,D2]
    python -m kollektiv.jobs number  --silver S --numbered N
    python -m kollektiv.jobs count   --silver S --counted C [--zone Z]
    python -m kollektiv.jobs models  --bronze B --gold G [--database D] [--silver S [--numbered N] [--counted C]] [--zone Z] [--threads N]
    python -m kollektiv.jobs attach  --gold G --database D
    python -m kollektiv.jobs test    --bronze B

``live`` loads one snapshot: every XML file under ``--landing`` belongs to it
(point it at the run's own folder).  ``stream`` instead watches a landing folder
of ``snapshot=<yyyy-MM-ddTHHmmss>/`` folders.  The run clock is an argument
(SCL-12); by default the UTC time of the launch and its date.  Paths may be any Hadoop file system URI the cluster can reach.
Exit status 1 means a gate or a declared test failed.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import sys

from kollektiv.operators.quality import DataQualityError


def _clock(args) -> tuple[_dt.datetime, _dt.date]:
    ts = _dt.datetime.fromisoformat(args.ts) if args.ts else _dt.datetime.now(_dt.timezone.utc)
    day = _dt.date.fromisoformat(args.date) if args.date else ts.date()
    return ts, day


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="kollektiv.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    helps = {"static": "NeTEx ZIP archives under --landing -> seven bronze tables",
             "live": "one SIRI snapshot (all XML files under --landing) -> its day in bronze"}
    for name in ("static", "live"):
        s = sub.add_parser(name, help=helps[name])
        s.add_argument("--landing", required=True)
        s.add_argument("--bronze", required=True)
        s.add_argument("--date")
        s.add_argument("--ts")
        if name == "live":
            s.add_argument("--native", action="store_true", help="parse with Spark's XML reader")
        if name == "static":
            s.add_argument("--stop-ids", choices=("hash", "position"), default="hash")
            s.add_argument("--quay-details", action="store_true")
    s = sub.add_parser("replay", help="load repaired members of a static run: archives under --landing that held its rejects")
    s.add_argument("--landing", required=True)
    s.add_argument("--bronze", required=True)
    s.add_argument("--date", required=True, help="the run's day")
    s.add_argument("--ts", required=True, help="the run's ISO timestamp")
    s.add_argument("--quay-details", action="store_true")
    s = sub.add_parser("stream", help="watch snapshot=<ts>/ folders; newest passing snapshot per day")
    s.add_argument("--landing", required=True)
    s.add_argument("--bronze", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--once", action="store_true", help="process what has landed, then stop")
    s.add_argument("--max-files", type=int, default=1000)
    s.add_argument("--marker", help="name of the file that a writer puts into a snapshot folder last")
    s.add_argument("--settle", type=float, help="seconds without a further file after which a snapshot is whole "
                                                "(default 30; not with --once or --marker)")
    s.add_argument("--native", action="store_true", help="parse with Spark's XML reader")
    s.add_argument("--silver", help="also keep this silver timetable current, day by day")
    s = sub.add_parser("silver", help="recompute the silver timetable for given days (default all)")
    s.add_argument("--bronze", required=True)
    s.add_argument("--silver", required=True)
    s.add_argument("--days", help="comma-separated ingestion days to recompute (default: all)")
    s.add_argument("--zone")
    s = sub.add_parser("models", help="publish the nine models (views) and rebuild the gold tables")
    s.add_argument("--bronze", required=True)
    s.add_argument("--gold", required=True)
    s.add_argument("--zone")
    s.add_argument("--threads", type=int, default=4)
    s.add_argument("--database", default="kollektiv", help="catalog database of the published views and tables")
    s.add_argument("--latest-lines-only", action="store_true", help="one dim_line row per line")
    s.add_argument("--silver", help="read the silver timetable maintained by the silver job")
    s.add_argument("--numbered", help="with --silver: take the fact's numbers from the table maintained by the number job")
    s.add_argument("--counted", help="with --silver: take distinct journeys and stops from the tables of the count job")
    s = sub.add_parser("count", help="bring the supports of journeys and stops up to the newest silver: replaced days only")
    s.add_argument("--silver", required=True)
    s.add_argument("--counted", required=True)
    s.add_argument("--zone")
    s = sub.add_parser("number", help="bring the numbered timetable up to the newest silver: changed ranges only")
    s.add_argument("--silver", required=True)
    s.add_argument("--numbered", required=True)
    s = sub.add_parser("attach", help="published names of a finished run, in this session's catalog, at their newest versions")
    s.add_argument("--gold", required=True)
    s.add_argument("--database", default="kollektiv")
    s = sub.add_parser("test", help="run the 17 declared column tests; exit 1 on any failure")
    s.add_argument("--bronze", required=True)
    s.add_argument("--zone")
    args = p.parse_args(argv)

    from kollektiv.session import build_session
    spark = build_session(app=f"kollektiv-{args.job}")
    try:
        if args.job == "static":
            from kollektiv.plans.static_ingest import ingest_archives
            ts, day = _clock(args)
            out = ingest_archives(spark, args.landing, args.bronze, ts, day, args.stop_ids, args.quay_details)
            print(json.dumps({"status": out.status, "rejected_documents": out.rejected_documents, "rows": out.rows}))
        elif args.job == "replay":
            from kollektiv.plans.quarantine import replay
            ts, day = _clock(args)
            print(json.dumps(replay(spark, args.landing, args.bronze, ts, day, args.quay_details).__dict__))
        elif args.job == "live":
            from kollektiv.plans.live_ingest import ingest_snapshot
            from kollektiv.sources.archive import read_documents
            ts, day = _clock(args)
            out = ingest_snapshot(read_documents(spark, args.landing), f"{args.bronze.rstrip('/')}/bronze_live_timetable",
                                  ts, day, native=args.native)
            print(json.dumps(out.__dict__))
        elif args.job == "stream":
            from kollektiv.streaming.live import run_live_stream
            verdicts = f"{args.bronze.rstrip('/')}/live_timetable_verdicts"
            q = run_live_stream(spark, args.landing, f"{args.bronze.rstrip('/')}/bronze_live_timetable",
                                args.checkpoint, available_now=args.once, verdict_path=verdicts, marker=args.marker,
                                max_files_per_trigger=args.max_files, native=args.native,
                                silver_path=args.silver, settle_seconds=args.settle)
            q.awaitTermination()
            print(json.dumps({"verdicts": verdicts}))
        elif args.job == "silver":
            from kollektiv.plans.models import refresh_silver_timetable
            days = [_dt.date.fromisoformat(d) for d in args.days.split(",")] if args.days else None
            done = refresh_silver_timetable(spark, args.bronze, args.silver, days, zone=args.zone)
            print(json.dumps({"refreshed_days": [str(d) for d in done]}))
        elif args.job == "count":
            from kollektiv.plans.models import refresh_counted_dimensions
            done = refresh_counted_dimensions(spark, args.silver, args.counted, zone=args.zone)
            print(json.dumps({name: c.__dict__ for name, c in done.items()}))
        elif args.job == "number":
            from kollektiv.plans.models import refresh_numbered_timetable
            print(json.dumps(refresh_numbered_timetable(spark, args.silver, args.numbered).__dict__))
        elif args.job == "models":
            from kollektiv.plans.models import run_models
            timings: dict = {}
            paths = run_models(spark, args.bronze, args.gold, zone=args.zone, threads=args.threads, timings=timings,
                               latest_lines_only=args.latest_lines_only, silver_path=args.silver, database=args.database,
                               numbered_path=args.numbered, counted_root=args.counted)
            print(json.dumps({"tables": paths, "seconds": timings}))
        elif args.job == "attach":
            from kollektiv.sinks.catalog import Database
            print(json.dumps({"database": args.database, "names": Database(spark, args.database, args.gold).attach()}))
        elif args.job == "test":
            from kollektiv.operators.quality import run_column_tests
            from kollektiv.plans.models import build_models, read_bronze
            from kollektiv.session import staging_scope
            with staging_scope(spark):               # staged silver and numbering go away afterwards
                results = [r.asDict() for r in run_column_tests(
                    build_models(*read_bronze(spark, args.bronze), zone=args.zone,
                                 materialize_silver=True)).collect()]
            print(json.dumps(results))
            return 1 if any(r["status"] != "pass" for r in results) else 0
    except DataQualityError as e:
        print(json.dumps({"status": "failed_gate", "error": str(e)}))
        return 1
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
