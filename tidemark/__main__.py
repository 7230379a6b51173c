"""Command line for the lakehouse jobs (one Spark session per call).

    python -m tidemark generate   --tables /root/testdata/sf0.01 --lake /shared/lake
    python -m tidemark bronze-to-silver --lake /shared/lake --ingest_date 1998-01-01
    python -m tidemark bronze-to-silver --lake /shared/lake --ingest_from 1995-01-01 --ingest_to 2001-08-01
    python -m tidemark silver-to-gold   --lake /shared/lake --ingest_from ... --ingest_to ...
    python -m tidemark run-day          --lake /shared/lake --ingest_date 2001-08-01
    python -m tidemark backfill         --lake /shared/lake --ingest_from ... --ingest_to ...
    python -m tidemark verify           --lake /shared/lake --tables /root/testdata/sf0.01

Each prints one ``METRICS {...}`` JSON line; a tripped breaker or a failed assertion
exits non-zero (silver untouched, quarantine written).
"""

from __future__ import annotations

import argparse
import json
import sys


def _session(args):
    from tidemark.session import build_session, checkpoint_root, ensure_conf
    spark = build_session(master=args.master, app="tidemark-" + args.command)
    ensure_conf(spark)
    checkpoint_root(spark)
    return spark


def _range(args, ap):
    if args.ingest_date:
        return args.ingest_date, args.ingest_date
    if args.ingest_from and args.ingest_to:
        return args.ingest_from, args.ingest_to
    ap.error("pass --ingest_date, or both --ingest_from and --ingest_to")


def _silver_json(run) -> dict:
    return {"ingest_dates": [run.dates[0], run.dates[-1]], "partitions": len(run.dates), "rows_in": run.rows_in,
            "valid": run.valid, "rejected": run.rejected, "reject_rate_pct": round(100 * run.reject_rate, 3),
            "reject_reasons": run.reject_reasons, "duplicates_removed": run.duplicates_removed,
            "silver_rows": run.silver_rows, "seconds": run.seconds}


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="python -m tidemark")
    ap.add_argument("command", choices=["generate", "bronze-to-silver", "silver-to-gold", "run-day", "backfill",
                                        "verify"])
    ap.add_argument("--lake", required=True, help="lake root (shared storage)")
    ap.add_argument("--tables", help="folder of the source Parquet tables (generate, verify)")
    ap.add_argument("--grain", default="month", choices=["day", "month"])
    ap.add_argument("--ingest_date")
    ap.add_argument("--ingest_from")
    ap.add_argument("--ingest_to")
    ap.add_argument("--max_reject_rate", type=float, default=0.05)
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)

    from tidemark.operators.gates import GateFailed
    from tidemark.plans import generate, medallion
    from tidemark.plans.lakebuild import write_bronze
    lake = medallion.Lake(args.lake.rstrip("/"), grain=args.grain, gold_grain=args.grain)
    spark = _session(args)
    try:
        if args.command == "generate":
            parts = write_bronze(spark, args.tables, lake.bronze, args.grain)
            out = {"partitions": len(parts), "first": parts[0], "last": parts[-1]}
        elif args.command == "bronze-to-silver":
            start, end = _range(args, ap)
            out = _silver_json(medallion.bronze_to_silver(spark, lake, start, end, args.max_reject_rate,
                                                          require_all=start == end))
        elif args.command == "silver-to-gold":
            start, end = _range(args, ap)
            out = medallion.silver_to_gold(spark, lake, start, end)
        elif args.command in ("run-day", "backfill"):
            start, end = _range(args, ap)
            fn = medallion.run_day if args.command == "run-day" else medallion.backfill
            res = fn(spark, lake, start, args.max_reject_rate) if args.command == "run-day" else \
                fn(spark, lake, start, end, args.max_reject_rate)
            out = {"silver": _silver_json(res["silver"]), "gold": res["gold"]}
        else:
            from tidemark.sources.tables import Tables
            t = Tables(spark, args.tables)
            _, summary = medallion.verify(spark, lake, generate.order_universe(t.orders, t.customer, t.nation,
                                                                               args.grain))
            out = summary.first().asDict()
        print("METRICS " + json.dumps(out, default=str))
        return 0
    except (medallion.BreakerTripped, medallion.GoldAssertionFailed, GateFailed, FileNotFoundError) as e:
        print("FAILED " + str(e), file=sys.stderr)
        return 2
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
