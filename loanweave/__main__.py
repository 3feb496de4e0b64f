"""Command line: ``python -m loanweave {daily,watch,query} ...`` (or spark-submit)."""

from __future__ import annotations

import argparse
import datetime as dt
import json

from loanweave.session import build_session


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="loanweave")
    sub = ap.add_subparsers(dest="cmd", required=True)
    d = sub.add_parser("daily", help="dated run: arrival check, drift, whole mart")
    d.add_argument("--drop", required=True)
    d.add_argument("--out", required=True)
    d.add_argument("--date", type=dt.date.fromisoformat, default=dt.date.today())
    d.add_argument("--observed", action="store_true", help="also write the *_observed tables")
    d.add_argument("--stop-on-drift", action="store_true",
                   help="do not build the mart when the outer schema differs from yesterday's")
    w = sub.add_parser("watch", help="process snapshot drops as a file stream")
    w.add_argument("--drop", required=True)
    w.add_argument("--out", required=True)
    w.add_argument("--checkpoint")
    w.add_argument("--observed", action="store_true")
    w.add_argument("--continuous", action="store_true", help="keep watching (default: drain and stop)")
    q = sub.add_parser("query", help="run one registered query and write it as parquet")
    q.add_argument("name")
    q.add_argument("--sf-dir", required=True)
    q.add_argument("--out", required=True)
    args = ap.parse_args(argv)

    spark = build_session()
    if args.cmd == "daily":
        from loanweave.plans.daily import run_daily
        print(json.dumps(run_daily(spark, args.drop, args.out, args.date, observed=args.observed,
                                   stop_on_drift=args.stop_on_drift), default=str))
    elif args.cmd == "watch":
        from loanweave.streaming.drops import watch_drops
        watch_drops(spark, args.drop, args.out, args.checkpoint, args.observed,
                    available_now=not args.continuous).awaitTermination()
    else:
        from loanweave.plans.catalog import QUERIES
        QUERIES[args.name](spark, args.sf_dir).write.mode("overwrite").parquet(args.out)


if __name__ == "__main__":
    main()
