"""Command line: list, run or explain the named queries.

    python -m stratum list
    python -m stratum run class_summary --sf /root/testdata/sf0.01 [--rows 20]
    python -m stratum explain rank_dense --sf /root/testdata/sf0.01 [--mode formatted]
    python -m stratum sql class_summary          # the oracle SQL for a query
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="stratum")
    ap.add_argument("command", choices=["list", "run", "explain", "sql"])
    ap.add_argument("query", nargs="?")
    ap.add_argument("--sf", default="/root/testdata/sf0.01", help="folder with the Parquet tables")
    ap.add_argument("--rows", type=int, default=20, help="rows to display (display only)")
    ap.add_argument("--mode", default="formatted", help="explain mode")
    ap.add_argument("--master", default=None, help="only for local runs, e.g. local[8]")
    args = ap.parse_args(argv)

    from .plans.catalogue import ORACLE, QUERIES

    if args.command == "list":
        for name in sorted(QUERIES):
            print(f"{name:22s} {(QUERIES[name].__doc__ or '').strip()}")
        return 0
    if args.query not in QUERIES:
        print(f"unknown query {args.query!r}; try `python -m stratum list`", file=sys.stderr)
        return 2
    if args.command == "sql":
        print(ORACLE.get(args.query, "-- no oracle SQL"))
        return 0

    from .session import build_session
    spark = build_session("stratum-cli", master=args.master)
    df = QUERIES[args.query](spark, args.sf)
    if args.command == "explain":
        df.explain(args.mode)
    else:
        df.show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
