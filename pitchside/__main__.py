"""Command line: print registered queries (result tables are printed only here).

    python -m pitchside list
    python -m pitchside show report_teams --sf /root/testdata/sf0.01 [--rows 20]
"""

from __future__ import annotations

import argparse

from .registry import QUERIES
from .session import build_session


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="pitchside")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list query keys")
    show = sub.add_parser("show", help="run one query and print its rows")
    show.add_argument("key", choices=sorted(QUERIES))
    show.add_argument("--sf", default="/root/testdata/sf0.01")
    show.add_argument("--rows", type=int, default=20)
    show.add_argument("--master", default="local[8]")
    args = ap.parse_args(argv)
    if args.cmd == "list":
        for k in sorted(QUERIES):
            print(k)
        return
    spark = build_session(master=args.master)
    QUERIES[args.key](spark, args.sf).show(args.rows, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
