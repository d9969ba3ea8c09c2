"""Command line: run registered queries as Spark jobs.

    spark-submit quarry/cli.py list
    spark-submit quarry/cli.py run group_avg --sf-dir /data/sf100 --output /shared/out/group_avg
    spark-submit quarry/cli.py explain group_avg --sf-dir /data/sf100

``run`` writes the result as Parquet to ``--output`` (or shows a few rows
when no output is given).  Ship the package with ``--py-files`` on a cluster.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv: list[str] | None = None) -> int:
    from quarry.plans import all_oracles, all_queries
    from quarry.session import get_session, remove_tables

    ap = argparse.ArgumentParser(prog="quarry")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    run = sub.add_parser("run")
    run.add_argument("names", nargs="+")
    run.add_argument("--sf-dir", required=True)
    run.add_argument("--output")
    run.add_argument("--master")
    exp = sub.add_parser("explain")
    exp.add_argument("names", nargs="+")
    exp.add_argument("--sf-dir", required=True)
    exp.add_argument("--master")
    args = ap.parse_args(argv)

    queries = all_queries()
    if args.cmd == "list":
        oracles = all_oracles()
        for name in sorted(queries):
            print(f"{name:28s} {'sql-oracle' if name in oracles else 'rows-only'}")
        return 0
    spark = get_session(args.master, app_name="quarry-cli")
    if args.cmd == "explain":
        for name in args.names:
            print(f"== {name} ==")
            queries[name](spark, args.sf_dir).explain("formatted")
        return 0
    for name in args.names:
        df = queries[name](spark, args.sf_dir)
        if args.output:
            df.write.mode("overwrite").parquet(os.path.join(args.output, name) if len(args.names) > 1 else args.output)
        else:
            df.show(20, truncate=False)
        remove_tables()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
