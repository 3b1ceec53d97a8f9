"""Command line: ``python -m kestrel <job> ...`` (see ``--help``)."""

from __future__ import annotations

import argparse

from kestrel.plans import jobs
from kestrel.session import build_session


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="kestrel")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    sub = p.add_subparsers(dest="job", required=True)

    t = sub.add_parser("trip", help="mean amount per rounded trip distance")
    t.add_argument("input"), t.add_argument("output")
    t.add_argument("--dialect", choices=["mapreduce", "pig", "sql"], default="mapreduce")
    t.add_argument("--min-count", type=int, default=1)

    s = sub.add_parser("simple", help="mean of key,value lines per key")
    s.add_argument("input"), s.add_argument("output")

    j = sub.add_parser("join", help="employees x departments on dno")
    j.add_argument("employees"), j.add_argument("departments"), j.add_argument("output")
    j.add_argument("--names-only", action="store_true")

    a = sub.add_parser("add", help="block sum of two sparse matrices")
    a.add_argument("rows", type=int), a.add_argument("cols", type=int)
    a.add_argument("m"), a.add_argument("n"), a.add_argument("output")
    a.add_argument("--inner", action="store_true")
    a.add_argument("--cell-format", default="\t%.3f")
    a.add_argument("--block", type=int, nargs=2, default=None)
    a.add_argument("--duplicates", choices=["error", "sum", "max"], default="error")
    a.add_argument("--tuple-text", action="store_true")

    g = sub.add_parser("graph", help="group sizes after min-label propagation")
    g.add_argument("input"), g.add_argument("output")
    g.add_argument("--rounds", type=int, default=5)
    g.add_argument("--explicit-only", action="store_true")

    args = p.parse_args(argv)
    spark = build_session(master=args.master)
    if args.job == "trip":
        jobs.trip_job(spark, args.input, args.output, args.dialect, args.min_count)
    elif args.job == "simple":
        jobs.simple_mean_job(spark, args.input, args.output)
    elif args.job == "join":
        jobs.join_job(spark, args.employees, args.departments, args.output, keyed=not args.names_only)
    elif args.job == "add":
        jobs.add_job(spark, args.m, args.n, args.rows, args.cols, args.output,
                     "inner" if args.inner else "outer", args.cell_format,
                     tuple(args.block) if args.block else None, args.duplicates, args.tuple_text)
    elif args.job == "graph":
        jobs.graph_job(spark, args.input, args.output, args.rounds, not args.explicit_only)
    spark.stop()


if __name__ == "__main__":
    main()
