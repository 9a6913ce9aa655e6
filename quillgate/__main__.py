"""Command line: ``list`` queries, ``run`` one or more over a folder of tables, ``gate`` a split (exit status 1 if it fails), ``plan`` shows a query's plan."""

from __future__ import annotations

import argparse
import importlib
import sys

from pyspark.sql import SparkSession


def known() -> dict:
    from .plans import catalogue

    try:
        more = importlib.import_module("quillgate.llm.queries").QUERIES
    except ModuleNotFoundError as e:
        if not (e.name or "").startswith("quillgate.llm"):
            raise
        more = {}
    return {**catalogue.QUERIES, **more}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser("quillgate")
    sub = p.add_subparsers(dest="what", required=True)
    sub.add_parser("list")
    for name in ("run", "plan"):
        s = sub.add_parser(name)
        s.add_argument("query", nargs="+")
        s.add_argument("--data", required=True)
        if name == "run":
            s.add_argument("--out", help="folder for Parquet; without it the first rows are shown")
            s.add_argument("--format", choices=("parquet", "jsonl", "csv", "markdown"), default="parquet")
    s = sub.add_parser("gate")
    s.add_argument("--data", required=True)
    a = p.parse_args(argv)
    queries = known()
    if a.what == "list":
        for n, f in sorted(queries.items()):
            print(n, ((f.__doc__ or "").strip().split("\n")[0]), sep="\t")
        return 0
    spark = SparkSession.builder.appName("quillgate").getOrCreate()
    if a.what == "gate":
        row = queries["gate_status"](spark, a.data).first()
        print(row["status"], row["n_problems"])
        return int(row["status"] != "PASS")
    missing = [q for q in a.query if q not in queries]
    if missing:
        print("unknown:", ", ".join(missing), file=sys.stderr)
        return 2
    from .sources import sinks

    for q in a.query:
        df = queries[q](spark, a.data)
        if a.what == "plan":
            df.explain("formatted")
        elif not a.out:
            df.show(20, truncate=False)
        elif a.format == "parquet":
            sinks.publish(df, f"{a.out}/{q}")
        elif a.format == "jsonl":
            sinks.write_lines(df, f"{a.out}/{q}")
        elif a.format == "csv":
            sinks.write_csv(df, f"{a.out}/{q}")
        else:
            print(sinks.report_text(df, q))
    return 0


if __name__ == "__main__":
    sys.exit(main())
