"""Runs queries over a folder of tables: `python -m corpusloom list`, `python -m corpusloom run NAME FOLDER --out PATH`, or by spark-submit."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from corpusloom.plans import registry


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="corpusloom")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list", help="names of the queries")
    run = commands.add_parser("run", help="run a query")
    run.add_argument("name")
    run.add_argument("folder")
    run.add_argument("--out", help="write parquet there instead of showing rows")
    given = parser.parse_args(argv)
    queries = registry.queries()
    if given.command == "list":
        print("\n".join(sorted(queries)))
        return 0
    if given.name not in queries:
        print(f"no query {given.name!r}", file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName(f"corpusloom {given.name}").getOrCreate()
    df = queries[given.name](spark, given.folder)
    if given.out:
        df.write.parquet(given.out)
    else:
        df.show(20, truncate=80)
    return 0


if __name__ == "__main__":
    sys.exit(main())
