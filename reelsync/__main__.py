"""Command line: the jobs the reference runs, as Spark applications.

    python -m reelsync sync   SOURCE --root ROOT [--max-changes N]
        one pass: the first run is a full load, later runs are incremental
    python -m reelsync stream SOURCE --root ROOT [--every "1 second"] [--passes N]
        passes on a timer until stopped (or N of them)
    python -m reelsync copy   SOURCE --root ROOT [--on-orphans drop] [--any-keys]
        copy the five tables into ROOT/tables and print the parity report; text
        ids must be uuids unless --any-keys

SOURCE is one of
    --parquet DIR      folders DIR/film_work, DIR/genre, ...
    --catalog PREFIX   catalog tables PREFIXfilm_work, ... (for example "films.")
    --jdbc URL         a relational database; options as --jdbc-option name=value
    --sf-dir DIR       the stand-in views over the test tables (sources.fixtures)

Outputs go below ROOT, which should be shared storage on a cluster.
"""

from __future__ import annotations

import argparse
import json


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="reelsync")
    sub = parser.add_subparsers(dest="command", required=True)
    sync = sub.add_parser("sync", help="full load on the first run, else an incremental pass")
    stream = sub.add_parser("stream", help="passes on a timer")
    copy = sub.add_parser("copy", help="insert-if-absent copy of the five tables")
    for p in (sync, stream):
        p.add_argument("--max-changes", type=int, default=None)
    stream.add_argument("--every", default="1 second")
    stream.add_argument("--passes", type=int, default=None, help="stop after so many passes")
    copy.add_argument("--any-keys", action="store_true", help="ids need not be uuids")
    copy.add_argument("--on-orphans", choices=["fail", "drop"], default="fail")
    for p in (sync, stream, copy):
        source = p.add_mutually_exclusive_group(required=True)
        for name in ("--parquet", "--catalog", "--jdbc", "--sf-dir"):
            source.add_argument(name)
        p.add_argument("--jdbc-option", action="append", default=[], metavar="NAME=VALUE")
        p.add_argument("--root", required=True)
        p.add_argument("--master", default=None, help="e.g. local[8]; default: the cluster's")
    return parser.parse_args(argv)


def _opener(spark, args: argparse.Namespace):
    """A function that opens the tables as they are when it is called."""
    from .sources import film, fixtures
    if args.parquet:
        return lambda: film.from_parquet(spark, args.parquet)
    if args.catalog is not None:
        return lambda: film.from_catalog(spark, args.catalog)
    if args.jdbc:
        options = dict(o.split("=", 1) for o in args.jdbc_option)
        return lambda: film.from_jdbc(spark, args.jdbc, **options)
    return lambda: fixtures.film_tables(spark, args.sf_dir)


def _sources(spark, args: argparse.Namespace) -> dict:
    """The copy job's source tables, with their source column names."""
    from .schemas import RENAMES
    from .sources.fixtures import source_tables
    if args.sf_dir:
        return source_tables(spark, args.sf_dir)
    back = {new: old for old, new in RENAMES.items()}
    return {name: df.withColumnsRenamed(back) for name, df in _opener(spark, args)().as_dict().items()}


def _report(result) -> str:
    return json.dumps({"pass_id": result.pass_id, "version": result.version, "documents": result.documents,
                       "positions": {k: v.isoformat() if v else None for k, v in result.positions.items()}})


def main(argv: list[str] | None = None) -> int:
    args = _arguments(argv)

    from pyspark.sql import SparkSession

    from .session import build_session
    spark = build_session(args.master) if args.master else SparkSession.builder.getOrCreate()
    root = args.root.rstrip("/")
    if args.command == "copy":
        from .operators.copy import copy_tables
        sources = _sources(spark, args)
        text_ids = all(dict(df.dtypes)["id"] == "string" for df in sources.values())
        report = copy_tables(sources, f"{root}/tables", on_orphans=args.on_orphans,
                             uuids=text_ids and not args.any_keys)
        for row in report.orderBy("table_name").collect():
            print(json.dumps(row.asDict()))
        return 0

    from .plans.load import SyncPaths, incremental_pass, timed_passes
    paths = SyncPaths(f"{root}/documents", f"{root}/positions")
    if args.command == "sync":
        print(_report(incremental_pass(_opener(spark, args)(), paths, max_changes=args.max_changes)))
    else:
        timed_passes(spark, _opener(spark, args), paths, every=args.every, passes=args.passes,
                     max_changes=args.max_changes, on_pass=lambda r: print(_report(r), flush=True))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
