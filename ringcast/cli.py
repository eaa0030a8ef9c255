"""Command line: the two export commands on Spark.

    python -m ringcast -o out.parquet -s token-range ks.events -K id -S 2400 --root /data
    python -m ringcast -o out/ -b event_type query \\
        "SELECT * FROM events WHERE user_id = :uid" --params p.ndjson --table events=/data/ks/events

Prints the export result as one JSON line. ``-C`` is accepted for
compatibility and warned about: Spark's scheduler decides how many tasks run at once.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _comma(text: str) -> list[str]:
    items = [t.strip() for t in text.split(",") if t.strip()]
    if not items:
        raise argparse.ArgumentTypeError("empty list")
    return items


def _markers(text: str) -> dict[str, str]:
    out = {}
    for item in _comma(text):
        name, sep, mtype = item.partition(":")
        if not sep or not name or not mtype:
            raise argparse.ArgumentTypeError(f"marker must be name:type, got {item!r}")
        out[name] = mtype
    return out


# Formats accepted after '@' in --table.
TABLE_FORMATS = ("parquet", "csv", "json", "orc", "text", "avro")


def _table(text: str) -> tuple[str, str, str]:
    name, sep, rest = text.partition("=")
    if not sep or not name or not rest:
        raise argparse.ArgumentTypeError(f"table must be name=path[@format], got {text!r}")
    path, at, fmt = rest.rpartition("@")
    if at and fmt in TABLE_FORMATS:  # '@' also appears in URLs (abfss://container@account...)
        return name, path, fmt
    return name, rest, "parquet"


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ringcast", description="Export tables or queries with Spark")
    p.add_argument("-o", "--output", required=True, help="output path or URL (file:, s3a:, hdfs:, ...)")
    p.add_argument("-F", "--format", default=None, help="parquet (default), csv, ndjson/jsonl")
    layout = p.add_mutually_exclusive_group()
    layout.add_argument("-s", "--single-file", action="store_true", help="write one file")
    layout.add_argument("-b", "--partition-by", type=_comma, help="Hive partition columns")
    p.add_argument("-T", "--transform", help="SQL run over the rows as table `source` before writing")
    p.add_argument("--mode", default="errorifexists", help="errorifexists, overwrite, append, ignore")
    p.add_argument("--csv-lines", action="store_true",
                   help="CSV input has one record per line: large files are read in parallel splits")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    sub = p.add_subparsers(dest="command", required=True)

    tr = sub.add_parser("token-range", help="full table scan over token ranges")
    tr.add_argument("table", help="{keyspace}.{table}")
    tr.add_argument("-K", "--partition-keys", type=_comma, required=True)
    tr.add_argument("-c", "--columns", type=_comma, default=["*"])
    tr.add_argument("-S", "--splits", type=int, default=None)
    tr.add_argument("-C", "--concurrency", type=int, default=None)
    tr.add_argument("--root", default=None, help="folder of {keyspace}/{table} data (default: catalog)")
    tr.add_argument("--table-format", default="parquet")

    q = sub.add_parser("query", help="run a query, once per parameter line")
    q.add_argument("query")
    q.add_argument("--params", default=None, help="NDJSON file, one object per line")
    q.add_argument("--markers", type=_markers, default=None, help="name:type,... for --params, where the query does not tell a marker's type")
    q.add_argument("--table", type=_table, action="append", default=[],
                   help="name=path[@format], registered for the query")
    q.add_argument("-C", "--max-concurrency", type=int, default=None)
    return p


def _read_table(spark: SparkSession, path: str, fmt: str, multi_line: bool = True):
    if fmt == "csv":
        # Header names, quotes escaped by doubling. Records over several lines (as
        # the sinks write) make each file one task; --csv-lines reads files in
        # parallel splits where no record has a line break. No schema inference:
        # it would read the whole input once more, so columns are text, cast in SQL.
        return (spark.read.option("header", True).option("quote", '"').option("escape", '"')
                .option("multiLine", multi_line).csv(path))
    return spark.read.format(fmt).load(path)


def run(spark: SparkSession, args: argparse.Namespace) -> dict:
    if getattr(args, "concurrency", None) or getattr(args, "max_concurrency", None):
        print("ringcast: -C has no effect; the cluster's cores decide how many tasks run at once", file=sys.stderr)
    from ringcast.plans.export import query_export, token_range_export
    from ringcast.sources.table import load_table

    common = dict(transform=args.transform, fmt=args.format, single_file=args.single_file,
                  partition_by=args.partition_by, mode=args.mode)
    if args.command == "token-range":
        if args.root:
            from ringcast.sources.table import split_table_name

            keyspace, table = split_table_name(args.table)
            df = _read_table(spark, f"{args.root.rstrip('/')}/{keyspace}/{table}", args.table_format, not args.csv_lines)
        else:
            df = load_table(spark, args.table)
        result = token_range_export(spark, df, args.partition_keys, args.output, splits=args.splits,
                                    columns=args.columns, **common)
    else:
        tables = {name: _read_table(spark, path, fmt, not args.csv_lines) for name, path, fmt in args.table}
        result = query_export(spark, args.query, args.output, params_path=args.params,
                              markers=args.markers, tables=tables, **common)
    return {"path": result.path, "format": result.format, "rows": result.rows,
            "seconds": round(result.seconds, 3)}


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    from ringcast.session import build_session

    if args.master:
        spark = build_session(args.master)
    else:  # under spark-submit: keep its master and resources, apply the SQL defaults
        from ringcast.session import apply_defaults, ensure_checkpoint_dir

        spark = SparkSession.builder.getOrCreate()
        apply_defaults(spark)
        ensure_checkpoint_dir(spark)
    from ringcast.session import cleanup_scratch

    try:
        print(json.dumps(run(spark, args)))
    finally:
        cleanup_scratch(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
