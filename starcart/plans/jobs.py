"""Jobs to submit: load a star from source files, and store or print the reports over it.

    spark-submit starcart/plans/jobs.py etl --source DIR --target DIR [--format csv --files 4]
    spark-submit starcart/plans/jobs.py etl --source DIR --jdbc-url URL --jdbc-properties FILE
    spark-submit starcart/plans/jobs.py reports --star DIR [--format csv] [--output DIR]
    spark-submit starcart/plans/jobs.py reports --jdbc-url URL --jdbc-properties FILE --output DIR

``--option KEY=VALUE`` goes to the CSV reader, ``--pattern COLUMN=FORMAT`` tells how a column writes dates
or times (given again for the same column: a further format, tried after the earlier ones; ``ISO`` is ISO text),
``--versioned`` publishes each load as a version of its own, and reads the latest or ``--version N``;
``--hash TABLE=SQL`` reads a table of the database over several connections, ``--input-bytes`` and ``--cores`` size the session, ``--s3a FILE`` (JSON: endpoint, access_key,
secret_key, ...) connects an object store.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from starcart.functions.hot import ADAPTIVE, MEASURE
from starcart.operators import reports
from starcart.plans.refresh import publish_star, read_star, refresh_star, register_views
from starcart.plans.session import prepare, s3a_settings, sized_settings
from starcart.sources.files import read_raw, typed_sources
from starcart.sources.profile import format_profile, source_profile
from starcart.sources.stores import FileStore, JdbcStore
from starcart.sources.versions import VersionedStore


def all_reports(star: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The six business reports and the payment control, none of them run yet."""
    return {
        "top products by number of sales": reports.top_products(star),
        "orders by year and month": reports.orders_by_month(star),
        "orders by city": reports.orders_by_city(star),
        "revenue by year and month": reports.revenue_by_month(star),
        "late deliveries, percent of orders": reports.late_delivery_pct(star),
        "top categories of new customers": reports.top_categories(star),
        "payment control": reports.payment_control(star),
    }


def _pairs(given: list[str] | None) -> dict[str, str]:
    """``KEY=VALUE`` arguments."""
    return dict(pair.split("=", 1) for pair in given or [])


def _patterns(given: list[str] | None) -> dict[str, list[str]]:
    """``COLUMN=FORMAT`` arguments, the formats of a column in their order."""
    found: dict[str, list[str]] = {}
    for column, pattern in (pair.split("=", 1) for pair in given or []):
        found.setdefault(column, []).append(pattern)
    return found


def _store(args: argparse.Namespace, path: str | None) -> FileStore | JdbcStore:
    if args.jdbc_url:
        properties = json.loads(Path(args.jdbc_properties).read_text())
        hashes = _pairs(getattr(args, "hash", None))
        return JdbcStore(args.jdbc_url, properties, args.connections, hashes=hashes)
    return FileStore(path, args.format, getattr(args, "files", None))


def _opened(spark: SparkSession, args: argparse.Namespace) -> FileStore | JdbcStore:
    """Where the reports find the star: the latest version, if it is kept in versions."""
    if args.versioned and args.star:
        return VersionedStore(args.star, args.format).at(spark, args.version)
    return _store(args, args.star)


def _etl(spark: SparkSession, args: argparse.Namespace) -> None:
    patterns = _patterns(args.pattern)
    raw = read_raw(spark, args.source, args.source_format, **_pairs(args.option))
    if args.profile:
        source_profile(raw, patterns).show(1000, truncate=False)
        if patterns:
            format_profile(raw, patterns).show(1000, truncate=False)
    hot = args.hot or (ADAPTIVE if args.source_format == "csv" else MEASURE)
    options = {"date_start": args.date_start, "date_end": args.date_end, "hot": hot, "covering": args.covering}
    sources = typed_sources(raw, patterns)
    if args.versioned and args.target:
        publish_star(spark, sources, VersionedStore(args.target, args.format, args.files), **options)
    else:
        refresh_star(spark, sources, _store(args, args.target), **options)


def _reports(spark: SparkSession, args: argparse.Namespace) -> None:
    star = read_star(spark, _opened(spark, args))
    register_views(star)
    for title, report in all_reports(star).items():
        if args.output:
            name = title.split(",")[0].replace(" ", "_")
            report.write.mode("overwrite").parquet(f"{args.output.rstrip('/')}/{name}")
        else:
            print(title)
            report.show(args.rows, truncate=False)


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description="Star-schema load and reports")
    commands = parser.add_subparsers(required=True)

    etl = commands.add_parser("etl")
    etl.add_argument("--source", required=True)
    etl.add_argument("--source-format", default="csv")
    etl.add_argument("--option", action="append", metavar="KEY=VALUE")
    etl.add_argument("--pattern", action="append", metavar="COLUMN=FORMAT")
    etl.add_argument("--hot", choices=(MEASURE, ADAPTIVE), help="adaptive for CSV, else measure")
    target = etl.add_mutually_exclusive_group(required=True)
    target.add_argument("--target")
    etl.add_argument("--files", type=int)
    etl.add_argument("--profile", action="store_true")
    etl.add_argument("--date-start", default="2000-01-01")
    etl.add_argument("--date-end", default="2030-01-01")
    etl.add_argument("--covering", action="store_true", help="stretch the calendar to the purchases")
    etl.set_defaults(run=_etl)

    report = commands.add_parser("reports")
    source = report.add_mutually_exclusive_group(required=True)
    source.add_argument("--star")
    report.add_argument("--output", help="store whole reports here as Parquet")
    report.add_argument("--rows", type=int, default=20, help="printed without --output")
    report.add_argument("--version", type=int, help="with --versioned; the latest without it")
    report.add_argument("--hash", action="append", metavar="TABLE=SQL")
    report.set_defaults(run=_reports)

    for command, place in ((etl, target), (report, source)):
        place.add_argument("--jdbc-url")
        command.add_argument("--jdbc-properties", metavar="FILE")
        command.add_argument("--connections", type=int, default=8)
        command.add_argument("--format", default="parquet", choices=("parquet", "csv"))
        command.add_argument("--input-bytes", type=int, help="sizes the session, with --cores")
        command.add_argument("--cores", type=int)
        command.add_argument("--s3a", metavar="FILE")
        command.add_argument("--versioned", action="store_true", help="the star's folder holds versions")
    return parser


def _settings(args: argparse.Namespace) -> dict[str, str]:
    sized = sized_settings(args.input_bytes, args.cores) if args.input_bytes else {}
    store = s3a_settings(**json.loads(Path(args.s3a).read_text())) if args.s3a else {}
    return {**sized, **store}


def main(argv: list[str] | None = None) -> None:
    parser = _arguments()
    args = parser.parse_args(argv)
    if bool(args.jdbc_url) != bool(args.jdbc_properties):
        parser.error("--jdbc-url and --jdbc-properties go together")
    if bool(args.input_bytes) != bool(args.cores):
        parser.error("--input-bytes and --cores go together")
    builder = SparkSession.builder.appName("starcart").config(map=_settings(args))
    args.run(prepare(builder.getOrCreate()), args)


if __name__ == "__main__":
    main()
