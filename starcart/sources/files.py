"""Reading the six source tables from files."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import partial, reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starcart.functions.lazy import LazyTables
from starcart.functions.parsing import Formats, typed
from starcart.schemas import SOURCE_TABLES


# Reader options that say which files there are and how lines end, for the look at the headers too.
_FILE_OPTIONS = ("encoding", "charset", "lineSep", "pathGlobFilter", "recursiveFileLookup", "modifiedBefore", "modifiedAfter")
_WHOLE_FILES = str(1 << 50)


@dataclass(frozen=True)
class CsvPart:
    """Files that begin with the same header line, and the scan over them."""

    header: str
    files: tuple[str, ...]
    rows: DataFrame


def _headers(spark: SparkSession, path: str, options: Mapping[str, str]) -> dict[str, list[str]]:
    """Header lines and the files that begin with them.

    Every file is a task that stops at its first line, so no file is read through. The settings that make
    it so are those of a session of its own, which shares all but its settings with the given one.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", _WHOLE_FILES)
    own.conf.set("spark.sql.files.openCostInBytes", _WHOLE_FILES)
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    comment = options.get("comment")

    def first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, line in enumerate(batch.column("line").to_pylist()):
                if line.strip() and not (comment and line.startswith(comment)):
                    yield batch.slice(place, 1)
                    return

    same = {k: v for k, v in options.items() if k in _FILE_OPTIONS}
    lines = own.read.options(**same).text(path).select("_metadata.file_path", F.col("value").alias("line"))
    found: dict[str, list[str]] = {}
    for row in lines.mapInArrow(first_line, lines.schema).collect():  # one line per file, as in a listing
        found.setdefault(row.line.removeprefix("\ufeff").rstrip("\r"), []).append(unquote(row.file_path))
    return found


def _verbatim(path: str) -> str:
    """The path with nothing in it that Spark would take for a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def csv_parts(spark: SparkSession, path: str, **options: str) -> list[CsvPart]:
    """The files of a CSV directory, grouped by header; the most files first."""
    found = _headers(spark, path, options)
    reader = spark.read.options(header=True, **options)
    groups = sorted(found.items(), key=lambda item: (-len(item[1]), item[0]))
    if len(groups) < 2:
        return [CsvPart(header, tuple(sorted(files)), reader.csv(path)) for header, files in groups]
    return [
        CsvPart(header, tuple(sorted(files)), reader.csv([_verbatim(f) for f in sorted(files)]))
        for header, files in groups
    ]


def read_csv(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """A CSV file, or a directory of them, with headers; every column is text.

    Columns are found by header name, in every file by its own header: files with the same header
    are one scan, and the scans are put together by name. Where a file lacks a column, it is null.
    ``options`` go to Spark's reader, e.g. ``escape='"'`` for doubled quotes.
    """
    parts = csv_parts(spark, path, **options)
    if not parts:
        return spark.read.options(header=True, **options).csv(path)
    return reduce(partial(DataFrame.unionByName, allowMissingColumns=True), [p.rows for p in parts])


def csv_layout(spark: SparkSession, path: str, columns: Mapping[str, str], **options: str) -> DataFrame:
    """One row per header in a CSV directory: its columns, the number of files, and what it lacks or adds."""
    rows = [
        (list(p.rows.columns), len(p.files), [c for c in columns if c not in p.rows.columns],
         [c for c in p.rows.columns if c not in columns])
        for p in csv_parts(spark, path, **options)
    ]
    return spark.createDataFrame(
        rows, "columns array<string>, file_count int, missing array<string>, extra array<string>"
    )


def read_raw(
    spark: SparkSession,
    root: str,
    fmt: str = "csv",
    paths: Mapping[str, str] | None = None,
    **options: str,
) -> Mapping[str, DataFrame]:
    """The six tables as stored: ``{root}/{table}.{fmt}`` unless ``paths`` says otherwise.

    Any path Spark can read will do, ``s3a://`` included.
    """

    def scan(name: str) -> DataFrame:
        path = (paths or {}).get(name, f"{root.rstrip('/')}/{name}.{fmt}")
        if fmt == "csv":
            return read_csv(spark, path, **options)
        return spark.read.format(fmt).options(**options).load(path)

    return LazyTables({name: partial(scan, name) for name in SOURCE_TABLES})


def typed_sources(
    raw: Mapping[str, DataFrame], patterns: Mapping[str, Formats] | None = None
) -> Mapping[str, DataFrame]:
    """Raw tables with their declared columns and types; bad cells become null
    and are counted by ``sources.profile.source_profile``.

    ``patterns`` gives the date or time formats of columns that are not ISO text.
    """

    def load(name: str) -> DataFrame:
        return typed(raw[name], SOURCE_TABLES[name], patterns)

    return LazyTables({name: partial(load, name) for name in SOURCE_TABLES})


def load_sources(
    spark: SparkSession,
    root: str,
    fmt: str = "csv",
    paths: Mapping[str, str] | None = None,
    **options: str,
) -> Mapping[str, DataFrame]:
    """``read_raw`` followed by ``typed_sources``."""
    return typed_sources(read_raw(spark, root, fmt, paths, **options))
