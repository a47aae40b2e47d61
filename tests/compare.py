"""Spark results against DuckDB results, ignoring row order."""

from __future__ import annotations

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return db


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    return sorted(
        (tuple(str(row[n]) for n in names) for row in table.to_pylist()),
    )


def _kinds(table: pa.Table) -> dict[str, str]:
    kinds = {}
    for field in table.schema:
        kind = field.type
        if pa.types.is_timestamp(kind):
            kinds[field.name] = "timestamp"
        elif pa.types.is_large_string(kind) or pa.types.is_string(kind):
            kinds[field.name] = "string"
        else:
            kinds[field.name] = str(kind)
    return kinds


def differences(spark_table: pa.Table, duck_table: pa.Table) -> list[str]:
    """What differs, as text; empty when names, types, row counts and values agree."""
    found = []
    if _kinds(spark_table) != _kinds(duck_table):
        found.append(f"schema: {_kinds(spark_table)} != {_kinds(duck_table)}")
        return found
    left, right = _rows(spark_table), _rows(duck_table)
    if len(left) != len(right):
        found.append(f"rows: {len(left)} != {len(right)}")
    for a, b in zip(left, right):
        if a != b:
            found.append(f"first difference: {a} != {b}")
            break
    return found
