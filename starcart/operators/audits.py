"""How far a star keeps the keys its model declares.

Each table is reduced to (key, number of rows) before anything else, so a key
that holds a third of the rows costs no more than any other. One row per key or
edge is returned; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starcart.functions.counted import counted
from starcart.schemas import FOREIGN_KEYS, PRIMARY_KEYS, STAR_TABLES

Star = Mapping[str, DataFrame]


def _stacked(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _rows_where(condition) -> Column:
    """Rows (sum of weights) that meet ``condition``; 0 for an empty table."""
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))


def star_row_counts(star: Star) -> DataFrame:
    """Rows per star table."""
    return _stacked(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in star.items()
        ]
    )


def primary_key_violations(star: Star) -> DataFrame:
    """Per table: rows, rows with a null in the key, keys used more than once and
    the rows beyond the first of such keys."""
    parts = []
    for table, key in PRIMARY_KEYS.items():
        if table not in star:
            continue
        has_null = F.lit(False)
        for column in key:
            has_null = has_null | F.col(column).isNull()
        repeated = ~has_null & (F.col("n") > 1)
        parts.append(
            counted(star[table], *key)
            .agg(
                _rows_where(F.lit(True)).alias("row_count"),
                _rows_where(has_null).alias("null_key_rows"),
                F.count_if(repeated).alias("repeated_keys"),
                F.coalesce(F.sum(F.when(repeated, F.col("n") - 1)), F.lit(0)).alias("surplus_rows"),
            )
            .select(
                F.lit(table).alias("table_name"),
                F.lit(", ".join(key)).alias("key_columns"),
                "row_count",
                "null_key_rows",
                "repeated_keys",
                "surplus_rows",
            )
        )
    return _stacked(parts)


def _labelled(roles: list[tuple[int, str, int]], as_type: dict[int, str]) -> Column:
    """One (edge, reference, child) row per role of a table, from the columns of one row."""
    return F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(edge).alias("edge"),
                    F.col(column).cast(as_type[edge]).cast("string").alias("reference"),
                    F.lit(child).cast("bigint").alias("child"),
                )
                for edge, column, child in roles
            ]
        )
    )


def foreign_key_violations(star: Star) -> DataFrame:
    """Per declared edge: child rows, rows without a reference, and rows and keys
    whose reference is not in the parent table.

    Every table is read once, for the edges that leave it and those that lead to it; references and
    keys of all edges meet in one grouping, combined before the shuffle, instead of a join.
    """
    edges = [e for e in enumerate(FOREIGN_KEYS) if e[1][0] in star and e[1][2] in star]
    as_type = {i: STAR_TABLES[parent][key] for i, (_, _, parent, key) in edges}
    roles: dict[str, list[tuple[int, str, int]]] = {}
    for i, (child, column, parent, key) in edges:
        roles.setdefault(child, []).append((i, column, 1))
        roles.setdefault(parent, []).append((i, key, 0))

    references = (
        _stacked([star[t].select(_labelled(r, as_type)) for t, r in roles.items()])
        .groupBy("edge", "reference")
        .agg(F.sum("child").alias("n"), F.min("child").alias("least"))
        .where("n > 0")
    )
    # only children: no row of the parent table has this reference
    orphan = F.col("reference").isNotNull() & (F.col("least") == 1)
    found = references.groupBy("edge").agg(
        F.sum("n").alias("child_rows"),
        _rows_where(F.col("reference").isNull()).alias("null_rows"),
        _rows_where(orphan).alias("orphan_rows"),
        F.count_if(orphan).alias("orphan_keys"),
    )
    names = F.array(
        *[
            F.struct(
                F.lit(i).alias("edge"),
                F.lit(f"{child}.{column}").alias("child"),
                F.lit(f"{parent}.{key}").alias("parent"),
            )
            for i, (child, column, parent, key) in edges
        ]
    )
    counts = ("child_rows", "null_rows", "orphan_rows", "orphan_keys")
    return (
        found.sparkSession.range(0, 1, 1, 1)
        .select(F.inline(names))
        .join(found, "edge", "left")
        .select("child", "parent", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])
    )
