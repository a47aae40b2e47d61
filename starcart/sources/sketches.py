"""Column profiles that add up: sketches are stored with a load and merged with those of the next one.

Per column a sketch holds the number of rows and nulls, a HyperLogLog sketch of its values and, for numbers and times,
a KLL sketch of their order. Merging is a grouped union, so a profile of all loads never reads old rows again.
With the default sizes a number of distinct values is right to ``DISTINCT_ERROR`` (three standard deviations),
and the rank of a quantile to ``RANK_ERROR``.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sizes of the sketches, and what they can be off by.
_LOG_BUCKETS = 14
_KLL_SIZE = 800
DISTINCT_ERROR = 0.025
RANK_ERROR = 0.01

_MEASURED = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal", "date", "timestamp", "timestamp_ntz")
_NO_SKETCH = "cast(null as binary)"


def _number(column: str, kind: str) -> str | None:
    """SQL for a value's place in order as a number: seconds for times, days for dates."""
    base = kind.split("(")[0]
    if base not in _MEASURED:
        return None
    if base == "date":
        return f"cast(unix_date(`{column}`) as double)"
    if base.startswith("timestamp"):
        return f"timestampdiff(microsecond, timestamp_ntz'1970-01-01', cast(`{column}` as timestamp_ntz)) / 1e6"
    return f"cast(`{column}` as double)"


def column_sketches(tables: Mapping[str, DataFrame]) -> DataFrame:
    """A row per table and column: counts and sketches, from one scan and one global aggregate per table."""
    parts = []
    for table, df in tables.items():
        totals, cells = ["count(1) as row_count"], []
        for i, (column, kind) in enumerate(df.dtypes):
            number = _number(column, kind)
            order = f"kll_sketch_agg_double({number}, {_KLL_SIZE})" if number else _NO_SKETCH
            totals += [
                f"count(`{column}`) as filled{i}",
                f"hll_sketch_agg(cast(`{column}` as string), {_LOG_BUCKETS}) as distinct{i}",
                f"{order} as order{i}",
            ]
            cells.append(
                f"named_struct('column_name', '{column}', 'row_count', row_count, 'null_count', row_count - filled{i}, "
                f"'distinct_sketch', distinct{i}, 'order_sketch', order{i})"
            )
        constant = [t for t in totals if t.startswith(_NO_SKETCH)]
        found = df.selectExpr(*[t for t in totals if t not in constant]).selectExpr("*", *constant)
        parts.append(found.selectExpr(f"'{table}' as table_name", f"inline(array({', '.join(cells)}))"))
    return reduce(DataFrame.unionByName, parts)


def merged(sketches: DataFrame) -> DataFrame:
    """One row per table and column for all loads together; any number of loads, in any order."""
    return sketches.groupBy("table_name", "column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.expr("hll_union_agg(distinct_sketch)").alias("distinct_sketch"),
        F.expr(f"kll_merge_agg_double(order_sketch, {_KLL_SIZE})").alias("order_sketch"),
    )


def sketch_profile(sketches: DataFrame, quantiles: tuple[float, ...] = (0.0, 0.25, 0.5, 0.75, 1.0)) -> DataFrame:
    """What merged sketches say: counts, distinct values, quantiles, and whether the column may be a key.

    ``quantiles`` is null for texts and where a column has no value; times are seconds from 1970 on, dates days. A column is a
    key candidate if it has no null and as many values as rows, but for the error of the sketch.
    """
    distinct = F.coalesce(F.hll_sketch_estimate("distinct_sketch"), F.lit(0))
    # by rank in the sketch of the order; an empty one has no quantile
    ranks = ", ".join(f"{q}d" for q in quantiles)
    filled = F.expr("coalesce(kll_sketch_get_n_double(order_sketch), 0) > 0")
    found = sketches.withColumn("approx_distinct", distinct)
    values = F.expr(f"kll_sketch_get_quantile_double(order_sketch, array({ranks}))")
    enough = F.col("approx_distinct") >= F.col("row_count") * (1 - DISTINCT_ERROR)
    return found.select(
        "table_name",
        "column_name",
        "row_count",
        "null_count",
        "approx_distinct",
        F.when(filled, values).alias("quantiles"),
        ((F.col("null_count") == 0) & (F.col("row_count") > 0) & enough).alias("key_candidate"),
    )
