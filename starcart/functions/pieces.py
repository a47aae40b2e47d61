"""One text of all values of a group, as ``string_agg`` makes it, in pieces of bounded length.

The values of a group may be a large share of all rows, so no group is gathered. Rows are sorted over all tasks by
group and value; a value's place in its group is the number of values before it in its task plus those of the
group in earlier tasks. Places cut the group into pieces with the same number of values each, the last one
less, and only a piece is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starcart.plans.session import stored

# Fixed value: pieces that one array lists; a value that fills more of them takes several arrays.
_LISTED = 10_000


def string_agg(
    df: DataFrame, group: str, value: str, per_piece: int, separator: str = ",", times: str | None = None
) -> DataFrame:
    """``group, piece, n_values, text``: the group's values in ascending order, ``per_piece`` to a row.

    Pieces count from 0; the texts of a group in that order, joined by ``separator``, are its whole text. Nulls are
    left out, as in SQL, and so is a group without any other value; rows without a group are one group.
    ``times`` names a column with the number of times that a row's value comes up. One table, with a row per
    group and value, is written to the scratch folder when this is called.
    """
    if per_piece < 1:
        raise ValueError("a piece has at least one value")
    occurrences = F.sum(times) if times else F.count(F.lit(1))
    runs = (
        df.where(F.col(value).isNotNull())
        .groupBy(F.col(group).alias("_group"), F.col(value).alias("_value"))
        .agg(occurrences.cast("bigint").alias("_n"))
        .where("_n > 0")
    )
    placed = stored(
        runs.repartitionByRange("_group", "_value").withColumn("_task", F.spark_partition_id()), "runs"
    )
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1).partitionBy("_group")
    sizes = placed.groupBy("_group", "_task").agg(F.sum("_n").alias("_size"))
    sizes = sizes.select(
        F.col("_group").alias("_of"), F.col("_task").alias("_in"), _sum("_size", earlier).alias("_before")
    )
    above = Window.partitionBy("_group", "_task").orderBy("_value").rowsBetween(Window.unboundedPreceding, -1)
    here = F.col("_group").eqNullSafe(F.col("_of")) & (F.col("_task") == F.col("_in"))
    placed = (
        placed.withColumn("_above", _sum("_n", above))
        .join(sizes, here)
        .withColumn("_first", F.col("_before") + F.col("_above"))
        .withColumn("_last", F.col("_first") + F.col("_n") - 1)
        .select("_group", "_value", "_first", "_last")
    )
    spread = (
        placed.withColumn("_many", F.explode(F.expr(f"sequence(_first div {per_piece * _LISTED}, _last div {per_piece * _LISTED})")))
        .withColumn(
            "piece",
            F.explode(
                F.expr(
                    f"sequence(greatest(_first div {per_piece}, _many * {_LISTED}), "
                    f"least(_last div {per_piece}, _many * {_LISTED} + {_LISTED - 1}))"
                )
            ),
        )
        .withColumn(
            "_here",
            F.expr(f"least(_last, piece * {per_piece} + {per_piece - 1}) - greatest(_first, piece * {per_piece}) + 1"),
        )
    )
    part = F.struct("_value", F.expr("array_repeat(cast(_value as string), cast(_here as int))").alias("texts"))
    return (
        spread.groupBy(F.col("_group").alias(group), "piece")
        .agg(F.sum("_here").alias("n_values"), F.array_sort(F.collect_list(part)).alias("_parts"))
        .select(
            group, "piece", "n_values",
            F.concat_ws(separator, F.flatten(F.transform("_parts", lambda p: p["texts"]))).alias("text"),
        )
    )


def _sum(name: str, window) -> Column:
    return F.coalesce(F.sum(name).over(window), F.lit(0).cast("bigint"))
