"""Joining a big table to a narrow one by a key that may hold a large share of the rows of either.

The rows of a hot key are dealt over a grid of cells. A row of the big table goes to a row of the grid by its
hash and is repeated for every column, a looked-up row goes to a column by its hash and is repeated for every
row, so each pair meets in one cell. Where few rows are looked up there is one column, and the big
table is not repeated. The cell becomes part of the join key, so the big table is still shuffled once, and
the cells spread over all tasks. Equal rows get equal cells: a ``distinct`` that keeps the cell needs
no other partitioning. No random numbers are used, so a task that is run again deals the same rows
to the same cells.

A key is hot if it has more rows than a task's fair share, rows / partitions. No more than
``partitions`` keys of a table can have that, so their list is short by itself, at every size. It is a
DataFrame of the same plan: nothing runs while a plan is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECE = "_piece"

#: How to treat hot keys: find and deal them, which reads the key column once more, or leave
#: them to the adaptive skew join, for sources whose second reading costs much (CSV).
MEASURE, ADAPTIVE = "measure", "adaptive"

# Keys that the counting sketches follow per key that can be hot. A count is then
# right to about a ninth of a fair share. One sketch follows a million at most; beyond that there are several.
_FOLLOWED = 32
_MOST_FOLLOWED = 1_000_000
# Fixed value: cells per task that the output of a hot key is dealt to, so that tasks come out even.
_CELLS = 16


def _partitions(df: DataFrame, partitions: int | None) -> int:
    return partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _counted_keys(df: DataFrame, key: str, partitions: int, kept: int) -> DataFrame:
    """One row ``rows, top``: at least the ``kept`` commonest keys with their counts, and null, as ``item, count``.

    Counts come from mergeable sketches over the one column, each for the keys of one remainder of their hash.
    """
    followed = max(_FOLLOWED * partitions, 1000)
    sketches = -(-followed // _MOST_FOLLOWED)
    followed = min(followed, _MOST_FOLLOWED)
    kind = dict(df.dtypes)[key]
    entries = f"array<struct<item: {kind}, count: bigint>>"
    keys = df.select(F.col(key).alias("key"))
    found = [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("key").isNull()).alias("nulls"),
        F.expr(f"approx_top_k(key, {min(kept, followed)}, {followed})").alias("top"),
    ]
    if sketches == 1:
        counts = keys.agg(*found).withColumn("top", F.expr(f"cast(top as {entries})"))
    else:
        remainder = F.pmod(F.xxhash64("key"), F.lit(sketches))
        counts = keys.groupBy(remainder.alias("sketch")).agg(*found)
        tops = F.flatten(F.collect_list(F.expr(f"cast(top as {entries})")))
        counts = counts.agg(F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), tops.alias("top"))
    present = F.filter(F.coalesce("top", F.expr(f"cast(array() as {entries})")), lambda x: x["item"].isNotNull())
    null_key = F.expr(f"array(named_struct('item', cast(null as {kind}), 'count', coalesce(nulls, 0)))")
    return counts.select(F.coalesce("rows", F.lit(0)).alias("rows"), F.concat(present, null_key).alias("top"))


def hot_keys(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """``_hot, _pieces``: keys, null included, with more rows than a task's fair share.

    Which keys are listed decides only where rows travel. A key with p fair shares gets p pieces, rounded up,
    and one more.
    """
    partitions = _partitions(df, partitions)
    shares = F.try_divide(F.col("x.count") * partitions, F.col("rows"))
    listed = _counted_keys(df, key, partitions, partitions).select("rows", F.explode("top").alias("x"))
    return listed.where(shares > 1).select(F.col("x.item").alias("_hot"), (F.ceil(shares) + 1).alias("_pieces"))


def hot_grid(big: DataFrame, lookup: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """``_hot, _pieces, _columns``: keys that are hot in either table, with the rows and columns of their grid.

    A key's joined rows are the product of its counts; one that no sketch follows is taken to have as many as it can
    have. The key gets cells by its share of all joined rows, and at least as many rows or columns as
    it has fair shares in a table. Only a key that is hot in ``lookup`` gets more than one column.
    ``lookup`` may be any table with the same keys; it is only counted.
    """
    partitions = _partitions(big, partitions)
    followed = _FOLLOWED * partitions
    kind = dict(big.dtypes)[key]
    ours = _counted_keys(big, key, partitions, followed)
    theirs = _counted_keys(lookup.select(F.col(key).cast(kind)), key, partitions, followed)
    # two tables of one row; all that follows is in one task and about lists bounded by the number of partitions
    both = ours.crossJoin(theirs.select(F.col("rows").alias("others"), F.col("top").alias("other_top")))
    lists = F.concat(
        F.transform("top", lambda x: _entry(x["item"], x["count"], F.lit(None))),
        F.transform(
            F.filter("other_top", lambda x: x["item"].isNotNull()), lambda x: _entry(x["item"], F.lit(None), x["count"])
        ),
    )
    keys = both.select("rows", "others", F.inline(lists)).groupBy("rows", "others", "item").agg(
        F.max("n").alias("n"), F.max("m").alias("m")
    )
    most_n, most_m = (F.ceil(F.col(c) / followed) for c in ("rows", "others"))
    keys = keys.select(
        F.col("item").alias("_hot"),
        F.coalesce("n", most_n).cast("double").alias("n"),
        F.coalesce("m", F.when(F.col("item").isNull(), 0).otherwise(most_m)).cast("double").alias("m"),
        (F.col("rows") / partitions).alias("fair_n"),
        (F.col("others") / partitions).alias("fair_m"),
        F.col("m").isNotNull().alias("seen"),
    ).where("n > fair_n or m > fair_m")
    joined = F.sum(F.col("n") * F.col("m")).over(Window.partitionBy())
    share = F.try_divide(F.col("n") * F.col("m"), F.col("fair_n") * partitions + joined)
    rows = F.when(F.col("n") > F.col("fair_n"), F.ceil(F.try_divide("n", "fair_n")) + 1)
    # only a key that is there for certain: the rows of others would meet nothing in some columns
    columns = F.when(F.col("seen") & (F.col("m") > F.col("fair_m")), F.ceil(F.try_divide("m", "fair_m")) + 1)
    hot = keys.select(
        "_hot", "n", "m",
        F.coalesce(F.ceil(F.lit(_CELLS * partitions) * share), F.lit(1)).alias("cells"),
        F.coalesce(rows, F.lit(1)).alias("r"),
        F.coalesce(columns, F.lit(1)).alias("c"),
    )
    # with r rows and c columns the key's rows travel n * c + m * r times
    even = F.coalesce(F.round(F.sqrt(F.col("cells") * F.try_divide("n", "m"))), F.lit(1.0))
    more = F.when(F.col("c") == 1, F.col("cells")).otherwise(F.least(F.col("cells"), even))
    hot = hot.withColumn("r", F.greatest("r", more.cast("bigint")))
    wide = F.greatest("c", F.ceil(F.col("cells") / F.col("r")))
    return hot.select(
        "_hot",
        F.col("r").cast("bigint").alias("_pieces"),
        F.when(F.col("c") == 1, 1).otherwise(wide).cast("bigint").alias("_columns"),
    )


def _entry(item: Column, n: Column, m: Column) -> Column:
    return F.struct(item.alias("item"), n.cast("bigint").alias("n"), m.cast("bigint").alias("m"))


def split_join(
    big: DataFrame, lookup: DataFrame, key: str, hot: DataFrame | None, how: str = "left"
) -> DataFrame:
    """``big`` joined to ``lookup`` (``left`` or ``left_semi``), with hot keys in pieces.

    ``hot`` is as from ``hot_keys``, where ``lookup`` has few rows per key, or, for a left join,
    from ``hot_grid``; the result then has the additional column ``PIECE``. Without it the join is left
    to Spark.
    """
    if hot is None:
        return big.join(lookup, key, how)
    if "_columns" in hot.columns:
        if how != "left":
            raise ValueError(f"a grid needs a left join, not {how}")
        return _grid_join(big, lookup, key, hot)
    pieces = F.broadcast(hot)  # at most as many rows as there are partitions
    count = F.coalesce("_pieces", F.lit(1).cast("bigint"))
    dealt = (
        big.join(pieces, F.col(key).eqNullSafe(F.col("_hot")), "left")
        .withColumn(PIECE, F.pmod(_row_hash(big), count))
        .drop("_hot", "_pieces")
    )
    repeated = (
        lookup.join(pieces, F.col(key) == F.col("_hot"), "left")
        .withColumn(PIECE, F.explode(_upto(count)))
        .drop("_hot", "_pieces")
    )
    return dealt.join(repeated, [key, PIECE], how)


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def _upto(count: Column) -> Column:
    """0 to ``count - 1``."""
    return F.sequence(F.lit(0).cast("bigint"), count - 1)


def _grid_join(big: DataFrame, lookup: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    cells = F.broadcast(hot)  # at most twice as many rows as there are partitions
    one = F.lit(1).cast("bigint")
    rows, columns = F.coalesce("_pieces", one), F.coalesce("_columns", one)
    dealt = (
        big.join(cells, F.col(key).eqNullSafe(F.col("_hot")), "left")
        .withColumn("_row", F.pmod(_row_hash(big), rows))
        .withColumn("_column", F.explode(_upto(columns)))
        .withColumn(PIECE, F.col("_row") * columns + F.col("_column"))
        .withColumn("_several", columns > 1)
        .drop("_hot", "_pieces", "_columns", "_row", "_column")
    )
    repeated = (
        lookup.join(cells, F.col(key) == F.col("_hot"), "left")
        .withColumn("_column", F.pmod(_row_hash(lookup), columns))
        .withColumn("_row", F.explode(_upto(rows)))
        .withColumn(PIECE, F.col("_row") * columns + F.col("_column"))
        .withColumn("_met", F.lit(True))
        .drop("_hot", "_pieces", "_columns", "_row", "_column")
    )
    joined = dealt.join(repeated, [key, PIECE], "left")
    # a key with several columns is in the lookup, so its rows meet in some column if not in this one
    return joined.where(F.col("_met") | ~F.col("_several")).drop("_met", "_several")


def measured(df: DataFrame, key: str, hot: str, lookup: DataFrame | None = None) -> DataFrame | None:
    """The hot keys to deal under the chosen method; with ``lookup`` those of both tables."""
    if hot not in (MEASURE, ADAPTIVE):
        raise ValueError(f"hot is {MEASURE!r} or {ADAPTIVE!r}, not {hot!r}")
    if hot == ADAPTIVE:
        return None
    return hot_keys(df, key) if lookup is None else hot_grid(df, lookup, key)


def any_hot(hot: DataFrame | None) -> DataFrame | None:
    """The hot keys, or nothing where no key is hot, so that the join needs no piece in its key.

    This asks at once, so it is for jobs, not for plans; where keys are hot, the plan counts them again.
    """
    return None if hot is None or hot.isEmpty() else hot


def distinct_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct rows of ``columns``, in the partitioning the join left behind."""
    piece = [PIECE] if PIECE in df.columns else []
    return df.select(*columns, *piece).distinct().select(*columns)
