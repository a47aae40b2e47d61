"""Splitting a star into rows that keep its declared keys and a quarantine of the others, with reasons.

Tables are taken parents first, so that a reference counts only if the row it names was accepted itself. A row is
quarantined for a null in its key, for a reference that no accepted row answers, or because another
row has its key. Of several sound rows with one key the one with the least hash stays (then the least in its
columns), whatever the order of the rows. A null reference is allowed, as in SQL.

Equal rows are counted, not kept apart: the quarantine has ``copies``. Tables may have keys that hold a large share of
the rows: these are dealt to pieces. Rows travel once, by the key's first column; references are looked up as
distinct values, and only rows whose key's least row is unsound, or hot, are grouped a second time.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starcart.functions.hot import MEASURE, PIECE, measured, split_join
from starcart.functions.lazy import to_count_keys
from starcart.plans.session import stored
from starcart.schemas import FOREIGN_KEYS, PRIMARY_KEYS, STAR_TABLES

Star = Mapping[str, DataFrame]

NULL_KEY, REPEATED = "null in key", "repeated key"

# Fixed value: references that lead nowhere, up to which every task gets the list of them.
_FEW = 500_000


@dataclass(frozen=True)
class Enforced:
    """``accepted`` tables, and per table a ``quarantine`` with ``copies`` and ``reasons`` besides its columns."""

    accepted: Star
    quarantine: Star


def parents_first() -> list[str]:
    """The star's tables in an order in which every reference leads back."""
    order = TopologicalSorter({table: () for table in STAR_TABLES})
    for child, _, parent, _ in FOREIGN_KEYS:
        order.add(child, parent)
    return list(order.static_order())


def _as_key(column: str, parent: str, key: str) -> Column:
    """A reference as the text of the key it names."""
    return F.col(column).cast(STAR_TABLES[parent][key]).cast("string")


def _known(parents: DataFrame, key: str) -> DataFrame:
    return parents.select(F.col(key).cast("string").alias("_reference"))


def _lost(edge: tuple[str, str, str, str]) -> Column:
    _, column, parent, key = edge
    return F.array(F.lit(f"no {parent}.{key} for {column}"))


def _counted(df: DataFrame, key: list[str], edge: tuple | None, parents: DataFrame | None, dealt: DataFrame | None) -> DataFrame:
    """Equal rows with ``copies``, and ``_orphan`` where ``edge``, from the key's first column, leads nowhere.

    Rows travel once, by that column, or not at all if they were made by a join on it; what is asked of a key's rows
    is then found where they are. Rows of a hot value are dealt to pieces, equal ones as well; ``_whole`` tells that there
    is one piece. The result is partitioned by ``_by``.
    """
    columns, first = df.columns, key[0]
    rows, whole = df, F.lit(True)
    if dealt is not None:
        pieces, count = F.broadcast(dealt), F.coalesce("_pieces", F.lit(1).cast("bigint"))
        rows = rows.join(pieces, F.col(first).eqNullSafe(F.col("_hot")), "left")
        rows = rows.withColumn(PIECE, F.pmod(F.xxhash64(*columns, F.spark_partition_id()), count))
        whole = F.col("_pieces").isNull()
    rows = rows.select(*columns, whole.alias("_whole"), *_by([], rows))
    orphan = F.lit(False)
    if edge:
        known = _known(parents, edge[3])
        met = _as_key(first, edge[2], edge[3]) == F.col("_reference")
        if dealt is not None:
            known = known.join(pieces, F.col("_reference").eqNullSafe(F.col("_hot")), "left")
            known = known.select("_reference", F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1)).alias("_at"))
            met = met & (F.col(PIECE) == F.col("_at"))
        # accepted keys are unique, so no row is repeated; the hint keeps the partitioning that is needed next
        rows = rows.join(known.hint("merge"), met, "left")
        orphan = F.col("_reference").isNull() & F.col(first).isNotNull()
    else:
        rows = rows.repartition(*_by([first], rows))
    rows = rows.withColumn("_orphan", orphan)
    return rows.groupBy(*columns, "_whole", "_orphan", *_by([], rows)).agg(F.count(F.lit(1)).alias("copies"))


def _by(columns: list[str], df: DataFrame) -> list[str]:
    """The columns, and the piece where there is one."""
    return [*columns, PIECE] if PIECE in df.columns else columns


def _with_orphans(
    rows: DataFrame, counted: DataFrame, edge: tuple[str, str, str, str], parents: DataFrame, hot: str
) -> DataFrame:
    """``rows``, made from those of ``counted``, with one more reason where ``edge`` leads nowhere.

    ``_headless`` tells that the key's least row has such a reason. References that lead nowhere are stored first; where
    they are few, no row travels to meet them.
    """
    table, column, parent, key = edge
    reference = _as_key(column, parent, key).alias("_reference")
    orphans = counted.select(reference).where("_reference is not null").distinct()
    orphans = stored(orphans.join(_known(parents, key), "_reference", "left_anti"), f"{table}_{column}_orphans")
    orphans = orphans.withColumn("_lost", F.lit(True))
    few = orphans.count() <= _FEW

    def met(rows: DataFrame, referring: str) -> DataFrame:
        rows = rows.withColumn("_reference", _as_key(referring, parent, key))
        if few:
            return rows.join(F.broadcast(orphans), "_reference", "left").drop("_reference")
        dealt = measured(counted.select(reference), "_reference", hot)
        return split_join(rows, orphans, "_reference", dealt).drop("_reference", PIECE)

    reasons = F.when(F.col("_lost"), F.concat("reasons", _lost(edge))).otherwise(F.col("reasons"))
    rows = met(rows, column).withColumn("reasons", reasons).drop("_lost")
    rows = met(rows, f"_head_{column}")
    rows = rows.withColumn("_headless", F.col("_headless") | F.col("_lost").isNotNull()).drop("_lost")
    return rows if few else stored(rows, f"{table}_{column}_checked")


def _split(df: DataFrame, table: str, keys: Star, hot: str, like: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows and quarantine; ``keys`` are those of accepted parents.

    ``like`` is any table with the same frequent values in the key's first column.

    The least row of a key is known before references are looked up. It stays if it is sound, which every row of the
    key can tell from its references. Only sound rows of other keys, and of hot ones, are grouped again: ``_open``.
    """
    columns, key = df.columns, list(PRIMARY_KEYS[table])
    has_null = reduce(Column.__or__, [F.col(c).isNull() for c in key])
    # the key as one text that is different for different keys
    one_text = F.to_json(F.array(*[F.col(c).cast("string") for c in key]))
    edges = [e for e in FOREIGN_KEYS if e[0] == table and e[2] in keys]
    own = next((e for e in edges if e[1] == key[0]), None)
    dealt = measured(like, key[0], hot)
    dealt = None if dealt is None or dealt.isEmpty() else dealt
    grouped = _counted(df, key, own, keys[own[2]] if own else None, dealt)
    one_key = Window.partitionBy(*_by(key, grouped)).orderBy(F.xxhash64(*columns), *columns)
    others = [e for e in edges if e != own]
    heads = [F.first(e[1]).over(one_key).alias(f"_head_{e[1]}") for e in others]
    first = (F.row_number().over(one_key) == 1).alias("_first")
    counted = stored(grouped.select(*columns, "copies", "_whole", "_orphan", first, *heads), f"{table}_counted")

    nothing = F.array().cast("array<string>")
    rows = counted.withColumn("reasons", F.when(has_null, F.array(F.lit(NULL_KEY))).otherwise(nothing))
    rows = rows.withColumn("_headless", F.lit(False))
    for edge in edges:
        if edge == own:
            found = F.when(F.col("_orphan"), F.concat("reasons", _lost(edge))).otherwise(F.col("reasons"))
            rows = rows.withColumn("reasons", found)
        else:
            rows = _with_orphans(rows, counted, edge, keys[edge[2]], hot)

    # nulls in the key and the reference from its first column are the same for all rows of a key
    unsound = F.size("reasons") > 0
    rows = rows.withColumn("_open", ~F.col("_whole") | (~unsound & F.col("_headless")))
    settled = rows.where("not _open")
    kept = settled.where(~unsound & F.col("_first")).select(*columns, "copies")
    repeated = settled.where(~unsound & ~F.col("_first")).select(*columns, "copies")
    left = settled.where(unsound).select(*columns, "copies", "reasons")

    if others or dealt is not None:
        # rows of a hot key were counted in pieces
        found = rows.where("_open").groupBy(*columns, "reasons").agg(F.sum("copies").alias("copies"))
        found = stored(found.select(*columns, "copies", "reasons"), f"{table}_open")
        sound = found.where(~unsound).drop("reasons")
        winners = sound.groupBy(*[F.col(c).alias(f"_{c}") for c in key]).agg(
            F.min(F.struct(F.xxhash64(*columns).alias("_hash"), *columns, "copies")).alias("_winner"),
            F.count(F.lit(1)).alias("_rows"),
        )
        winners = stored(winners.select("_winner.*", "_rows").drop("_hash"), f"{table}_accepted")
        several = winners.where("_rows > 1").select(one_text.alias("_key"), F.struct(*columns).alias("_winner"))
        marked = sound.withColumn("_key", one_text)
        met = split_join(marked, several, "_key", measured(marked, "_key", hot))
        losers = met.where(F.col("_winner").isNotNull() & ~F.struct(*columns).eqNullSafe(F.col("_winner")))
        kept = kept.unionByName(winners.drop("_rows"))
        repeated = repeated.unionByName(losers.select(*columns, "copies"))
        left = left.unionByName(found.where(unsound))

    surplus = kept.where("copies > 1").withColumn("copies", F.col("copies") - 1)
    repeated = repeated.unionByName(surplus).withColumn("reasons", F.array(F.lit(REPEATED)))
    return kept.select(*columns), left.unionByName(repeated)


def enforce(star: Star, hot: str = MEASURE) -> Enforced:
    """The star's rows that keep all declared keys, and the others.

    Rows of ``accepted`` and ``copies`` of ``quarantine`` add up to the rows of the star. Checked rows are written to the
    scratch folder, table by table, when this is called. ``hot`` is how references and keys with
    a large share of the rows are joined (``functions.hot``).
    """
    accepted, quarantine, keys = {}, {}, {}
    for table in parents_first():
        if table in star:
            like = to_count_keys(star, table)
            like = like if PRIMARY_KEYS[table][0] in like.columns else star[table]
            accepted[table], quarantine[table] = _split(star[table], table, keys, hot, like)
            if any(e[2] == table and e[0] in star for e in FOREIGN_KEYS):
                keys[table] = stored(accepted[table].select(*PRIMARY_KEYS[table]), f"{table}_keys")
    return Enforced(accepted, quarantine)


def enforcement_counts(enforced: Enforced) -> DataFrame:
    """Rows per table and verdict: ``accepted``, or the reasons for the quarantine."""
    parts = []
    for table, df in enforced.accepted.items():
        rows = df.select(F.lit("accepted").alias("verdict"), F.lit(1).cast("bigint").alias("copies"))
        verdict = F.concat_ws("; ", "reasons").alias("verdict")
        rows = rows.unionAll(enforced.quarantine[table].select(verdict, "copies"))
        rows = rows.groupBy("verdict").agg(F.sum("copies").alias("row_count"))
        parts.append(rows.select(F.lit(table).alias("table_name"), "verdict", "row_count"))
    return reduce(DataFrame.unionByName, parts)
