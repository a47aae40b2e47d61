"""Shards of near equal size over fixed virtual slots.

A hash of the doc_id and the text deals every record into one of ``slots`` slots, for good. Bytes are
summed per slot; the slots, heaviest first, go to the shard that has least so far. The result is
a table of versions: a rebalancing adds a version with a few edited rows and moves no other slot. Only the
slot table, of fixed length, is ever in one place; records never leave the hash order.

Repeated texts with different ids lie in different slots, and so do rows that are repeated as they are: a large
group of copies is spread over all shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOTS = 4096
CELLS = 16  # parts of a slot that are numbered apart
SHARDS = 40
OVERHEAD = 16
COPIES = 10_000


def record_size(text: Column) -> Column:
    """UTF-8 bytes, a null text having none, plus what a record takes besides."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot, cell`` per row. Null texts count as empty.

    Rows that agree in doc_id and text are counted, and the count is dealt out again: the first of them goes where its
    hash says, each further one where the hash of its number does. So rows repeated over and over are
    spread over all slots, and no task lists more than ``COPIES`` of them at a time.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    size, crc = record_size(F.col("text")).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    rows = docs.select("doc_id", size, crc, F.xxhash64("doc_id", "text").alias("_hash"))
    counted = rows.groupBy("doc_id", "size", "text_crc32", "_hash").agg(F.count("*").alias("_n"))
    few = counted.where(F.col("_n") <= COPIES).withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    many = counted.where(F.col("_n") > COPIES)
    many = many.withColumn("_part", F.explode(F.expr(f"sequence(0, (_n - 1) div {COPIES})")))
    many = many.repartition("_hash", "_part").withColumn(
        "_copy", F.explode(F.expr(f"sequence(_part * {COPIES}, least(_n, (_part + 1) * {COPIES}) - 1)"))
    )
    dealt = few.unionByName(many.drop("_part"))
    own = F.when(F.col("_copy") == 0, F.col("_hash")).otherwise(F.xxhash64("_hash", "_copy"))
    place = F.pmod(own, F.lit(slots * CELLS))
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.floor(place / CELLS).cast("int").alias("virtual_slot"),
        (place % CELLS).cast("int").alias("cell"),
    )


def slot_bytes(rows: DataFrame) -> DataFrame:
    """``virtual_slot, bytes``: as many rows as slots, however many records."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"))


def _lightest(loads: Column) -> Column:
    return F.array_position(loads, F.array_min(loads)).cast("int") - 1


def slot_map(weights: DataFrame, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Version 1 of the map: ``version, virtual_slot, shard`` for every slot.

    Slots by falling bytes, then number; each goes to the shard with the fewest bytes, the first of
    equals. A slot without records weighs nothing and goes by its number.
    """
    every = weights.sparkSession.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    full = every.join(weights, "virtual_slot", "left").select(
        F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"), "virtual_slot"
    )
    heavy_first = full.select(F.struct((-F.col("bytes")).alias("key"), "virtual_slot").alias("s")).agg(
        F.array_sort(F.collect_list("s")).alias("slots")
    )
    start = F.struct(
        F.array_repeat(F.lit(0).cast("long"), shards).alias("loads"),
        F.array().cast("array<struct<virtual_slot: int, shard: int>>").alias("given"),
    )

    def give(state: Column, slot: Column) -> Column:
        empty = slot["key"] == 0
        to = F.when(empty, slot["virtual_slot"] % shards).otherwise(_lightest(state["loads"]))
        loads = F.transform(
            state["loads"], lambda load, i: F.when(i == to, load - slot["key"]).otherwise(load)
        )
        one = F.struct(slot["virtual_slot"].alias("virtual_slot"), to.alias("shard"))
        return F.struct(
            F.when(empty, state["loads"]).otherwise(loads).alias("loads"),
            F.concat(state["given"], F.array(one)).alias("given"),
        )

    given = heavy_first.select(F.explode(F.aggregate("slots", start, give, lambda s: s["given"])).alias("g"))
    return given.select(F.lit(1).alias("version"), "g.virtual_slot", "g.shard")


def current(versions: DataFrame) -> DataFrame:
    """``virtual_slot, shard`` of the latest version that names each slot."""
    return versions.groupBy("virtual_slot").agg(F.max_by("shard", "version").alias("shard"))


def grown(versions: DataFrame, weights: DataFrame, shards: int) -> DataFrame:
    """The rows of a new version with ``shards`` shards, one more than now.

    From every old shard the lightest slots move, while what has moved stays within one part of
    ``shards`` of its bytes; they all go to the new shard. The map's other rows stand.
    """
    now = current(versions).join(weights, "virtual_slot", "left")
    of_shard = Window.partitionBy("shard")
    upto = of_shard.orderBy(F.coalesce("bytes", F.lit(0)), "virtual_slot").rowsBetween(
        Window.unboundedPreceding, 0
    )
    moving = now.withColumns(
        {"moved": F.sum("bytes").over(upto), "total": F.sum("bytes").over(of_shard)}
    ).where(f"coalesce(moved, 0) <= total / {shards}")
    latest = versions.agg((F.max("version") + 1).alias("version"))
    return moving.crossJoin(F.broadcast(latest)).select(  # one row
        "version", "virtual_slot", F.lit(shards - 1).alias("shard")
    )


def sharded(rows: DataFrame, slot_to_shard: DataFrame) -> DataFrame:
    """The records with ``shard`` and ``slot``, their place in the shard, from 0 without gaps.

    Records are numbered by slot, part of the slot, doc_id, size and checksum; equal rows are
    interchangeable. Numbers start within the part, a fixed fraction of all rows whatever their
    contents; the first number of each part comes from the counts of the parts, a table of fixed length.
    """
    cells = rows.groupBy("virtual_slot", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("virtual_slot", "cell").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = cells.join(F.broadcast(slot_to_shard), "virtual_slot").select(
        "virtual_slot", "cell", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    within = Window.partitionBy("virtual_slot", "cell").orderBy("doc_id", "size", "text_crc32")
    return (
        rows.withColumn("place", F.row_number().over(within) - 1)
        .join(F.broadcast(starts), ["virtual_slot", "cell"])
        .withColumn("slot", F.col("base") + F.col("place"))
        .drop("base", "place", "cell")
    )
