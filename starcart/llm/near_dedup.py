"""Near-duplicate documents by HyperMinHash sketches.

1. **Sketch.** A hash deals each distinct shingle into one of ``rows * bands`` buckets. A
   bucket keeps the least 64-bit hash in it, compressed to a register of 16 bits: six bits
   of leading zeros and ten bits of mantissa. An empty bucket borrows the register of
   another one, in an order that is the same for all documents.
2. **Bands.** ``rows`` registers are a band; documents equal in a band meet.
3. **Stars.** In each meeting all members are compared with one centre, the one that meets
   most others. The collision-corrected Jaccard estimate of the sketches drops pairs that lie
   six standard errors below the threshold, then the full sets decide.
4. **Rest.** Members other than the centre that are still apart are compared by a prefix join,
   which is exact: two linked sets share one of their rarest shingles.

Equal sets are one class throughout, so copies cost nothing. A pair at the threshold meets
in no band with probability ``(1 - t**rows)**bands``: 3e-7 for 0.85 with 6 x 32 registers,
3e-7 for 0.80 with 5 x 38.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starcart.llm.components import components
from starcart.llm.words import Words, as_bytes, map_batches, map_slices, mix, shingle_set, stored

MANTISSA = 10
_EMPTY = np.uint64(2**64 - 1)
_MEMBERS = 64  # members of a centre that are compared in one group


@dataclass(frozen=True)
class Rule:
    """``words`` per shingle, linked from ``percent`` similarity on; ``rows x bands`` registers."""

    words: int = 5
    percent: int = 80
    rows: int = 5
    bands: int = 38

    @property
    def registers(self) -> int:
        return self.rows * self.bands


def borrow_order(registers: int, tries: int = 64) -> np.ndarray:
    """For each bucket the buckets it asks, while it is empty, one after another."""
    return np.random.default_rng(registers).integers(0, registers, (registers, tries))


def sketch(shingles: np.ndarray, registers: int, order: np.ndarray) -> np.ndarray:
    """The registers of a non-empty set of shingle hashes."""
    least = np.full(registers, _EMPTY)
    mixed = mix(shingles + np.uint64(0x51ED270B))
    np.minimum.at(least, (mixed % np.uint64(registers)).astype(np.int64), mix(mixed))
    filled = least != _EMPTY
    asking = np.flatnonzero(~filled)
    for asked in order.T if len(asking) else ():
        source = asked[asking]
        found = filled[source]
        least[asking[found]] = least[source[found]]
        asking = asking[~found]
        if not len(asking):
            break
    if len(asking):  # all asked ones were empty: the next filled bucket
        own = np.flatnonzero(filled)
        least[asking] = least[own[np.searchsorted(own, asking) % len(own)]]
    return compress(least)


def compress(least: np.ndarray) -> np.ndarray:
    """64-bit hashes as leading zeros (at most 53) and the ten bits after the first one."""
    top = (least >> np.uint64(11)).astype(np.float64)
    zeros = (53 - np.frexp(top)[1]).astype(np.uint64)
    mantissa = (least << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    return ((zeros << np.uint64(MANTISSA)) | mantissa).astype("<u2")


def chance_collisions(a: np.ndarray, b: np.ndarray, registers: int) -> np.ndarray:
    """Probability that a register of disjoint sets of a and b shingles is equal.

    A bucket holds x = size / registers shingles, so its least hash exceeds s with probability
    exp(-x s); summed over all register values, the ten bits of mantissa as a geometric series.
    """
    xa, xb = a[:, None] / registers, b[:, None] / registers
    zeros = np.arange(54)
    width = 2.0 ** -(zeros + 1 + MANTISSA)
    x = xa + xb
    both = np.exp(-x * width * 2**MANTISSA) * -np.expm1(-x * width * 2**MANTISSA)
    each = np.expm1(-xa * width) * np.expm1(-xb * width) / -np.expm1(-x * width)
    return np.minimum((both * each).sum(axis=1), 0.5)


def may_link(
    left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray, rule: Rule
) -> np.ndarray:
    """Whether the estimate lies less than six standard errors below the threshold."""
    equal = (left == right).mean(axis=1)
    chance = chance_collisions(a, b, rule.registers)
    estimate = (equal - chance) / (1 - chance)
    t = rule.percent / 100
    filled = rule.registers * -np.expm1(-np.minimum(a, b) / rule.registers)
    return estimate >= t - 6 * np.sqrt(t * (1 - t) / np.maximum(filled, 1))


def _sets(df: DataFrame, columns: str, rule: Rule, keep) -> DataFrame:
    """Rows of ``doc_id``, ``tag`` and what ``keep`` makes of each document's set of shingles."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(as_bytes(batch.column("text")))
        hashes, first = words.hashes(), words.first
        rows = [
            keep(shingle_set(hashes[first[i] : first[i + 1]], rule.words))
            for i in range(batch.num_rows)
        ]
        made = [pa.array([r[k] for r in rows]) for k in range(len(rows[0]))]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("tag"), *made],
            ["doc_id", "tag", *(c.split()[0] for c in columns.split(", "))],
        )

    source = df.select("doc_id", F.xxhash64("text").alias("tag"), "text")
    return map_slices(source, run, f"doc_id long, tag long, {columns}")


def _digest(shingles: np.ndarray) -> bytes:
    return blake2b(shingles.tobytes(), digest_size=16).digest()


def sketches(df: DataFrame, rule: Rule) -> DataFrame:
    """``doc_id, tag, n_shingles, digest, registers``; an empty set has empty registers."""
    order = borrow_order(rule.registers)

    def keep(shingles: np.ndarray) -> tuple:
        if not len(shingles):
            return 0, b"", b""
        return (
            len(shingles),
            _digest(shingles),
            sketch(shingles, rule.registers, order).tobytes(),
        )

    return _sets(df, "n_shingles long, digest binary, registers binary", rule, keep)


def _meetings(classes: DataFrame, rule: Rule) -> DataFrame:
    """``band, digest, size``: classes equal in a band, where there are at least two."""
    width = 2 * rule.rows
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(rule.bands - 1)),
        lambda k: F.xxhash64(k, F.substring(F.col("registers"), k * width + 1, F.lit(width))),
    )
    members = classes.select(F.explode(keys).alias("band"), "digest")
    sizes = members.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    return members.join(sizes, "band")


def _estimated(pairs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of classes ``(a, b)`` whose sketches do not rule a link out."""
    known = classes.select("digest", "n_shingles", "registers")
    both = (
        pairs.join(known.toDF("a", "n_a", "r_a"), "a")
        .join(known.toDF("b", "n_b", "r_b"), "b")
        .where(f"100 * least(n_a, n_b) >= {rule.percent} * greatest(n_a, n_b)")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(
                    batch.num_rows, rule.registers
                )
                for c in ("r_a", "r_b")
            )
            sizes = [batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b")]
            good = pa.array(may_link(left, right, *sizes, rule))
            yield batch.select(["a", "b"]).filter(good)

    return map_batches(both.select("a", "b", "n_a", "n_b", "r_a", "r_b"), run, "a binary, b binary")


def _class_sets(df: DataFrame, wanted: DataFrame, rule: Rule) -> DataFrame:
    """``digest, shingles`` of the wanted classes ``(digest, doc_id)``, from the texts."""
    ids = wanted.select(F.col("digest").alias("want"), F.col("doc_id").cast("long").alias("id"))
    ids = ids.join(
        df.select(F.col("doc_id").cast("long").alias("id"), "text"), "id"
    ).select(F.col("id").alias("doc_id"), "text", "want")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(as_bytes(batch.column("text")))
        hashes, first, out = words.hashes(), words.first, ([], [])
        for i, want in enumerate(batch.column("want").to_pylist()):
            shingles = shingle_set(hashes[first[i] : first[i + 1]], rule.words)
            if _digest(shingles) == want:  # another text may have the same doc_id
                out[0].append(want)
                out[1].append(shingles.view(np.int64))
        return pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.binary()), pa.array(out[1], pa.list_(pa.int64()))],
            ["digest", "shingles"],
        )

    return map_slices(ids, run, "digest binary, shingles array<long>").dropDuplicates(["digest"])


def _linked(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Pairs ``(a, b)`` whose full sets are similar enough.

    The partners b of an a are dealt into groups of about 64, each with one copy of a's set;
    the documents of a group are thus few, however many partners there are.
    """
    dealt = F.pmod(F.xxhash64("b"), F.greatest(F.ceil(F.col("n") / _MEMBERS), F.lit(1)))
    parted = pairs.join(pairs.groupBy("a").agg(F.count("*").alias("n")), "a").select(
        "a", "b", dealt.alias("part")
    )
    centres = parted.select("a", "part").distinct()
    rows = (
        parted.join(sets.toDF("b", "shingles"), "b")
        .select("a", "part", "b", "shingles")
        .union(
            centres.join(sets.toDF("a", "shingles"), "a").select(
                "a", "part", F.lit(None).cast("binary"), "shingles"
            )
        )
    )

    def run(group: pa.Table) -> pa.Table:
        names = group.column("b").to_pylist()
        lists = group.column("shingles").combine_chunks()
        values, at = lists.values.to_numpy(), lists.offsets.to_numpy()
        sets = [values[at[i] : at[i + 1]] for i in range(len(names))]
        out: list[bytes] = []
        if None in names:
            centre = sets[names.index(None)]
            for name, other in zip(names, sets, strict=True):
                if name is not None:
                    common = len(np.intersect1d(centre, other, assume_unique=True))
                    union = len(centre) + len(other) - common
                    if 100 * common >= rule.percent * union:
                        out.append(name)
        a = group.column("a")[0].as_py()
        return pa.table(
            [pa.array([a] * len(out), pa.binary()), pa.array(out, pa.binary())], ["a", "b"]
        )

    return rows.groupBy("a", "part").applyInArrow(run, "a binary, b binary")


def _rooted(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows with the ``root`` of their ``digest``; without links it is its own root."""
    known = roots.select(F.col("node").alias("digest"), F.col("root").alias("found"))
    return nodes.join(known, "digest", "left").withColumn(
        "root", F.coalesce("found", "digest")
    ).drop("found")


def _rare_pairs(rest: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of ``(digest, root)`` rows with unequal roots that share a rare shingle.

    Shingles are ordered by the number of sets that hold them. With sizes x and y a link needs
    o = ceil(t (x + y) / (1 + t)) common shingles, so that the first x - o + 1 of the one and
    the first y - o + 1 of the other have one in common.
    """
    p = rule.percent
    every = (
        rest.join(sets, "digest")
        .select("digest", "root", F.size("shingles").cast("long").alias("n"), F.explode("shingles").alias("s"))
    )
    held = (
        every.groupBy("s")
        .agg(F.count("*").alias("df"), F.min("root").alias("r0"), F.max("root").alias("r1"))
        .where("df > 1")
    )
    shared = stored(every.join(held, "s"), "shared")
    # positions: shingles of this set only come first, then the shared ones by (df, s)
    listed = shared.groupBy("digest", "root", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "s", F.expr("r0 != r1").alias("mixed")))).alias("l")
    )
    prefix = (
        listed.select("digest", "root", "n", F.posexplode("l").alias("k", "x"), F.size("l").alias("m"))
        .select("digest", "root", "n", "x.s", "x.mixed", (F.col("n") - F.col("m") + F.col("k")).alias("pos"))
        .where(f"mixed and 100 * pos <= {100 - p} * n")
        .drop("mixed")
    )
    left, right = (
        prefix.toDF(f"{side}", f"root_{side}", f"n_{side}", "s", f"pos_{side}") for side in "ab"
    )
    need = F.ceil(p * (F.col("n_a") + F.col("n_b")) / (100 + p))
    return (
        left.join(right, "s")
        .where("a < b and root_a != root_b")
        .where(f"100 * least(n_a, n_b) >= {p} * greatest(n_a, n_b)")
        .where((F.col("pos_a") <= F.col("n_a") - need) & (F.col("pos_b") <= F.col("n_b") - need))
        .select("a", "b")
        .distinct()
    )


def near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Per row of ``(doc_id, text)``: n_shingles, component_id, kept, tag (a hash of the text), root (of its component).

    Two documents are linked if their sets of distinct word shingles have a Jaccard similarity
    of ``rule.percent`` or more; component_id is the least doc_id reachable over links. kept
    marks the row whose doc_id that is. A text shorter than a shingle is one shingle as a whole; a
    text without words, or null, is linked with nothing. A row without doc_id is linked with
    nothing either: component_id null, kept false. Rows with one doc_id and different texts
    count as documents of their own. Other columns are ignored, an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    drawn = stored(sketches(docs, rule), "sketches")
    classes = stored(
        drawn.where("n_shingles > 0 and doc_id is not null")
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("registers").alias("registers"),
            F.count("*").alias("copies"),
        ),
        "classes",
    )
    roots = _roots(docs, classes, rule)
    least = (
        _rooted(classes.select("digest", "doc_id"), roots)
        .join(roots.select("root").distinct(), "root")  # those with links
    )
    of_root = least.groupBy("root").agg(F.min("doc_id").alias("least"))
    linked = least.select("digest", "root").join(of_root, "root").select("digest", "least", "root")
    named = (
        classes.select("digest", "doc_id")
        .join(linked, "digest", "left")
        .select(
            "digest", F.coalesce("least", "doc_id").alias("least"), F.coalesce("root", "digest").alias("root")
        )
    )
    out = _of_class(drawn.select("doc_id", "tag", "n_shingles", "digest"), named, classes)
    alone = F.when(F.col("n_shingles") == 0, F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", alone))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
        "tag",
        "root",
    )


def _of_class(rows: DataFrame, named: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows with what ``named`` says of their class, or null.

    A class with more than a task's fair share of the rows, of which there are at most as many as
    partitions, is dealt over all tasks and its one row of ``named`` repeated.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = classes.agg(F.sum("copies").alias("total"))
    hot = F.broadcast(  # at most ``parts`` rows
        classes.crossJoin(F.broadcast(total))  # a single row
        .where(F.col("copies") * parts > F.col("total"))
        .select("digest", F.lit(True).alias("hot"))
    )
    dealt = rows.join(hot, "digest", "left").withColumn(
        "part", F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id"), F.lit(parts))).otherwise(0).cast("int")
    )
    everywhere = F.sequence(F.lit(0), F.lit(parts - 1))
    repeated = named.join(hot, "digest", "left").withColumn(
        "part", F.explode(F.when(F.col("hot"), everywhere).otherwise(F.array(F.lit(0))))
    )
    return dealt.drop("hot").join(repeated.drop("hot"), ["digest", "part"], "left").drop("part")


def one_of_each(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The documents, all columns, with one of each group of near duplicates.

    The one with the least doc_id stays; if several rows of the group have it, the text with the least
    hash, and of repeated rows one. Rows that share a doc_id but not a group are documents of their
    own. Texts without words and rows without doc_id all stay.
    """
    found = stored(near_duplicates(docs, rule).where("n_shingles > 0 and doc_id is not null"), "groups")
    first = found.where("kept").groupBy("root").agg(
        F.min("doc_id").alias("id"), F.min("tag").alias("best"), F.count("*").alias("rows")
    )
    doubtful = first.where("rows > 1")  # several rows with one doc_id
    losers = found.where("not kept").union(
        found.where("kept").join(doubtful, "root").where("tag != best").select(*found.columns)
    )
    losers = losers.select("doc_id", "tag").distinct()
    repeated = doubtful.select(F.col("id").alias("doc_id"), F.col("best").alias("tag"))

    def same(other: DataFrame) -> Column:
        return (docs["doc_id"] == other["doc_id"]) & (F.xxhash64(docs["text"]) == other["tag"])

    kept = docs.join(losers, same(losers), "left_anti")
    if repeated.isEmpty():
        return kept
    return kept.join(repeated, same(repeated), "left_anti").unionByName(
        kept.join(repeated, same(repeated), "left_semi").dropDuplicates(["doc_id"])
    )


def _roots(docs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """``(node, root)`` of all classes that are linked with another one."""
    met = stored(_meetings(classes, rule), "meetings")
    busy = met.groupBy("digest").agg(F.sum("size").alias("busy"))
    centres = (
        met.join(busy, "digest")
        .groupBy("band")
        .agg(F.max(F.struct("busy", "digest")).getField("digest").alias("a"))
    )
    spokes = met.join(centres, "band").where("digest != a").select("a", F.col("digest").alias("b"))
    tried = stored(_estimated(spokes.distinct(), classes, rule), "tried")
    ids = classes.select("digest", "doc_id")
    ends = tried.select(F.col("a").alias("digest")).union(tried.select("b")).distinct()
    sets = _class_sets(docs, ends.join(ids, "digest"), rule)
    links = stored(_linked(tried, stored(sets, "sets"), rule), "links")
    roots = stored(components(links), "roots")

    apart = (
        _rooted(met.join(centres, "band").where("digest != a").select("band", "digest"), roots)
        .groupBy("band")
        .agg(F.min("root").alias("r0"), F.max("root").alias("r1"))
        .where("r0 != r1")
        .select("band")
    )
    rest = stored(
        _rooted(met.join(apart, "band").select("digest").distinct(), roots).select("digest", "root"),
        "rest",
    )
    rest_sets = stored(_class_sets(docs, rest.join(ids, "digest"), rule), "rest_sets")
    pairs = stored(
        _estimated(_rare_pairs(rest, rest_sets, rule), classes, rule), "rare_pairs"
    )
    more = _linked(pairs, rest_sets, rule)
    return stored(components(links.union(more)), "roots")
