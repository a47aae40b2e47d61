"""Shards: sizes, numbering, versions of the map."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

from llm.conftest import prose
from pyspark.sql import functions as F

from starcart.llm import sharding
from starcart.llm.sharding import current, grown, record_size, records, sharded, slot_bytes, slot_map


def greedy(weights, shards, slots):
    """The map, one slot after another."""
    loads, out = [0] * shards, {}
    for slot in sorted(range(slots), key=lambda s: (-weights.get(s, 0), s)):
        if weights.get(slot, 0):
            to = loads.index(min(loads))
            loads[to] += weights[slot]
        else:
            to = slot % shards
        out[slot] = to
    return out


def test_sizes_places_and_checksums(docs_of):
    rng = random.Random(1)
    rows = [(i, " ".join(prose(rng, rng.choice([1, 20, 60, 400])))) for i in range(1500)]
    rows += [(2000 + i, "the same text for a third of all rows, ünïcödé") for i in range(800)] + [(9000, None)]
    placed = records(docs_of(rows), slots=512)
    weights = slot_bytes(placed)
    versions = slot_map(weights, shards=8, slots=512)
    expected = greedy({r.virtual_slot: r.bytes for r in weights.collect()}, 8, 512)
    assert {r.virtual_slot: r.shard for r in versions.collect()} == expected
    out = sharded(placed, versions.drop("version")).collect()
    texts, shards, sizes = dict(rows), defaultdict(list), defaultdict(int)
    assert len(out) == len(rows)
    for r in out:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 16, zlib.crc32(raw))
        shards[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert max(sizes.values()) < 1.05 * min(sizes.values())


def test_a_new_version_moves_only_into_the_new_shard(spark, docs_of):
    rng = random.Random(2)
    placed = records(docs_of([(i, " ".join(prose(rng, 30))) for i in range(3000)]), slots=512)
    weights = slot_bytes(placed)
    first = slot_map(weights, 8, 512).cache()
    edit = grown(first, weights, 9)
    assert {r.version for r in edit.collect()} == {2}
    versions = first.unionByName(edit)
    before = {r.virtual_slot: r.shard for r in first.collect()}
    after = {r.virtual_slot: r.shard for r in current(versions).collect()}
    assert before.keys() == after.keys()
    assert {after[s] for s in after if after[s] != before[s]} == {8}
    sizes = current(versions).join(weights, "virtual_slot").groupBy("shard").agg(F.sum("bytes").alias("b"))
    bytes_of = {r.shard: r.b for r in sizes.collect()}
    assert max(bytes_of.values()) < 1.2 * min(bytes_of.values())
    first.unpersist()


def test_odd_rows(odd_docs, no_docs):
    placed = records(odd_docs, slots=64)
    out = sharded(placed, slot_map(slot_bytes(placed), 4, 64).drop("version")).collect()
    assert len(out) == 11
    assert sorted(r.size for r in out if r.doc_id in (1, 2)) == [16, 16]
    by = defaultdict(list)
    for r in out:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    none = records(no_docs, slots=64)
    assert sharded(none, slot_map(slot_bytes(none), 4, 64).drop("version")).count() == 0


def test_repeated_rows_keep_the_law(docs_of, monkeypatch):
    """A third of the rows are one row over and over; rows of a few copies are dealt like those of many."""
    rng = random.Random(3)
    rows = [(i, " ".join(prose(rng, rng.choice([20, 60])))) for i in range(6000)]
    rows += [(-1, "the same row again and again, with some text that weighs something " * 4)] * 3000 + rows[:50]
    for copies in (10_000, 700):
        monkeypatch.setattr(sharding, "COPIES", copies)
        placed = records(docs_of(rows))
        weights = slot_bytes(placed)
        out = sharded(placed, slot_map(weights, 8).drop("version")).collect()
        sizes, places = defaultdict(int), defaultdict(list)
        for r in out:
            sizes[r.shard] += r.size
            places[r.shard].append(r.slot)
        assert sorted((r.doc_id, r.size) for r in out) == sorted((d, len(t.encode()) + 16) for d, t in rows)
        assert max(sizes.values()) < 1.05 * min(sizes.values())
        assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_record_size(docs_of):
    sizes = docs_of([(1, "é"), (2, None)]).select(record_size(F.col("text")).alias("n")).collect()
    assert [r.n for r in sizes] == [18, 16]
