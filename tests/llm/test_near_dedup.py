"""Near duplicates against all pairs on full sets."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from llm.conftest import prose

from starcart.llm import near_dedup
from starcart.llm.components import components
from starcart.llm.near_dedup import Rule, near_duplicates, one_of_each
from starcart.llm.words import shingle_set

OP1 = Rule(3, 85, rows=6, bands=32)


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words]
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(len(words) - size, 0) + 1)}


def all_pairs(rows, rule):
    """component per row index, by comparing every pair."""
    sets = [shingles(t, rule.words) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and None not in (rows[i][0], rows[j][0]):
                if 100 * len(a & b) >= rule.percent * len(a | b):
                    parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return [least.get(root(i)) if rows[i][0] is not None else None for i in range(len(rows))], sets


def variants(seed, bases=25):
    """Families of copies with a few words replaced, dropped or added, and copies of those."""
    rng, rows = random.Random(seed), []
    for _ in range(bases):
        base = prose(rng, rng.choice([4, 9, 25, 60, 200, 500]))
        family = [base]
        for _ in range(rng.choice([0, 2, 8, 14])):
            words = list(rng.choice(family))
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
                at = rng.randrange(len(words))
                words[at : at + rng.choice([0, 1, 1])] = prose(rng, rng.choice([0, 1, 1]))
                words = words or ["empty"]
            family.append(words)
        rows += [" ".join(w if rng.random() > 0.02 else w.upper() for w in f) for f in family]
    ids = rng.sample(range(10_000), len(rows))
    return list(zip(ids, rows, strict=True))


@pytest.mark.parametrize(("rule", "seed"), [(OP1, 1), (Rule(), 3)])
def test_equals_all_pairs(docs_of, rule, seed):
    rows = variants(seed)
    expected, sets = all_pairs(rows, rule)
    found = {r.doc_id: r for r in near_duplicates(docs_of(rows), rule).collect()}
    for (doc, _), component, own in zip(rows, expected, sets, strict=True):
        assert (found[doc].n_shingles, found[doc].component_id) == (len(own), component)
        assert found[doc].kept == (doc == component)


def test_large_family_with_edits_of_its_own(docs_of):
    """Bands in which hundreds meet: most link to the centre, others only to each other."""
    rng = random.Random(9)
    base = prose(rng, 200)
    rows = []
    for i in range(400):
        words = list(base)
        for at in rng.sample(range(200), rng.choice([0, 1, 3, 4, 5, 7, 9])):
            words[at] = f"own{i}at{at}"
        rows.append((i, " ".join(words)))
        if rng.random() < 0.2:
            rows.append((1000 + i, " ".join([*words, "tail"])))
    expected, _ = all_pairs(rows, OP1)
    found = {r.doc_id: r.component_id for r in near_duplicates(docs_of(rows), OP1).collect()}
    assert [found[d] for d, _ in rows] == expected


def test_odd_rows(odd_docs):
    rows = near_duplicates(odd_docs, OP1).collect()
    assert len(rows) == 11
    of = {r.doc_id: r for r in rows}
    assert (of[None].component_id, of[None].kept) == (None, False)
    for empty in (1, 2, 3):
        assert (of[empty].n_shingles, of[empty].component_id, of[empty].kept) == (0, empty, True)
    assert of[4].n_shingles == of[8].n_shingles == 1
    assert (of[6].component_id, of[6].kept) == (5, False)
    assert sum(r.doc_id == 5 and r.kept for r in rows) == 2


def test_one_of_each(odd_docs, docs_of):
    kept = one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 5, 7, 8, 9]
    assert ids.count(None) == 1
    same_id = docs_of([(1, "a b c d e f g h"), (1, "other words for the same id here"), (2, "a b c d e f g h")])
    assert one_of_each(same_id).count() == 2


def test_empty_table(no_docs):
    assert one_of_each(no_docs).count() == 0


def test_estimate_and_registers():
    rng = np.random.default_rng(4)
    rule = Rule(3, 85, rows=6, bands=32)
    order = near_dedup.borrow_order(rule.registers)
    errors = []
    for size in (40, 400, 4000):
        for share in (0.5, 0.85, 0.95):
            common = rng.integers(0, 2**63, int(size * share), dtype=np.uint64)
            rest = rng.integers(0, 2**63, (2, (size - len(common)) // 2 + 1), dtype=np.uint64)
            a, b = (np.unique(np.append(common, r)) for r in rest)
            jaccard = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            ra, rb = (near_dedup.sketch(x, rule.registers, order) for x in (a, b))
            errors.append(abs((ra == rb).mean() - jaccard))
            if jaccard >= 0.85:
                sizes = np.array([len(a)], float), np.array([len(b)], float)
                assert near_dedup.may_link(ra[None], rb[None], *sizes, rule).all()
    assert max(errors) < 0.15


def test_compress_keeps_leading_zeros_and_mantissa():
    values = np.array([2**63, 2**63 + 2**62, 2**40, 2**40 + 2**39, 2**64 - 1], np.uint64)
    assert near_dedup.compress(values).tolist() == [0, 512, 23 << 10, (23 << 10) | 512, 1023]


def test_chance_collisions_match_drawn_ones():
    rng = np.random.default_rng(1)
    rule = Rule(3, 85, rows=6, bands=32)
    order = near_dedup.borrow_order(rule.registers)
    draws = [near_dedup.sketch(rng.integers(0, 2**63, 5000, dtype=np.uint64), 192, order) for _ in range(200)]
    seen = np.mean([(draws[i] == draws[i + 1]).mean() for i in range(199)])
    size = np.array([5000.0])
    assert abs(seen - near_dedup.chance_collisions(size, size, rule.registers)[0]) < 5e-4


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 101), (None, 5)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.root for r in components(df).collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_short_sequences_are_one_shingle():
    assert len(shingle_set(np.array([1, 2], np.uint64), 5)) == 1
    assert len(shingle_set(np.array([], np.uint64), 5)) == 0
