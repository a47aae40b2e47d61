"""String tiling against a slow version of the same rule."""

from __future__ import annotations

import random

import numpy as np
import pytest
from llm.conftest import prose

from starcart.llm import decontamination
from starcart.llm.decontamination import Block, blocks, contaminated, leaks, plain_words, tiles, without_leaks


def slow_tiles(doc, item, least):
    free, open_, out = [True] * len(doc), [True] * len(item), []
    while True:
        best = 0
        for i in range(len(doc)):
            for j in range(len(item)):
                n = 0
                while (
                    i + n < len(doc) and j + n < len(item) and free[i + n] and open_[j + n] and doc[i + n] == item[j + n]
                ):
                    n += 1
                if n > best:
                    best, at = n, (i, j)
        if best < least:
            return out
        i, j = at
        free[i : i + best] = open_[j : j + best] = [False] * best
        out.append((i, j, best))


@pytest.mark.parametrize("seed", range(30))
def test_tiles_equal_the_slow_ones(seed):
    rng = random.Random(seed)
    item = np.array([rng.randrange(4 if seed % 3 else 40) for _ in range(rng.randrange(1, 30))], np.uint64)
    doc = [rng.randrange(4 if seed % 3 else 40) for _ in range(rng.randrange(1, 20))]
    for _ in range(2):
        a = rng.randrange(len(item))
        doc += item[a : a + rng.randrange(1, 12)].tolist()
    doc = np.array(doc, np.uint64)
    assert tiles(doc, item, 2, np.ones(len(doc), bool)) == slow_tiles(doc.tolist(), item.tolist(), 2)


def block_of(*texts):
    words, first = plain_words([t.encode() for t in texts])
    return Block(list(range(len(texts))), [words[first[k] : first[k + 1]] for k in range(len(texts))])


ITEM = "one two three four five six seven eight nine ten eleven twelve"


@pytest.mark.parametrize(
    ("text", "covered"),
    [
        (f"before {ITEM}, after", 12),
        (ITEM.upper().replace(" ", " - "), 12),
        ("x seven eight nine ten eleven twelve y one two three four five six z", 12),
        ("one two three four five six", 6),
        ("one two three four five", None),
        ("one two three four x five six seven eight x nine ten eleven twelve", None),
        ("", None),
    ],
)
def test_coverage(text, covered):
    (found,) = leaks([text.encode()], block_of(ITEM, "another item of six words"))
    assert [f[1] for f in found] == ([covered] if covered else [])


def test_repeated_word_item():
    (found,) = leaks([b"a " * 40], block_of("a " * 10))
    assert [(k, n) for k, n, _, _ in found] == [(0, 10)]


def test_short_items_are_their_own_seed():
    block = block_of("tiny item", "alone")
    assert [len(f) for f in leaks([b"a tiny item", b"alone", b"item tiny"], block)] == [1, 1, 0]


def test_against_a_plain_search(spark, docs_of, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 100)
    rng = random.Random(2)
    items = [" ".join(prose(rng, rng.randrange(15, 60), 3000)) for _ in range(30)]
    bench = spark.createDataFrame([*enumerate(items), (99, None), (None, "x y z"), (98, " ")], "item_id long, text string")
    rows, planted = [], set()
    for doc in range(120):
        words = prose(rng, rng.randrange(0, 300), 3000)
        if doc % 4 == 0:
            k = rng.randrange(len(items))
            own = items[k].split()
            if doc % 8 == 0:
                own = own[len(own) // 2 :] + own[: len(own) // 2]
            at = rng.randrange(len(words) + 1)
            words[at:at] = own
            planted.add((doc, k))
        rows.append((doc, " ".join(words)))
    docs = docs_of(rows)
    assert len(list(blocks(bench, 100))) > 5
    found = contaminated(docs, bench)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == planted
    left = without_leaks(docs, bench)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == set(range(120)) - {d for d, _ in planted}


def test_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "six seven eight nine ten"), (1, "six seven eight nine ten")], "item_id long, text string")
    found = contaminated(odd_docs, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(5, 1)] * 4 + [(6, 1)] * 2
    assert without_leaks(odd_docs, bench).count() == 8
    assert contaminated(no_docs, bench).count() == 0
    nothing = bench.limit(0)
    assert contaminated(odd_docs, nothing).count() == 0
    assert without_leaks(odd_docs, nothing).count() == 11
