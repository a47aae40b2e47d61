"""Phrase mining against plain loops, and the filters' own round trips."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from starcart.llm import collocations as mod
from starcart.llm import quotient_filter as qf
from starcart.llm.collocations import collocations


def slowly(rows, least, top):
    """(lang, rank, phrase, a, l, r, n, score) by definition; rows are (text, lang)."""
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        counts = f.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, 5):
                counts.update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        phrases = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        longest = Counter()
        for p, a in phrases.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longest[p[i : i + m]] = max(longest[p[i : i + m]], a)
        found = []
        for p, a in phrases.items():
            if p in longest and 100 * longest[p] >= 80 * a:
                continue
            cuts = [(2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def documents(spark, rows, parts=3, **extra):
    columns = list(zip(*rows, strict=True)) or [[]] * 2
    table = pa.table([pa.array(c, pa.string()) for c in columns], ["text", "lang"])
    for name in extra:
        table = table.append_column(name, pa.array(["x"] * len(rows), pa.string()))
    return spark.createDataFrame(table).repartition(parts)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def random_rows(seed, n=120):
    rng = random.Random(seed)
    words = ["aa", "B", "é", "日本", "x-y", "(q)", "0", "Zz", "dd", "e\x01"]
    gaps = [" "] * 12 + ["\t", "  ", ", ", ".", "\n", " ! ", ":\r\n", ";"]
    rows = []
    for _ in range(n):
        text = "".join(
            w + rng.choice(gaps) for w in rng.choices(words, weights=range(1, 11), k=rng.randint(0, 60))
        )
        rows.append((rng.choice(["", " ", ". "]) + text, rng.choice(["en", "en", "de", None])))
    return rows


@pytest.mark.parametrize(("seed", "least", "top"), [(0, 3, 2000), (1, 10, 7), (2, 30, 2000), (3, 1, 50)])
def test_random_texts(spark, seed, least, top):
    rows = random_rows(seed)
    assert found(collocations(documents(spark, rows), least, top)) == slowly(rows, least, top)


def test_blocks_and_windows_change_nothing(spark, monkeypatch):
    rows = random_rows(7)
    monkeypatch.setattr(mod, "BLOCK_BYTES", 300)
    assert found(collocations(documents(spark, rows), 4, 100)) == slowly(rows, 4, 100)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 50])
def test_windows_cut_no_word(size):
    rng = random.Random(size)
    for _ in range(50):
        text = "".join(rng.choices("ab .\n", k=rng.randint(0, 60))).encode()
        stretches = list(mod.windows(text, size))
        assert b"".join(stretches) == text
        one, many = mod._Stream(), mod._Stream()
        one.add(text)
        for s in stretches:
            many.add(s)
        assert one.block() == many.block()


def test_odd_rows(spark):
    rows = [(None, "en"), ("", "en"), (" \t ", None), ("x " * 300_000, "en"), ("y" * 300_000, "de"), ("a b.", "de")]
    rows += [("one two three four five", "fr")] * 40 + [("same pair", None)] * 31
    given = documents(spark, rows, word=1, words=1, block=1, f=1, key=1, shard=1, n=1, score=1)
    assert found(collocations(given)) == slowly(rows, 30, 2000)
    assert found(collocations(documents(spark, []))) == []
    assert found(collocations(documents(spark, [("no phrase here", "en")]))) == []


def test_a_common_pair_in_a_third_of_all_places(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(50)]
    rows = [(" ".join(["of the"] * 20 + rng.choices(words, k=40)), "en") for _ in range(200)]
    assert found(collocations(documents(spark, rows), 5, 300)) == slowly(rows, 5, 300)


@pytest.mark.parametrize(("half", "shard_bits"), [(1, 0), (3, 3), (8, 2), (17, 6), (31, 0), (32, 8), (40, 10), (64, 8)])
def test_filters_give_back_what_they_hold(half, shard_bits):
    rng = np.random.default_rng(half)
    top = np.uint64((1 << half) - 1)
    left, right = (rng.integers(0, 2**63, 3000, dtype=np.uint64) & top for _ in range(2))
    right[::3] = right[0]
    moved = qf.permuted(left, right, half)
    assert all((x == y).all() for x, y in zip(qf.restored(*moved, half), (left, right), strict=True))
    counts = rng.integers(1, 400, 3000)
    expected = Counter()
    for a, b, n in zip(left.tolist(), right.tolist(), counts.tolist(), strict=True):
        expected[a, b] += n
    parts = [qf.packed(*qf.added(*(x[i::3] for x in (*moved, counts)), half), half, shard_bits) for i in range(3)]
    got = Counter()
    for shard in sorted(set().union(*parts)):
        a, b, n = qf.merged(shard, [p[shard] for p in parts if shard in p], half, shard_bits)
        assert (n > 0).all()
        for key in zip(*(x.tolist() for x in qf.restored(a, b, half)), n.tolist(), strict=True):
            assert key[:2] not in got
            got[key[:2]] = key[2]
    assert got == expected


def test_a_filter_is_smaller_than_its_keys():
    keys = np.arange(200_000, dtype=np.uint64)
    key = qf.added(*qf.permuted(keys & np.uint64(1023), keys >> np.uint64(10), 20), np.ones(200_000, np.int64), 20)
    size = sum(map(len, qf.packed(*key, 20, 0).values()))
    assert size < 200_000 * 5.5  # 40 bits of key and a counter, less the quotient
