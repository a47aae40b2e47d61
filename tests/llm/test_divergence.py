"""Source divergence against plain loops over whole numbers."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from starcart.llm import divergence
from starcart.llm.divergence import BILLION, divergences, shares

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def slowly(rows, docs=10, top=10):
    """(lang, source, part, item, value, rank) by definition; rows are (text, lang, source)."""
    rows = [tuple(x or "" for x in row) for row in rows]
    spread, counts = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = TERM.findall(lowered(text))
        spread[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = set()
    for lang in {r[1] for r in rows}:
        kept = [t for t, n in spread[lang].items() if n >= docs]
        own = {s: {t: counts[x, s][t] for t in kept} for x, s in counts if x == lang}
        own[None] = {t: sum(c[t] for c in own.values()) for t in kept}
        p = {
            s: {t: 1 + BILLION * (n + 2) // (sum(c.values()) + 2 * len(kept)) for t, n in c.items()}
            for s, c in own.items()
        }
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in own.keys() - {None}:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in own if o not in (s, None)]
            terms = [(f(p[s][t], p[None][t]), t) for t in kept if own[s][t] and p[s][t] > p[None][t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(found[:most])}
    return out


def documents(spark, rows, **extra):
    columns = list(zip(*rows, strict=True)) or [[]] * 3
    table = pa.table([pa.array(c, pa.string()) for c in columns], ["text", "lang", "source"])
    for name in extra:
        table = table.append_column(name, pa.array(["x"] * len(rows), pa.string()))
    return spark.createDataFrame(table).repartition(3)


def found(df):
    return [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(spark, seed):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("ab", "É", "Zz", "日", "o") for b in ("", "x", "ß", "ñY", "q")]
    rows = [
        (rng.choice([" ", "1", "-\n"]).join(rng.choices(words, weights=range(1, 26), k=rng.randint(0, 40))),
         rng.choice(["en", "de", None]), rng.choice(["a", "a", "a", "b", "c", "é", None]))
        for _ in range(150)
    ]
    result = found(divergences(documents(spark, rows)))
    assert len(result) == len(set(result))
    assert set(result) == slowly(rows)


def test_small_pieces_and_dense_blocks_change_nothing(spark, monkeypatch):
    rng = random.Random(9)
    rows = [
        (" ".join(rng.choices("abcdefghijklmnop", k=30)), "en", rng.choice("uvwxyz")) for _ in range(200)
    ]
    monkeypatch.setattr(divergence, "_HELD_ROWS", 20)
    monkeypatch.setattr(divergence, "_CELLS", 18)
    assert set(found(divergences(documents(spark, rows)))) == slowly(rows)


def test_groups_without_terms_and_odd_rows(spark):
    rows = [(None, None, None), ("", "en", "a"), ("12 34", "en", "b"), ("once", "en", "c"), ("alone", "fr", "d")]
    result = found(divergences(documents(spark, rows, term=1, n=1, value=1, shard=1, total=1)))
    assert set(result) == slowly(rows)
    assert ("en", "a", "pair", "b", 0, 1) in result and not [r for r in result if r[0] in ("", "fr")]


def test_one_source_holds_most_rows_and_one_text_is_long(spark):
    rows = [("common Common cOmmon rare" + str(i % 3), "en", "hot") for i in range(600)]
    rows += [("other words common", "en", f"s{i % 4}") for i in range(80)]
    rows += [("long word " * 200_000, "en", "s1"), ("x" * 300_000, "en", "s2")] + [("x" * 300_000, "en", "hot")] * 9
    assert set(found(divergences(documents(spark, rows)))) == slowly(rows)


def test_no_rows(spark):
    assert found(divergences(documents(spark, []))) == []


def test_shares_are_exact_for_large_counts():
    rng = random.Random(2)
    for _ in range(200):
        total = rng.randint(1, 8 * 10**15)
        count, terms = rng.randint(0, total), rng.randint(1, 10**9)
        exact = 1 + BILLION * (count + 2) // (total + 2 * terms)
        assert shares(np.array([count]), total, terms).tolist() == [exact]
