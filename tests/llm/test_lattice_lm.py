"""Word model and lattice against loops over words and segmentations."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm.conftest import prose
from pyspark.sql import functions as F

from starcart.llm import lattice_lm
from starcart.llm.lattice_lm import Lattice, Vocabulary, first_vocabulary, lattice_scores
from starcart.llm.queries import vocabulary_file

def held():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2


def tokens(text):
    lowered = (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))
    return re.findall(rb"[^\x20\x09-\x0D]+", lowered)


def is_held(doc):
    return zlib.crc32(str(doc).encode()) % 7 == 2


def total(word, p):
    """Sum over all segmentations."""
    sums = [1.0] + [0.0] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(end):
            sums[end] += sums[start] * p.get(word[start:end], 0.0)
    return sums[-1]


def uses(word, p):
    """Expected uses of each piece, by listing all segmentations."""
    out, whole = Counter(), 0.0

    def walk(at, chance, path):
        nonlocal whole
        if at == len(word):
            whole += chance
            for piece in path:
                out[piece] += chance
            return
        for end in range(at + 1, len(word) + 1):
            if word[at:end] in p:
                walk(end, chance * p[word[at:end]], [*path, word[at:end]])

    walk(0, 1.0, [])
    return {piece: n / whole for piece, n in out.items()}


def packed(items):
    ends = np.cumsum([len(w) for w in items])
    return np.frombuffer(b"".join(items), np.uint8), ends - [len(w) for w in items], ends


@pytest.fixture(scope="module")
def small():
    pieces = tuple(sorted({bytes([b]) for b in b" abcn"} | {b" a", b"an", b"ana", b" ban", b"na", b"b a", b"nan"} - {b"b a"}))
    p = np.random.default_rng(3).random(len(pieces) + 1)
    return Vocabulary(pieces, np.log(p / p.sum()))


def test_forward_and_expected_counts(small):
    p = dict(zip(small.pieces, np.exp(small.logp[:-1]), strict=True))
    rng = random.Random(1)
    items = [b" " + bytes(rng.choices(b"abcn", k=rng.randrange(1, 9))) for _ in range(40)] + [b" banana"]
    lattice = Lattice(small)
    logs = lattice.logs(*packed(items))
    assert np.allclose(logs, [math.log(total(w, p)) for w in items])
    counts = np.array([rng.randrange(1, 5) for _ in items])
    expected = Counter()
    for word, n in zip(items, counts, strict=True):
        for piece, x in uses(word, p).items():
            expected[piece] += n * x
    assert np.allclose(lattice.expected(*packed(items), counts), [expected[x] for x in small.pieces])


def test_long_words_do_not_underflow(small):
    logs = Lattice(small).logs(*packed([b" " + b"banana" * 5000]))
    assert np.isfinite(logs).all()


def test_vocabulary_has_every_byte():
    vocabulary = first_vocabulary(vocabulary_file())
    assert {bytes([b]) for b in range(256)} <= set(vocabulary.pieces)
    assert all(b" " not in x[1:] for x in vocabulary.pieces)
    assert abs(np.exp(vocabulary.logp).sum() - 1) < 1e-9


def made():
    rng = random.Random(6)
    rows = [(i, " ".join(prose(rng, rng.randrange(0, 200), 900))) for i in range(300)]
    rows += [(400 + i, "Copies of ONE text  copies\tof one text é") for i in range(150)]
    return [*rows, (600, None), (601, ""), (602, "z" * 5000)]


def test_scores(docs_of, monkeypatch):
    monkeypatch.setattr(lattice_lm, "BLOCK_BYTES", 20_000)
    rows = made()
    found = {r.doc_id: r for r in lattice_scores(docs_of(rows), held(), vocabulary_file()).collect()}
    assert len(found) == len(rows)
    counts, ends = Counter(), 0
    for doc, text in rows:
        if not is_held(doc):
            counts.update(tokens(text))
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 2  # V + 1, and V counts the end
    vocabulary = first_vocabulary(vocabulary_file())
    p = dict(zip(vocabulary.pieces, np.exp(vocabulary.logp[:-1]), strict=True))
    lattice = Lattice(vocabulary)
    listed = [b" " + w for w in counts]
    expected = lattice.expected(*packed(listed), np.array(list(counts.values()))) + lattice_lm.SMOOTHING
    expected = np.append(expected, ends + lattice_lm.SMOOTHING)
    learnt = dict(zip(vocabulary.pieces, expected[:-1] / expected.sum(), strict=True))
    assert p.keys() == learnt.keys()
    for doc, text in rows:
        own, r = tokens(text), found[doc]
        assert r.held_out == is_held(doc)
        assert (r.n_tokens, r.train_tokens) == (len(own) + 1, n)
        assert r.n_known == sum(counts[w] > 0 for w in own) + 1
        base = sum(math.log10((counts[w] + 1) / (n + v)) for w in own) + math.log10((ends + 1) / (n + v))
        assert r.base_score == pytest.approx(base, rel=1e-9)
        if doc < 100:
            score = sum(math.log10(total(b" " + w, learnt)) for w in own) + math.log10(expected[-1] / expected.sum())
            assert r.score == pytest.approx(score, rel=1e-4)


def test_odd_rows(odd_docs, no_docs):
    rows = lattice_scores(odd_docs, held(), vocabulary_file()).collect()
    assert len(rows) == 11
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) and not (r.doc_id is None and r.held_out) for r in rows)
    assert lattice_scores(no_docs, held(), vocabulary_file()).count() == 0


def test_all_held_out(docs_of):
    rows = lattice_scores(docs_of([(1, "a b"), (2, None)]), F.lit(True), vocabulary_file()).collect()
    assert [(r.n_known, r.train_tokens, r.base_score) for r in rows] == [(0, 0, 0.0)] * 2
