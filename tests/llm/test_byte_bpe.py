"""Byte-level BPE against tiktoken, and round trips."""

from __future__ import annotations

import hashlib
import random
import sys

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import tiktoken

from starcart.llm.byte_bpe import Codec, char_spans, decoded, digests, encoded, merged
from starcart.llm.queries import rank_file

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def own():
    return Codec(rank_file(), PATTERN)


@pytest.fixture(scope="module")
def reference(own):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=own.ranks, special_tokens={})


def same(own, reference, texts):
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert ids.tolist() == reference.encode_ordinary(text), repr(text)
        assert own.decode(ids) == text.encode()


@pytest.mark.parametrize(
    "alphabet", ["a", "ab", "ae .", "ban", "0123", "....!?-", "  \n\t", "hH wW", "éñüß a", "ㅋ・哈😀 a \x1c", "=*-~_'sd"]
)
def test_random_strings(own, reference, alphabet):
    rng = random.Random(alphabet)
    same(own, reference, ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(600)])


def test_joined_tokens(own, reference):
    rng = random.Random(5)
    tokens = [t.decode("utf-8", "ignore") for t in own.ranks]
    same(own, reference, ["".join(rng.choices(tokens, k=rng.randrange(10))) for _ in range(3000)])


def test_every_character(own, reference):
    numbers = [n for n in range(1, 0x110000, 23) if not 0xD800 <= n < 0xE000]
    same(own, reference, [f"a{chr(n)}b {chr(n)}{chr(n)}1 {chr(n)}" for n in numbers])


def test_forgetting_changes_nothing(own, reference, monkeypatch):
    monkeypatch.setattr("starcart.llm.byte_bpe._CACHED", 20)
    rng = random.Random(6)
    same(own, reference, [" ".join(f"word{rng.randrange(300)}" for _ in range(50)) for _ in range(60)])


def test_long_runs(own, reference):
    same(own, reference, ["a" * 50_000 + " " * 3_000 + "." * 50_000])


def test_merged_is_the_rank_rule(own, reference):
    rng = random.Random(8)
    for _ in range(500):
        piece = "".join(rng.choices("abcan", k=rng.randrange(1, 30)))
        assert merged(piece.encode(), own.ranks) == reference.encode_ordinary(piece)


def test_split_characters(own):
    text = "😀ü"
    (ids,) = own.encode([text])
    starts = [sum(len(own.tokens[i]) for i in ids[:k]) for k in range(len(ids))]
    spans = char_spans(text.encode(), np.array(starts))
    assert spans[0][0] == 0
    assert spans[-1][1] == 2
    assert own.decode(ids[:1]) == text.encode()[: len(own.tokens[int(ids[0])])]
    with pytest.raises(ValueError):
        own.decode([10**6])


def test_digests_of_odd_rows(odd_docs, own, reference):
    ranks = rank_file()
    texts = odd_docs.select("doc_id", "text").collect()
    df = encoded(odd_docs, ranks, PATTERN)
    assert df.columns == ["doc_id", "ids", "starts"]
    found = sorted(map(tuple, digests(decoded(df.drop("starts"), ranks)).collect()), key=str)
    expected = []
    for row in texts:
        ids = reference.encode_ordinary(row.text or "")
        listed = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        expected.append((row.doc_id, len(ids), listed, hashlib.sha256((row.text or "").encode()).hexdigest()))
    assert found == sorted(expected, key=str)
    for row in df.collect():
        lengths = [len(own.tokens[i]) for i in row.ids]
        assert row.starts == [sum(lengths[:k]) for k in range(len(lengths))] or len(row.ids) > 2000


def test_empty_table(no_docs):
    ranks = rank_file()
    assert digests(decoded(encoded(no_docs, ranks, PATTERN), ranks)).count() == 0


def test_a_worker_remembers_few_pieces():
    codec = Codec(rank_file(), PATTERN)
    for i in range(0, 90_000, 3_000):
        (ids,) = codec.encode([" ".join(f"w{k:x}" for k in range(i, i + 3_000))])
        assert codec.decode(ids).decode().startswith(f"w{i:x} ")
    kept = [*codec.known.items(), *codec.known.older.items()]
    assert sum(sys.getsizeof(x) for pair in kept for x in pair) < 10_000_000


def test_the_pipeline_runs_one_python_worker_per_task(spark, docs_of, capsys):
    found = corpus_pipeline.byte_bpe(spark, docs_of([(1, "a text"), (2, None), (3, "")]), "")
    found.explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1
    assert {r.doc_id: (r.n_tokens > 0, r.round_trip) for r in found.collect()} == {1: (True, True), 2: (False, True), 3: (False, True)}
