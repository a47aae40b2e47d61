"""The grammar by itself, its fit, and held-out labels of the given data."""

from __future__ import annotations

import os
import random
import zlib

import pytest
from llm.conftest import prose
from pyspark.sql import functions as F

from starcart.llm.toxicity import TAGS, Model, Reader, fit_toxicity, grammar, score_of, toxicity, without_toxic

SEEDS = Model({"idiot": 3.0, "scum": 3.0}, {"lowei": 3.0})


def tags(text, model=SEEDS):
    (found,) = Reader(model).read([text.encode()])
    return [(text.encode()[s:e].decode(), TAGS[t]) for s, e, t, _, _ in found]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("what an idiot", [("idiot", "insult")]),
        ("You are an IDIOT!", [("IDIOT", "insult_target")]),
        ("that is not an idiot", [("idiot", "insult_negated")]),
        ("you are not an idiot", [("idiot", "insult_negated")]),
        ("not today. an idiot", [("idiot", "insult")]),
        ("she said what an idiot", [("idiot", "insult_reported")]),
        ("I will kill you", [("you", "threat")]),
        ("I will not kill you", [("you", "threat_weak")]),
        ("kill the old process for you", []),
        ("loweischaft und scum", [("loweischaft", "insult"), ("scum", "insult")]),
        ("idiotic lowe", []),
        ("", []),
    ],
)
def test_clauses(text, expected):
    assert tags(text) == expected


def test_composition_is_the_cascade():
    states, emits = grammar()
    assert states.shape == emits.shape
    assert states.max() == len(states) - 1
    assert set(emits.flatten()) == {-1, 0, 1, 2, 3, 4, 5}


def test_more_matches_score_higher():
    reader = Reader(SEEDS)
    one, two, none = (score_of(m, SEEDS) for m in reader.read([b"an idiot", b"an idiot, scum", b"fine"]))
    assert 0 <= none < one < two <= 1


def made(n=900, seed=3):
    rng, rows, labels = random.Random(seed), [], []
    for doc in range(n):
        words, toxic = prose(rng, rng.randrange(20, 90), 2000), doc % 9 == 0
        for _ in range(rng.randrange(2, 5) if toxic else 0):
            words.insert(rng.randrange(len(words)), f"gruzz{rng.choice(['a', 'end', 'ig', 'ung'])}")
        rows.append((doc, " ".join(words)))
        labels.append((doc, 1, int(toxic)))
    return rows, labels


def test_learns_stems_and_reads_no_held_out_label(spark, docs_of):
    rows, labels = made()
    docs = docs_of(rows)
    schema = "doc_id long, quality int, toxic int"
    model = fit_toxicity(docs, spark.createDataFrame(labels, schema))
    assert any("gruzzen".startswith(b) for b in model.beginnings)
    lied = [(d, q, 1 - t if zlib.crc32(str(d).encode()) % 3 == 1 else t) for d, q, t in labels]
    again = fit_toxicity(docs, spark.createDataFrame(lied, schema))
    assert again.beginnings == model.beginnings
    assert again.tags.tolist() == model.tags.tolist()
    scores = {r.doc_id: r.score for r in toxicity(docs, model).collect()}
    assert {d for d, s in scores.items() if s >= 0.7} == {d for d, _, t in labels if t}
    left = without_toxic(docs, model)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {d for d, _, t in labels if not t}


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (5, None, None), (None, 1, 1)]])
def test_without_labels_of_both_kinds(spark, odd_docs, labels):
    model = fit_toxicity(odd_docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    rows = toxicity(odd_docs, model).collect()
    assert len(rows) == 11
    assert all(0 <= r.score < 0.7 and r.matches == [] for r in rows)
    assert toxicity(odd_docs.limit(0), model).count() == 0
    assert without_toxic(odd_docs, model).columns == odd_docs.columns


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="test data not present")
def test_held_out_labels(spark):
    from starcart.llm.queries import op3_toxicity, table

    labels = table(spark, "/root/testdata/sf0.01", "labels")
    rows = op3_toxicity(spark, "/root/testdata/sf0.01").where("held_out").join(labels, "doc_id")
    right = rows.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0]
    false = rows.where("predicted = 1 and toxic = 0").count()
    assert right > 0.95
    assert false == 0
