"""The registered queries: against their SQL, and the pipeline against its operators' own tests."""

from __future__ import annotations

import os

import compare
import corpus_pipeline
import pytest

from starcart.llm.queries import ORACLE_SQL, QUERIES, table

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not present")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    ours = QUERIES[name](spark, SF_DIR).toArrow()
    theirs = compare.connect(SF_DIR).sql(ORACLE_SQL[name]).to_arrow_table()
    assert compare.differences(ours, theirs) == []


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op4", "op5", "op7"])
def test_a_row_per_document(spark, name):
    (full,) = [n for n in QUERIES if n.startswith(f"{name}_")]
    ids = [r.doc_id for r in QUERIES[full](spark, SF_DIR).select("doc_id").collect()]
    given = [r.doc_id for r in table(spark, SF_DIR, "documents").select("doc_id").collect()]
    assert sorted(ids) == sorted(given)


def test_stages_keep_the_columns(spark, odd_docs):
    columns = odd_docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        if name == "near_dedup":  # in test_near_dedup
            continue
        out = stage(spark, odd_docs, SF_DIR)
        assert out.columns == columns
        assert out.dtypes == odd_docs.dtypes
    assert corpus_pipeline.STAGES[-1][1](spark, odd_docs, SF_DIR).count() == 11


def test_run_is_the_stages_by_hand(spark):
    """What each stage drops, found again by brute force on its own input."""
    from llm.test_decontamination import slow_tiles
    from llm.test_near_dedup import all_pairs
    from starcart.llm.decontamination import plain_words
    from starcart.llm.near_dedup import Rule
    from starcart.llm.toxicity import fit_toxicity, toxicity

    docs = table(spark, SF_DIR, "documents")
    model = fit_toxicity(docs, table(spark, SF_DIR, "labels"))
    toxic = {r.doc_id for r in toxicity(docs, model).where("score >= 0.7").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id not in toxic]
    components, _ = all_pairs(rows, Rule())
    rows = [row for row, c in zip(rows, components, strict=True) if row[0] == c]
    items = [r.text.encode() for r in table(spark, SF_DIR, "benchmark").collect()]
    words, first = plain_words(items)
    items = [words[first[k] : first[k + 1]].tolist() for k in range(len(items))]
    seeds = {tuple(i[k : k + 5]) for i in items for k in range(len(i) - 4)}
    left = set()
    for doc, text in rows:
        own = plain_words([(text or "").encode()])[0].tolist()
        hit = any(tuple(own[k : k + 5]) in seeds for k in range(len(own) - 4))
        if not hit or not any(sum(n for _, _, n in slow_tiles(own, i, 5)) >= 0.5 * len(i) for i in items):
            left.add(doc)
    out = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in out} == left
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in out)
