"""Hosts, rules and shrunk shares; the whole query is held against its SQL in test_queries."""

from __future__ import annotations

import random

import compare
import duckdb
import pytest
from pyspark.sql import functions as F

from starcart.llm.reputation import (
    ORACLE_SQL,
    document_of,
    domain_of,
    host_of,
    judged,
    path_of,
    reputations,
    rule_of,
    suffix_of,
)


@pytest.mark.parametrize(
    ("url", "host", "path", "rule", "verdict"),
    [
        ("http://A.Example.NET/en/1?q#f", "a.example.net", "/en/1", "example.net/en/", "allow"),
        ("http://example.net/fr/en/", "example.net", "/fr/en/", "net/", "block"),
        ("https://x.example.com/de/5", "x.example.com", "/de/5", "example.com/de/", "block"),
        ("https://notexample.com/de/5", "notexample.com", "/de/5", None, None),
        ("https://sub.x.org/fr/", "sub.x.org", "/fr/", "org/fr/", "allow"),
        ("http://net/", "net", "/", "net/", "block"),
        ("http://x.net", "x.net", "", None, None),
        ("http://x.com#/de/", "x.com", "", None, None),
        ("a://b?c://d/e", "b", "", None, None),
        ("no scheme", "", "", None, None),
        ("", "", "", None, None),
        (None, "", "", None, None),
    ],
)
def test_urls_and_rules(spark, url, host, path, rule, verdict):
    df = spark.createDataFrame([(url,)], "url string")
    row = df.select(host_of(F.col("url")).alias("h"), path_of(F.col("url")).alias("p"))
    row = row.select("h", "p", rule_of(F.col("h"), F.col("p")).alias("r")).first()
    assert (row.h, row.p) == (host, path)
    assert (row.r and row.r.rule, row.r and row.r.verdict) == (rule, verdict)


def test_domains(spark):
    hosts = ["a.b.example.com", "b.co.uk", "x.y.b.co.uk:80", "com", "", "co.uk"]
    df = spark.createDataFrame([(h,) for h in hosts], "h string").withColumn("s", suffix_of(F.col("h")))
    rows = df.select("s", domain_of(F.col("h"), F.col("s")).alias("d")).collect()
    assert [tuple(r) for r in rows] == [
        ("com", "example.com"), ("co.uk", "b.co.uk"), ("co.uk", "b.co.uk"), ("com", "com"), ("", ""), ("co.uk", "co.uk"),
    ]


def test_documents(spark):
    paths = ["/en/12", "/en/12.html", "/en/12/", "/12x", "", "/x/99999999999999999999"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r[0] for r in df.select(document_of(F.col("p"))).collect()] == [12, 12, 12, None, None, None]


def test_shrinking(spark):
    """Domains that differ keep their own shares; a small host follows its domain, a large one itself."""
    rng = random.Random(1)
    rows = []
    for d in range(40):
        share = 0.9 if d % 4 == 0 else 0.1
        for h in range(6):
            n = 2 if h == 0 else 60
            rows.append((f"h{h}.d{d}.com", float(n), float(sum(rng.random() < share for _ in range(n)))))
        rows.append((f"new.d{d}.com", 0.0, 0.0))
    out = {r.host: r for r in reputations(spark.createDataFrame(rows, "host string, n double, bad double")).collect()}
    assert all((out[f"{h}.d{d}.com"].bound > 0.5) == (d % 4 == 0) for d in range(40) for h in ("h0", "h1", "new"))
    assert all(0 < r.bound < r.share < 1 for r in out.values())


@pytest.mark.parametrize("hot", [False, True])
def test_one_hot_host_does_not_decide_for_all(spark, hot):
    """A host with a third of the pages, at the mean rate, leaves the bad hosts blocked."""
    rng = random.Random(2)
    draw = lambda n: float(sum(rng.random() < 0.03 for _ in range(n)))
    rows = [(f"bad{i}.com", 50.0, 50.0) for i in range(100)] + [(f"h{i}.com", 50.0, draw(50)) for i in range(900)]
    if hot:
        share = sum(r[2] for r in rows) / sum(r[1] for r in rows)
        rows.append(("hot.com", 25_000.0, float(round(25_000 * share))))
    out = {r.host: r for r in reputations(spark.createDataFrame(rows, "host string, n double, bad double")).collect()}
    assert {h for h, r in out.items() if r.bound > 0.5} == {f"bad{i}.com" for i in range(100)}


def test_a_few_bad_hosts_beside_a_hot_one(spark):
    rng = random.Random(3)
    rows = [(f"bad{i}.com", 50.0, 50.0) for i in range(8)]
    rows += [(f"h{i}.com", 50.0, float(sum(rng.random() < 0.03 for _ in range(50)))) for i in range(992)]
    rows.append(("hot.com", 25_000.0, 950.0))
    out = {r.host: r for r in reputations(spark.createDataFrame(rows, "host string, n double, bad double")).collect()}
    assert {h for h, r in out.items() if r.bound > 0.5} == {f"bad{i}.com" for i in range(8)}


def test_odd_rows(spark):
    pages = [(1, None), (2, "x"), (3, "http://a.com/1"), (3, "http://a.com/1"), (None, "http://a.com/2")]
    pages = spark.createDataFrame(pages, "page_id long, url string").withColumns(
        {"host": F.lit("other"), "verdict": F.lit("other"), "quality": F.lit(0)}
    )
    labels = spark.createDataFrame([(1, 0, None), (1, 1, 0), (None, 0, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    rows = judged(pages, labels).collect()
    assert sorted((r.host, r.verdict) for r in rows) == [("", "allow")] * 2 + [("a.com", "allow")] * 3
    assert judged(pages.limit(0), labels).count() == 0
    assert judged(pages, labels.limit(0)).count() == 5


@pytest.mark.parametrize("hot", [0, 2_000])
def test_the_sql_is_the_same_estimate(spark, hot):
    """Hosts that differ, beside one that holds a third of the pages: verdicts of the query and of its SQL."""
    rng = random.Random(6)
    pages, labels, number = [], [], 0
    hosts = [(f"h{i}.d{i % 7}.com", 20, 1.0 if i % 10 == 0 else 0.04) for i in range(180)]
    hosts += [(f"s{i}.co.uk", 3, 0.5) for i in range(20)] + [("empty.com", 0, 0.0)]
    hosts += [("hot.com", hot, 0.1)] if hot else []
    for host, n, share in hosts:
        for _ in range(n):
            pages.append((number, f"http://{host}/x/{number}"))
            labels.append((number, int(rng.random() >= share), 0))
            number += 1
        pages.append((number + 10**6, f"http://{host}/x/y"))
    pages_df = spark.createDataFrame(pages, "page_id long, url string")
    labels_df = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    ours = judged(pages_df, labels_df).drop("share").toArrow()
    db = duckdb.connect()
    db.register("pages", pages_df.toArrow())
    db.register("labels", labels_df.toArrow())
    theirs = db.sql(ORACLE_SQL).to_arrow_table()
    assert compare.differences(ours, theirs) == []
    blocked = {r["host"] for r in ours.to_pylist() if r["verdict"] == "block"}
    assert {f"h{i}.d{i % 7}.com" for i in range(0, 180, 10)} <= blocked and "hot.com" not in blocked
