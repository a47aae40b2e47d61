"""Profiles from sketches, within their stated errors, however the rows were loaded."""

from __future__ import annotations

import bisect
import random

import pytest

from starcart.sources.sketches import DISTINCT_ERROR, RANK_ERROR, column_sketches, merged, sketch_profile


def profile(*loads):
    first, *rest = [column_sketches({"t": df}) for df in loads]
    for one in rest:
        first = first.unionByName(one)
    return {r.column_name: r for r in sketch_profile(merged(first)).collect()}


@pytest.mark.parametrize("parts", [1, 5])
def test_merged_loads_are_within_the_stated_errors(spark, parts):
    rng = random.Random(parts)
    rows = [(i, f"v{rng.randrange(5_000)}", rng.gauss(0, 1) if i % 10 else None) for i in range(60_000)]
    loads = [spark.createDataFrame(rows[k::parts], "id long, name string, x double") for k in range(parts)]
    found = profile(*loads)
    assert all(r.row_count == 60_000 for r in found.values())
    assert (found["x"].null_count, found["id"].null_count) == (6_000, 0)
    for column, exact in (("id", 60_000), ("name", len({r[1] for r in rows})), ("x", 54_000)):
        assert abs(found[column].approx_distinct - exact) <= DISTINCT_ERROR * exact
    values = sorted(r[2] for r in rows if r[2] is not None)
    assert (found["x"].quantiles[0], found["x"].quantiles[4]) == (values[0], values[-1])
    for q, value in zip((0.25, 0.5, 0.75), found["x"].quantiles[1:4], strict=True):
        assert abs(bisect.bisect(values, value) / len(values) - q) <= RANK_ERROR
    assert [c for c, r in found.items() if r.key_candidate] == ["id"]
    assert found["name"].quantiles is None


def test_columns_of_every_kind_and_empty_loads(spark):
    full = spark.sql(
        "select 1 as a, cast(2.5 as decimal(18,4)) as b, date'1970-01-03' as c, timestamp_ntz'1970-01-01 00:00:02' as d, "
        "'x' as e, cast(null as int) as f, true as g"
    )
    found = profile(full, full.where("false"), full)
    assert [found[c].quantiles and found[c].quantiles[2] for c in "abcdefg"] == [1.0, 2.5, 2.0, 2.0, None, None, None]
    assert [found[c].approx_distinct for c in "abcdefg"] == [1, 1, 1, 1, 1, 0, 1]
    assert not any(r.key_candidate for r in found.values())
    empty = profile(full.where("false"))
    assert all((r.row_count, r.approx_distinct, r.quantiles, r.key_candidate) == (0, 0, None, False) for r in empty.values())
