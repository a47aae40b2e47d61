"""Every registered query against its SQL, on the given tables."""

from __future__ import annotations

import os
import re

import compare
import pytest

import __spark_entry__ as registry

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not present")


@pytest.fixture(scope="module")
def db():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    """All but those of the training-data part, which has tests of its own for the others."""
    without = set(registry.queries()) - set(registry.oracle_sql())
    assert all(re.match(r"op\d+_|pipeline$", name) for name in without)


def test_entry_returns_rows(spark):
    assert registry.entry(spark).count() == 5


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, db, name):
    ours = registry.queries()[name](spark, SF_DIR).toArrow()
    theirs = db.sql(registry.oracle_sql()[name]).to_arrow_table()
    assert compare.differences(ours, theirs) == []
