from __future__ import annotations

import sys
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from starcart.plans.refresh import build_star
from starcart.plans.session import prepare
from starcart.schemas import SOURCE_TABLES
from starcart.sources.files import typed_sources


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


def raw_tables(spark, **rows):
    """Source tables as text; ``rows`` maps a table name to a list of dicts."""
    tables = {}
    for name, columns in SOURCE_TABLES.items():
        given = rows.get(name, [])
        tables[name] = spark.createDataFrame(
            pa.table({c: pa.array([row.get(c) for row in given], pa.string()) for c in columns})
        )
    return tables


@pytest.fixture
def raw(spark):
    return lambda **rows: raw_tables(spark, **rows)


@pytest.fixture
def star_of(spark):
    """Build a star from lists of text rows, e.g. ``star_of(orders=[{...}])``."""

    def make(date_start="2000-01-01", date_end="2030-01-01", separator="", **rows):
        sources = typed_sources(raw_tables(spark, **rows))
        return build_star(spark, sources, date_start, date_end, separator)

    return make


def values(df):
    return [tuple(row) for row in df.collect()]
