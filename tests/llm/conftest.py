from __future__ import annotations

import random

import pyarrow as pa
import pytest

SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text", pa.string()),
        ("lang", pa.string()),
        ("source", pa.string()),
        ("n_chars", pa.int64()),
    ]
)


@pytest.fixture
def docs_of(spark):
    """A documents table from (doc_id, text) pairs; ``extra`` adds columns of other names."""

    def make(rows, **extra):
        table = pa.table(
            {
                "doc_id": [r[0] for r in rows],
                "text": [r[1] for r in rows],
                "lang": ["en"] * len(rows),
                "source": ["src0"] * len(rows),
                "n_chars": [None if r[1] is None else len(r[1]) for r in rows],
            },
            schema=SCHEMA,
        )
        for name, value in extra.items():
            table = table.append_column(name, pa.array([value] * len(rows)))
        return spark.createDataFrame(table).coalesce(2)

    return make


@pytest.fixture
def odd_docs(docs_of):
    """Nulls, empty and blank texts, a long one, ties, repeated rows, and columns with names in use."""
    rows = [
        (None, "a text without an id, which nobody else has written down so far"),
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, "word"),
        (5, "one two three four five six seven eight nine ten eleven twelve"),
        (5, "one two three four five six seven eight nine ten eleven twelve"),
        (6, "one two three four five six seven eight nine ten eleven twelve"),
        (7, " ".join(f"w{i % 997}x{i % 1009}" for i in range(60_000))),
        (8, "x" * 300_000),
        (9, "ünïcödé 😀 text with odd blanks\r\n and lines"),
    ]
    names = ("score", "kept", "ids", "size", "shard", "base", "tag", "digest", "held", "row", "quality")
    return docs_of(rows, **{name: "other" for name in names})


@pytest.fixture
def no_docs(docs_of):
    return docs_of([])


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"{rng.choice('bcdfgmnprst')}{'aeiou'[i % 5]}{i}" for i in rng.choices(range(vocabulary), k=n)]
