"""Counting join results without building them.

A report that counts (or sums over) the rows of a chain of joins does not need
those rows. Group every side by what the join and the report use, carry the
number of rows as a weight, and multiply weights where rows match. The totals are
the same as over the full join, with duplicated keys on either side too, and

* a key that holds a third of all rows is one row per map task before it is
  shuffled, so no reducer receives it whole;
* duplicates on both sides of a join never multiply on the wire.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counted(df: DataFrame, *keys: str, weight: str = "n") -> DataFrame:
    """Distinct ``keys`` of ``df`` with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(weight))


def matches(weight: str) -> Column:
    """Right-hand weight of a left join: an unmatched row still counts once."""
    return F.coalesce(F.col(weight), F.lit(1))
