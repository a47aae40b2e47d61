"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def location_key(city: str, state: str, zip_code: str, separator: str = "") -> Column:
    """md5 over city, state and zip prefix; null when any part is null.

    The default joins the parts with nothing between them, so ``('ab', 'c')``
    and ``('a', 'bc')`` share a key. Pass ``separator`` for keys that keep them
    apart; such keys differ from those of a star loaded with the default.
    """
    parts = [F.col(city), F.col(state), F.col(zip_code)]
    if separator:
        parts = [parts[0], F.lit(separator), parts[1], F.lit(separator), parts[2]]
    return F.md5(F.concat(*parts))
