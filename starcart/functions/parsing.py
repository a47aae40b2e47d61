"""Text, or columns of another type, to typed columns without ever failing a job on one bad cell.

A column may have several date or time formats; they are tried in order. Times without a zone are
parsed without one, so a local time that a zone skips or repeats is an ordinary time.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

#: Stands for ISO text in a list of formats.
ISO = "ISO"

Formats = str | Sequence[str] | None

_WHOLE = ("tinyint", "smallint", "int", "bigint")
_TIMES = ("date", "timestamp_ntz", "timestamp")
# Fixed value: more digits behind the point than a decimal keeps, some not zero.
_LONG_FRACTION = "[.][0-9]{18}[0-9]*[1-9]"


def literal(text: str) -> str:
    """``text`` as an SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def formats_of(pattern: Formats) -> list[str]:
    """The formats of a column, in the order they are tried."""
    if pattern is None or isinstance(pattern, str):
        return [pattern or ISO]
    return list(pattern) or [ISO]


def _names_zone(pattern: str) -> bool:
    """Whether a format reads a zone or an offset from the text."""
    bare = re.sub("'[^']*'", "", pattern)
    return bool(set(bare) & set("VzOXxZ"))


def _time(column: str, want: str, pattern: str) -> str:
    """SQL for a text as a date or time in one format; null if it does not fit.

    A time without a zone is read as one of Greenwich, where no time is missing, and its distance from the
    epoch is kept. A text that names its own offset gives the time at Greenwich.
    """
    if pattern == ISO:
        return f"try_cast({column} as {want})"
    if want == "timestamp":
        return f"cast(try_to_timestamp({column}, {literal(pattern)}) as timestamp)"
    if not _names_zone(pattern):
        column, pattern = f"concat({column}, ' Z')", f"{pattern} XXX"
    moment = f"unix_micros(cast(try_to_timestamp({column}, {literal(pattern)}) as timestamp_ltz))"
    local = f"timestampadd(microsecond, {moment}, timestamp_ntz'1970-01-01')"
    return local if want == "timestamp_ntz" else f"cast({local} as date)"


def _attempts(name: str, have: str, want: str, pattern: Formats) -> list[str]:
    """SQL for each way to read the column, in order."""
    column = f"`{name}`"
    if have == want:
        return [column]
    if have == "string" and want in _TIMES:
        return [_time(column, want, p) for p in formats_of(pattern)]
    if want in _WHOLE and have not in _WHOLE:
        # "40" and "40.0" are both forty; "40.5" and "40.0000001" are not whole numbers
        number = f"try_cast({column} as decimal(38,18))"
        whole = f"{number} = floor({number})"
        if have == "string":
            whole += f" and not {column} rlike '{_LONG_FRACTION}'"
        return [f"if({whole}, try_cast({number} as {want}), null)"]
    return [f"try_cast({column} as {want})"]


def parsed(name: str, have: str, want: str, pattern: Formats = None) -> str:
    """SQL for column ``name`` as type ``want``; a cell that does not parse is null.

    ``pattern`` is the date or time format of a text column, or several; without it text is ISO.
    """
    attempts = _attempts(name, have, want, pattern)
    return attempts[0] if len(attempts) == 1 else f"coalesce({', '.join(attempts)})"


def format_counts(name: str, have: str, want: str, pattern: Formats = None) -> list[str]:
    """SQL per format that is true where it is the first one to fit."""
    attempts = _attempts(name, have, want, pattern)
    return [
        " and ".join([f"{attempt} is not null", *[f"{earlier} is null" for earlier in attempts[:i]]])
        for i, attempt in enumerate(attempts)
    ]


def unparsed(name: str, have: str, want: str, pattern: Formats = None) -> str:
    """SQL that is true where ``name`` holds something that ``parsed`` makes null."""
    if have == want:
        return "false"
    filled = f"trim(`{name}`) != ''" if have == "string" else f"`{name}` is not null"
    return f"{filled} and {parsed(name, have, want, pattern)} is null"


def rounded(name: str, have: str, want: str) -> str:
    """SQL that is true where ``parsed`` keeps a number but not all of its digits."""
    if not want.startswith("decimal") or have == want:
        return "false"
    wide = "double" if have in ("double", "float") else "decimal(38,18)"
    kept = parsed(name, have, want)
    lost = f"try_cast(`{name}` as {wide}) != cast({kept} as {wide})"
    if have == "string":
        lost = f"({lost} or {kept} is not null and `{name}` rlike '{_LONG_FRACTION}')"
    return f"coalesce({lost}, false)"


def typed(
    df: DataFrame, columns: Mapping[str, str], patterns: Mapping[str, Formats] | None = None
) -> DataFrame:
    """Pick ``columns`` by name, in that order, as the given types.

    ``patterns`` names the date or time formats of text columns that are not ISO.
    """
    have = dict(df.dtypes)
    return df.selectExpr(
        *[
            f"{parsed(c, have.get(c, 'string'), t, (patterns or {}).get(c))} as `{c}`"
            for c, t in columns.items()
        ]
    )
