"""What came in: columns, types, rows, nulls, and cells that did not parse or lost digits."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame

from starcart.functions.parsing import Formats, format_counts, formats_of, literal, parsed, rounded, unparsed
from starcart.schemas import SOURCE_TABLES


def format_profile(raw: Mapping[str, DataFrame], patterns: Mapping[str, Formats]) -> DataFrame:
    """How many cells each format of a column was the first to fit, from one scan per table.

    One row per format of the text columns that ``patterns`` names, in the order they are tried, and one
    with ``position`` 0 and no format for the cells that fit none.
    """
    parts = []
    for name, columns in SOURCE_TABLES.items():
        have = dict(raw[name].dtypes) if name in raw else {}
        totals, cells = [], []
        for column, pattern in patterns.items():
            if column not in columns or have.get(column) != "string":
                continue
            want, formats = columns[column], formats_of(pattern)
            counts = [unparsed(column, "string", want, pattern), *format_counts(column, "string", want, pattern)]
            for position, (label, count) in enumerate(zip([None, *formats], counts, strict=True)):
                place = f"n{len(totals)}"
                totals.append(f"count_if({count}) as {place}")
                text = literal(label) if label else "cast(null as string)"
                cells.append(
                    f"named_struct('column_name', '{column}', 'position', {position}, "
                    f"'format', {text}, 'cell_count', {place})"
                )
        if totals:
            found = raw[name].selectExpr(*totals)
            parts.append(found.selectExpr(f"'{name}' as table_name", f"inline(array({', '.join(cells)}))"))
    if not parts:
        raise ValueError("no text column of the given tables has a format")
    return reduce(DataFrame.unionByName, parts)


def source_profile(
    raw: Mapping[str, DataFrame], patterns: Mapping[str, Formats] | None = None
) -> DataFrame:
    """One row per column of the given source tables, from one scan and one global aggregate per table.

    ``actual_type`` is the column's type as it came, ``data_type`` the wanted one; ``status`` is
    ``present``, ``missing`` (no actual type, all rows null) or ``extra`` (no wanted type).
    ``null_count`` counts nulls of the typed column, ``reject_count`` those among them that held something,
    ``rounded_count`` decimals that were kept with fewer digits.
    """
    parts = []
    for name, columns in SOURCE_TABLES.items():
        if name not in raw:
            continue
        have = dict(raw[name].dtypes)
        totals, cells = ["count(1) as row_count"], []
        for i, column in enumerate(dict.fromkeys([*columns, *have])):
            want, actual = columns.get(column), have.get(column)
            pattern = (patterns or {}).get(column)
            if actual is None:
                status, filled, rejected, lost = "missing", "0L", "0L", "0L"
            elif want is None:
                status, filled, rejected, lost = "extra", f"count(`{column}`)", "0L", "0L"
            else:
                status = "present"
                filled = f"count({parsed(column, actual, want, pattern)})"
                rejected = f"count_if({unparsed(column, actual, want, pattern)})"
                lost = f"count_if({rounded(column, actual, want)})"
            totals += [f"{filled} as filled{i}", f"{rejected} as rejected{i}", f"{lost} as lost{i}"]
            types = ", ".join(
                f"'{key}', {f"'{kind}'" if kind else 'cast(null as string)'}"
                for key, kind in (("data_type", want), ("actual_type", actual))
            )
            cells.append(
                f"named_struct('column_name', '{column}', {types}, 'status', '{status}', "
                f"'row_count', row_count, 'null_count', row_count - filled{i}, "
                f"'reject_count', rejected{i}, 'rounded_count', lost{i})"
            )
        constant = [t for t in totals if t.startswith("0L")]
        parts.append(
            raw[name]
            .selectExpr(*[t for t in totals if t not in constant])
            .selectExpr("*", *constant)
            .selectExpr(f"'{name}' as table_name", f"inline(array({', '.join(cells)}))")
        )
    return reduce(DataFrame.unionByName, parts)
