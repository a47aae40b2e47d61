"""Where a star is kept: directories of Parquet or CSV files, or a JDBC database."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starcart.functions.parsing import typed
from starcart.schemas import STAR_TABLES
from starcart.sources.files import read_csv

# Spark's CSV writer trims outer blanks and writes times to the millisecond, and
# its reader turns empty text into null. These settings, used on both ways, keep
# all three. ``\N`` stands for null.
EXACT_CSV = {
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "quoteAll": "true",
    "nullValue": "\\N",
    "emptyValue": "",
    "escape": '"',
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}

# Formats whose files give back what was written.
_EXACT_FORMATS = ("parquet", "orc")
_COMPRESSED = {"compression": "zstd"}


# How exact CSV writes what would end a record, and the sign of such a way of writing itself.
# No text reads ``\N`` then, and a file can be read in parts.
_ESCAPES = (("\\", "\\b"), ("\n", "\\n"), ("\r", "\\r"))


def _replaced(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Text columns with one text for another, in the given order."""

    def changed(name: str) -> Column:
        column = F.col(f"`{name}`")
        for old, new in pairs:
            column = F.replace(column, F.lit(old), F.lit(new))
        return column.alias(name)

    return df.select(*[changed(n) if kind == "string" else F.col(f"`{n}`") for n, kind in df.dtypes])


def _escaped(df: DataFrame) -> DataFrame:
    """Rows whose texts stay on one line; ``_unescaped`` gives back any text."""
    return _replaced(df, list(_ESCAPES))


def _unescaped(df: DataFrame) -> DataFrame:
    """Every backslash begins an escape, so the last pair, a plain backslash, can wait for the others."""
    return _replaced(df, [(new, old) for old, new in reversed(_ESCAPES)])


@dataclass(frozen=True)
class FileStore:
    """One directory per table under ``root``; any file system Spark can write to.

    ``fmt`` is ``"parquet"`` (typed, columnar, exact) or ``"csv"`` (with header).
    ``files`` sets the number of files per table at the price of one more shuffle;
    without it every write task leaves one file, and adaptive execution sizes the tasks by
    bytes. ``options`` go to Spark's writer and reader; without them CSV is written as
    ``EXACT_CSV`` with line breaks and backslashes escaped, which gives back what was written,
    and Parquet and ORC are compressed with zstd.
    """

    root: str
    fmt: str = "parquet"
    files: int | None = None
    options: Mapping[str, str] | None = None

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def write(self, df: DataFrame, table: str) -> None:
        """Replace the table's directory."""
        if self.files:
            df = df.repartition(self.files)
        options = dict(self._options)
        if self.fmt == "csv":
            options["header"] = "true"
            df = _escaped(df) if self.exact else df
        df.write.mode("overwrite").format(self.fmt).options(**options).save(self.path(table))

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """The table with its declared types."""
        if self.fmt == "csv":
            raw = read_csv(spark, self.path(table), **self._options)
        else:
            raw = spark.read.format(self.fmt).options(**self._options).load(self.path(table))
        found = typed(raw, STAR_TABLES[table])
        return _unescaped(found) if self.fmt == "csv" and self.exact else found

    @property
    def exact(self) -> bool:
        """Whether what is read back equals what was written."""
        if self.fmt == "csv":
            return dict(self._options) == EXACT_CSV
        return self.fmt in _EXACT_FORMATS

    @property
    def _options(self) -> Mapping[str, str]:
        if self.options is None:
            return EXACT_CSV if self.fmt == "csv" else _COMPRESSED if self.fmt in _EXACT_FORMATS else {}
        return self.options


@dataclass(frozen=True)
class JdbcStore:
    """One database table per star table, dropped and created anew by a write.

    ``properties`` holds driver, user and password as the caller supplies them;
    the driver's jar has to be on Spark's class path. ``connections`` bounds how
    many tasks write, or read, at once. ``hashes`` gives per table an expression of the database's
    own SQL with a whole number per row, e.g. ``{"orders_dim": "hashtext(order_id)"}``; such a table is
    read over ``connections`` connections, any other over one. ``options`` go to Spark's JDBC
    reader and writer (``batchsize``, ``fetchsize``).
    """

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    connections: int = 8
    options: Mapping[str, str] = field(default_factory=dict)
    hashes: Mapping[str, str] = field(default_factory=dict)

    def write(self, df: DataFrame, table: str) -> None:
        """Replace the table. The rows are dealt to the connections by a shuffle, so that the work before it
        keeps its own number of tasks."""
        df.repartition(self.connections).write.mode("overwrite").options(**self.options).jdbc(
            self.url, table, properties=dict(self.properties)
        )

    def parts(self, table: str) -> list[str] | None:
        """Conditions that part the table's rows, each row under exactly one."""
        if table not in self.hashes:
            return None
        remainder = f"mod(abs(coalesce({self.hashes[table]}, 0)), {self.connections})"
        return [f"{remainder} = {i}" for i in range(self.connections)]

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        reader = spark.read.options(preferTimestampNTZ="true", **self.options)
        raw = reader.jdbc(
            self.url, table, predicates=self.parts(table), properties=dict(self.properties)
        )
        return typed(raw, STAR_TABLES[table])

    @property
    def exact(self) -> bool:
        """Databases may pad or narrow text, so the load does not build on a re-read."""
        return False
