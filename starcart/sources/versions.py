"""A star in files whose versions are published whole: a reader sees all of one refresh or nothing of it.

    {root}/versions/{token}/{table}    the tables of one refresh
    {root}/manifests/{number}/         one row, written after all tables are there

A refresh writes into a folder of its own, so a failed one leaves nothing that a reader would look at. The
manifest is a single file, which appears at once. Readers open the latest manifest and stay with its
folder. Two refreshes that end together may write the same number: then the one with the lesser token has
published, for every reader alike, and the other one is told. Nothing is deleted; old folders may go once
nobody reads them.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starcart.schemas import STAR_TABLES
from starcart.sources.stores import FileStore

_MANIFEST = "number bigint, token string, format string, published_at timestamp_ntz, row_counts map<string, bigint>"


class NotPublished(RuntimeError):
    """There is no such version, or another refresh has published in its place."""


@dataclass(frozen=True)
class VersionedStore:
    """Versions of a star under ``root``; ``fmt``, ``files`` and ``options`` are as for ``FileStore``."""

    root: str
    fmt: str = "parquet"
    files: int | None = None
    options: Mapping[str, str] | None = None

    def _folder(self, token: str, fmt: str) -> FileStore:
        return FileStore(f"{self.root.rstrip('/')}/versions/{token}", fmt, self.files, self.options)

    def begin(self) -> FileStore:
        """A store for a new version, which no reader sees before it is published."""
        return self._folder(uuid.uuid4().hex, self.fmt)

    def manifests(self, spark: SparkSession) -> DataFrame:
        """The published versions, one row per number."""
        try:
            found = spark.read.schema(_MANIFEST).json(f"{self.root.rstrip('/')}/manifests/*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            found = spark.createDataFrame([], _MANIFEST)
        first = Window.partitionBy("number").orderBy("token")
        return found.withColumn("_place", F.row_number().over(first)).where("_place = 1").drop("_place")

    def publish(self, spark: SparkSession, version: FileStore) -> int:
        """Make a version from ``begin`` the current one; its number.

        All eight tables are opened and counted first, so a version that lacks one is not published.
        """
        counts = {table: version.read(spark, table).count() for table in STAR_TABLES}
        token = version.root.rsplit("/", 1)[1]
        latest = self.manifests(spark).agg(F.max("number")).first()[0] or 0
        row = (latest + 1, token, version.fmt, dt.datetime.now(dt.UTC).replace(tzinfo=None), counts)
        path = f"{self.root.rstrip('/')}/manifests/{latest + 1:012d}"
        spark.createDataFrame([row], _MANIFEST).coalesce(1).write.mode("append").json(path)
        winner = self.manifests(spark).where(F.col("number") == latest + 1).first()
        if winner.token != token:
            raise NotPublished(f"another refresh has become version {latest + 1}")
        return latest + 1

    def at(self, spark: SparkSession, number: int | None = None) -> FileStore:
        """The tables of a version, the latest by default; they stay what they are while others are published."""
        manifests = self.manifests(spark)
        if number is not None:
            manifests = manifests.where(F.col("number") == number)
        row = manifests.orderBy(F.desc("number")).first()
        if row is None:
            raise NotPublished(f"no version {number or ''} under {self.root}")
        return self._folder(row.token, row.format)
