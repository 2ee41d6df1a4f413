"""Tables as versions: a small commit table lists the folders that make up each one.

Writers put data into folders of their own and then commit: the commit is one small file,
so readers see either the old list or the new one, and whoever reads the old one is not
disturbed, as its folders stay until they are vacuumed. A job that dies before its commit
leaves folders that no version lists. One writer at a time; a second one of the same
version is refused.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PIECE = "piece"  # folder of a piece, below the table's own


def _located(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a folder, in whatever file system the path names."""
    system, target = _located(spark, path)
    return system.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of whatever file system the path names."""
    system, target = _located(spark, path)
    system.delete(target, True)


class Conflict(Exception):
    """Another writer has committed this version."""


@dataclass(frozen=True)
class Versioned:
    """A table below ``base``. A version is a frame with one row per piece: its folder and
    whatever the kind of table keeps about it (bucket, bounds, rows)."""

    spark: SparkSession
    base: str

    def _commits(self) -> DataFrame | None:
        folder = f"{self.base}/commits"
        return self.spark.read.parquet(folder) if exists(self.spark, folder) else None

    def current(self) -> int | None:
        """Number of the newest version, from the names of the commit files alone."""
        commits = self._commits()
        names = [] if commits is None else commits.inputFiles()
        return max((int(re.search(r"/version=(\d+)/", n)[1]) for n in names), default=None)

    def pieces(self, version: int | None = None) -> DataFrame | None:
        """The list of one version, the newest if none is named; None before the first."""
        version = self.current() if version is None else version
        if version is None:
            return None
        return self.spark.read.parquet(f"{self.base}/commits/version={version}")

    def new_folder(self, kind: str = "data") -> str:
        """A fresh folder, below the table's own, that no version lists yet."""
        return f"{kind}/{uuid.uuid4().hex}"

    def commit(self, pieces: DataFrame, after: int | None) -> int:
        """Make ``pieces`` the version that follows ``after``, in one file."""
        version = 0 if after is None else after + 1
        if self.current() != after:
            raise Conflict(f"{self.base} is past version {after}")
        pieces.coalesce(1).write.mode("error").parquet(f"{self.base}/commits/version={version}")
        return version

    def read(self, schema: StructType, pieces: DataFrame | None = None) -> DataFrame:
        """Rows of the given pieces (of the newest version's). The driver holds their folder
        names, as Spark's own file index does."""
        pieces = self.pieces() if pieces is None else pieces
        folders = [] if pieces is None else [r[0] for r in pieces.select(PIECE).collect()]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.base}/{f}" for f in folders])

    def vacuum(self, keep: int = 1) -> int:
        """Remove the folders that none of the newest ``keep`` versions lists; returns how many.

        Only what an older version lists is looked at, so a writer that has not committed yet
        keeps its folders.
        """
        commits, newest = self._commits(), self.current()
        if commits is None:
            return 0
        live = commits.where(F.col("version") > newest - keep).select(PIECE)
        gone = [r[0] for r in commits.select(PIECE).distinct().join(
            live, PIECE, "left_anti").collect()]
        for folder in gone:
            remove(self.spark, f"{self.base}/{folder}")
        return len(gone)
