"""Reads that start at the newest day folder and stop when older ones cannot matter.

A lake partitioned by ``day`` keeps all rows of a later day apart from those of an earlier one.  The newest N rows, or the
latest row of each wanted key, are complete as soon as enough rows, or all keys, have been seen; the folders behind are
never opened.  Folders are opened in growing steps (1, 2, 4, ... days), so sparse days cost few jobs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.operators.joins import checked_broadcast
from quotelake.operators.latest import latest_per_key, top_k

NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def day_folders(spark: SparkSession, path: str, column: str = "day") -> list[str]:
    """Values of the partition column, newest first and rows without a day last; one name per day, not per file."""
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in folder.getFileSystem(sc._jsc.hadoopConfiguration()).listStatus(folder)]
    values = [n.split("=", 1)[1] for n in names if n.startswith(column + "=")]
    return sorted((v for v in values if v != NO_DAY), reverse=True) + [v for v in values if v == NO_DAY]


def _steps(days: Sequence[str]):
    at, size = 0, 1
    while at < len(days):
        yield days[at:at + size]
        at, size = at + size, 2 * size


class NewestFirst:
    """Newest-first reads of one lake folder; ``opened`` lists the days that the last read touched."""

    def __init__(self, spark: SparkSession, path: str, column: str = "day"):
        self.spark, self.path, self.column = spark, path, column
        self.opened: list[str] = []

    def _read(self, days: Sequence[str]) -> DataFrame:
        self.opened += days
        return self.spark.read.option("basePath", self.path).parquet(*[f"{self.path}/{self.column}={d}" for d in days])

    def latest_n(self, n: int, by: Sequence[Column]) -> DataFrame:
        """The first ``n`` rows in ``by`` order, which must start with the time, newest first."""
        self.opened, found, parts = [], 0, None
        for days in _steps(day_folders(self.spark, self.path, self.column)):
            part = top_k(self._read(days), by, n).checkpoint()      # at most n rows
            found += part.count()
            parts = part if parts is None else parts.unionByName(part)
            if found >= n:
                break
        if parts is None:
            raise ValueError(f"no {self.column} folders under {self.path}")
        return top_k(parts, by, n)

    def latest_per_key(self, wanted: DataFrame, key: str = "symbol", order: Sequence[str] = ("recorded_at", "row_id"),
                       columns: Sequence[str] | None = None) -> DataFrame:
        """The latest row of every key in ``wanted`` (a table of keys, for example the symbol list); null keys match none."""
        self.opened, parts = [], None
        missing = wanted.select(F.col(key).alias("_key")).filter(F.col("_key").isNotNull()).distinct().checkpoint()
        for days in _steps(day_folders(self.spark, self.path, self.column)):
            rows = self._read(days).join(checked_broadcast(missing), F.col(key) == F.col("_key"), "left_semi")
            part = latest_per_key(rows, key, order, columns, method="max_by").checkpoint()
            parts = part if parts is None else parts.unionByName(part)
            missing = missing.join(part, F.col("_key") == F.col(key), "left_anti").checkpoint()
            if missing.isEmpty():
                break
        if parts is None:
            raise ValueError(f"no {self.column} folders under {self.path}")
        return parts
