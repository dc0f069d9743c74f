"""A table by day whose readers follow a manifest.

Each write puts the days it brings into a folder of its own, ``data/version=n``, and then a
manifest that names, for every day of the table, the version that holds it. A manifest counts once
it is written whole, so a run that fails before that leaves the table as it was, and days that
are not replaced are neither read nor written. One writer at a time is expected.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardsentry.session import drop_folder

_MANIFEST = "event_date date, version bigint"
# Manifests that stay, so that a reader of the one before can finish.
KEPT = 2


class DayTable:
    """``path`` and the name of the day column."""

    def __init__(self, spark: SparkSession, path: str, day: str = "event_date") -> None:
        self.spark, self.path, self.day = spark, path, day

    def _versions(self, kind: str) -> list[int]:
        context = self.spark.sparkContext
        where = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        files = where.getFileSystem(context._jsc.hadoopConfiguration())
        if not files.exists(where):
            return []
        names = [s.getPath() for s in files.listStatus(where)]
        done = kind == "data"  # of a manifest, only whole ones count
        path = context._jvm.org.apache.hadoop.fs.Path
        return sorted(int(p.getName().split("=")[1]) for p in names if p.getName().startswith("version=")
                      and (done or files.exists(path(p, "_SUCCESS"))))

    def _manifest(self, version: int) -> dict:
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest/version={version}")
        return {r["event_date"]: r["version"] for r in rows.collect()}  # a row per day

    def current(self) -> dict:
        """Day to version; empty before the first write."""
        versions = self._versions("manifest")
        return self._manifest(versions[-1]) if versions else {}

    def read(self, days: list | None = None) -> DataFrame | None:
        """The rows of the table, or of some days of it; None where there is none."""
        found = {d: v for d, v in self.current().items() if days is None or d in days}
        if not found:
            return None
        paths = [f"{self.path}/data/version={v}/{self.day}={d}" for d, v in sorted(found.items())]
        return self.spark.read.option("basePath", f"{self.path}/data").parquet(*paths).drop("version")

    def replace(self, days: list, make: Callable[[DataFrame | None], DataFrame], *sort_by: str) -> None:
        """The table holds, for ``days``, what ``make`` gives for the rows it had for them; a day
        without a row there goes."""
        before = self.current()
        version = max([0, *self._versions("manifest"), *self._versions("data")]) + 1
        folder = f"{self.path}/data/version={version}"
        fresh = make(self.read(days))
        (fresh.hint("rebalance", self.day).sortWithinPartitions(self.day, *sort_by)
         .write.partitionBy(self.day).parquet(folder))
        written = self._days_of(folder)
        after = {d: v for d, v in before.items() if d not in days} | {d: version for d in written}
        self._commit(version, after)
        self._clean()

    def _days_of(self, folder: str) -> list:
        context = self.spark.sparkContext
        where = context._jvm.org.apache.hadoop.fs.Path(folder)
        names = [s.getPath().getName() for s in
                 where.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(where)]
        return [datetime.date.fromisoformat(n.split("=")[1]) for n in names if n.startswith(f"{self.day}=")]

    def _commit(self, version: int, days: dict) -> None:
        rows = self.spark.createDataFrame(sorted(days.items()), _MANIFEST)
        rows.coalesce(1).write.parquet(f"{self.path}/manifest/version={version}")

    def _clean(self) -> None:
        """Drops versions that no kept manifest names, those of failed runs included."""
        manifests = self._versions("manifest")
        named = {v for m in manifests[-KEPT:] for v in self._manifest(m).values()}
        for version in self._versions("data"):
            if version not in named and version < manifests[-1]:
                drop_folder(self.spark, f"{self.path}/data/version={version}")
        for version in manifests[:-KEPT]:
            drop_folder(self.spark, f"{self.path}/manifest/version={version}")


def days_between(first, last) -> list:
    return [first + datetime.timedelta(k) for k in range((last - first).days + 1)]


def days_in(df: DataFrame, day: str = "event_date") -> list:
    """The days that a table has rows of."""
    return [r[0] for r in df.select(F.col(day)).distinct().collect()]
