"""Where a micro-batch ends up. Every write is keyed by the batch, so a replay overwrites."""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from cardsentry.operators.alerts import latest_alerts
from cardsentry.schema import RULE_IDS

_NEVER = -(1 << 62)
_PROGRESS = (
    "parsed bigint, rejected bigint, replayed bigint, scored bigint, late bigint, alerts bigint, "
    + "".join(f"hits_{r} bigint, " for r in RULE_IDS)
    + "newest_ms bigint, watermark_ms bigint, recent array<struct<batch_id:bigint,newest_ms:bigint>>, "
      "cards array<string>, rules array<struct<rule_id:string,version:bigint>>")


@dataclasses.dataclass(frozen=True)
class Progress:
    """What a micro-batch leaves to the next one: its watermark, the newest event time up to it,
    the batches (with their newest event time) that reach into the last hour, and the tables
    that hold the remembered cards."""

    watermark_ms: int = _NEVER
    newest_ms: int | None = None
    recent: list[tuple[int, int]] = dataclasses.field(default_factory=list)
    cards: list[str] = dataclasses.field(default_factory=list)

    def next_watermark(self, delay_ms: int) -> int:
        newest = _NEVER if self.newest_ms is None else self.newest_ms - delay_ms
        return max(self.watermark_ms, newest)

    def after(self, batch_id: int, own_newest: int | None, keep_ms: int) -> tuple[int | None, list]:
        """The newest event time and the recent batches once ``batch_id`` is in."""
        if own_newest is None:
            return self.newest_ms, self.recent
        newest = own_newest if self.newest_ms is None else max(own_newest, self.newest_ms)
        return newest, [(b, n) for b, n in [*self.recent, (batch_id, own_newest)]
                        if n > newest - keep_ms]


class LostProgress(RuntimeError):
    """The progress of the micro-batch before is not there, so lateness and memory are unknown."""


@dataclasses.dataclass(frozen=True)
class Tables:
    """Folders of the stream below one root every executor can reach."""

    root: str

    def of(self, table: str, batch_id: int | None = None) -> str:
        folder = f"{self.root}/{table}"
        return folder if batch_id is None else f"{folder}/batch_id={batch_id}"

    def _files(self, spark: SparkSession, path: str):
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where

    def exists(self, spark: SparkSession, path: str) -> bool:
        files, where = self._files(spark, path)
        return files.exists(where)

    def parts(self, spark: SparkSession, path: str, column: str) -> list[str]:
        """Values of the partition column of a written folder."""
        files, where = self._files(spark, path)
        names = [s.getPath().getName() for s in files.listStatus(where)]
        return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))

    def write(self, df: DataFrame, table: str, batch_id: int, by: str | None = None) -> DataFrame:
        """Writes one batch and hands back what was written, free of its lineage."""
        path = self.of(table, batch_id)
        writer = df.write.mode("overwrite")
        (writer if by is None else writer.partitionBy(by)).parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.parquet(self.of(table))

    def progress_before(self, spark: SparkSession, batch_id: int) -> Progress:
        """What the batch before left behind; reads one row, and fails without it."""
        if batch_id == 0:
            return Progress()
        path = self.of("progress", batch_id - 1)
        if not self.exists(spark, f"{path}/_SUCCESS"):
            raise LostProgress(f"no progress of micro-batch {batch_id - 1} at {path}")
        row = spark.read.schema(_PROGRESS).parquet(path).first()
        return Progress(row["watermark_ms"], row["newest_ms"],
                        [(r["batch_id"], r["newest_ms"]) for r in row["recent"]], list(row["cards"]))

    def write_progress(self, spark: SparkSession, batch_id: int, row: dict) -> None:
        spark.createDataFrame([row], _PROGRESS).coalesce(1).write.mode("overwrite").parquet(
            self.of("progress", batch_id))

    def alerts(self, spark: SparkSession) -> DataFrame:
        """The alert table: one row per transaction, ``inserted_at`` the first one."""
        return latest_alerts(self.read(spark, "alerts").drop("batch_id"))


def counters(alert: Column) -> list[Column]:
    """What is counted over scored rows while they are written."""
    def hits(rule_id: str) -> Column:
        return F.sum(F.size(F.filter("hits", lambda h: h["rule_id"] == rule_id)))

    return [F.count(F.lit(1)).alias("scored"), F.count(F.when(F.col("is_late"), 1)).alias("late"),
            F.count(F.when(alert, 1)).alias("alerts"),
            *[F.coalesce(hits(r), F.lit(0)).alias(f"hits_{r}") for r in RULE_IDS],
            F.max("event_ms").alias("newest_ms")]


class CounterListener(StreamingQueryListener):
    """Adds up the counters that running queries observe, by their names."""

    def __init__(self) -> None:
        self.totals: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for row in event.progress.observedMetrics.values():
            for name, value in row.asDict().items():
                self.totals[name] = self.totals.get(name, 0) + int(value or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def publish(df: DataFrame, key: str, value: Column, servers: str, topic: str) -> None:
    """Writes one JSON line per row to a Kafka topic, keyed for compaction."""
    (df.select(F.col(key).alias("key"), value.alias("value"))
     .write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save())
