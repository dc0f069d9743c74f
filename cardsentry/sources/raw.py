"""Raw wire lines: a Kafka topic in production, text files in tests and backfills."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Rows one micro-batch may admit. It also bounds what a single hot card can bring
# into one task of the stateful operator, so a stream is never read without it.
MAX_OFFSETS_PER_TRIGGER = 5_000_000
MAX_FILES_PER_TRIGGER = 1000


def kafka_lines(spark: SparkSession, servers: str, topic: str = "transactions",
                max_offsets: int = MAX_OFFSETS_PER_TRIGGER, **options: str) -> DataFrame:
    """One binary ``value`` per record, untouched, from the earliest offset on.

    Each query gets a consumer group of its own, so that two queries never share the records.
    Written against Spark's connector, which is not on this machine: never run here.
    """
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", "earliest")
            .option("maxOffsetsPerTrigger", str(max_offsets))
            .options(**options)
            .load()
            .select("value"))


def file_lines(spark: SparkSession, folder: str, max_files: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """A growing folder of text files as a stream of lines."""
    return (spark.readStream.format("text")
            .option("maxFilesPerTrigger", str(max_files))
            .load(folder)
            .select(F.col("value").cast("binary").alias("value")))


def batch_lines(spark: SparkSession, *paths: str) -> DataFrame:
    return (spark.read.text(list(paths))
            .select(F.col("value").cast("binary").alias("value")))
