"""Tables of the batch layer: parquet folders, or a database over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_jdbc(spark: SparkSession, url: str, table: str, *, partition_column: str | None = None,
              bounds: tuple[str, str] | None = None, partitions: int = 32,
              **options: str) -> DataFrame:
    """A database table; with a column and its bounds it is read by many tasks at once."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition_column is not None and bounds is not None:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", bounds[0]).option("upperBound", bounds[1])
                  .option("numPartitions", str(partitions)))
    return reader.load()


def overwrite_days(df: DataFrame, path: str, day_column: str, *sort_by: str) -> None:
    """Replaces exactly the days that ``df`` holds, so a rerun or a backfill is safe.

    The rebalance gives files of an even size, and splits a day that holds most rows.
    Sorted files let a reader skip most row groups by their bounds.
    """
    (df.hint("rebalance", day_column).sortWithinPartitions(day_column, *sort_by)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(day_column).parquet(path))


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
