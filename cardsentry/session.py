"""Session settings used by tests and the bench; on a cluster they come from outside."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cores: int | str = 8, app: str = "cardsentry", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    )
    if "spark.checkpoint.dir" not in conf:
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="cardsentry-"))
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor can reach, which the cluster names in spark.checkpoint.dir.

    Where nothing names one, as in tests on one machine, a new temporary folder becomes the
    checkpoint folder of the application, and stays it.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="cardsentry-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Removes intermediate rows once what was made from them has been written."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def written(df: DataFrame, path: str) -> DataFrame:
    """Rows written once in the shared folder and read back: no lineage, and no second run."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(df: DataFrame) -> DataFrame:
    """Rows computed once, where they are first asked for, and held on the executors' disks.

    They have their lineage: Spark computes those of a lost executor again. No files are made, so
    no task opens, describes and renames any.
    """
    return df.persist(StorageLevel.DISK_ONLY)
