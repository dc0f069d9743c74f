"""Corpus pipeline: from raw documents to packed token sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before has kept; between
stages the rows are written as Parquet and read again. All but the last give the columns of
``documents``.

A document is what its id and text say together: rows that only share an id are judged one by one.
Null and empty texts pass every filter, null ids come first, an empty table gives no row; columns
beside those of ``documents`` are dropped by the first stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.llm import decontaminate, line_dedup, ngram_join, packing, toxicity
from cardsentry.session import new_folder, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score one half or more go; learned from all labels of what is there."""
    model = toxicity.learn(spark, docs, _table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.score(docs.select(*COLUMNS), model).filter("score < 0.5").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that another document, or the same one, has before are cut out of the texts."""
    return line_dedup.dedup(spark, docs.select(*COLUMNS)).withColumn(
        "n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
        .otherwise(F.char_length("text").cast("long"))).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that with the smallest doc_id.

    Of rows that repeat both id and text one stays; those without words all do.
    """
    docs = docs.select(*COLUMNS)
    key = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ids = docs.select(F.col("doc_id").alias("id"), key.alias("key"))
    groups = ngram_join.components(spark, docs.select(key.alias("doc_id"), "text")).filter(
        "n_shingles > 0").groupBy(F.col("doc_id").alias("key")).agg(
        F.min("component_id").alias("component"), F.count("*").alias("times"))
    groups = written(groups, new_folder(spark, "pipeline-groups"))
    first = ids.join(groups, "key").groupBy("component").agg(F.min(F.struct("id", "key")).alias("first"))
    gone = groups.join(first, "component").filter(F.col("key") != F.col("first.key"))
    kept = docs.join(gone.select(F.col("key").alias("gone")), key == F.col("gone"), "left_anti")
    # Rows that repeat both id and text are few, or none.
    repeated = groups.filter("times > 1").join(first, F.col("key") == F.col("first.key"), "left_semi") \
        .select(F.col("key").alias("repeated"))
    once = kept.join(repeated, key == F.col("repeated"), "left_anti")
    return once.unionByName(docs.withColumn("repeated", key).join(repeated, "repeated", "left_semi")
                            .dropDuplicates(["repeated"]).select(*COLUMNS))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a verified passage of the benchmark go."""
    return decontaminate.clean(spark, docs.select(*COLUMNS), _table(spark, sf_dir, "benchmark"),
                               alone=decontaminate.ALONE)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens."""
    return packing.pack(spark, docs, vocabulary=public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", drop_near_duplicates),
    ("decontaminate", drop_leaks),
    ("packing", pack),
]

# A learned classifier, edit distances and differencing are beyond SQL: tests/llm holds run()
# against plain Python on a small corpus.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        folder = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
