"""Links between ids are few rows, and make few files whatever the number of shuffle partitions."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cardsentry.llm import components


@pytest.fixture
def files(spark, monkeypatch):
    """Files of each folder that is written, with 48 shuffle partitions that stay apart."""
    made, plain = [], components.written

    def written(df, path):
        out = plain(df, path)
        made.append((Path(path.removeprefix("file:")).name.split("-")[0],
                     len(out.inputFiles())))
        return out

    monkeypatch.setattr(components, "written", written)
    conf = {"spark.sql.shuffle.partitions": "48", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    held = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield made
    for k, v in held.items():
        spark.conf.set(k, v)


def test_a_chain_of_links_makes_few_files(spark, files):
    links = spark.range(600).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = {row["node"]: row["label"] for row in components.connected(links).collect()}
    assert got == dict.fromkeys(range(601), 0)
    assert len(files) > 2
    assert max(n for _, n in files[1:]) <= spark.sparkContext.defaultParallelism


def test_lists_are_written_once_before_any_label(spark, files):
    lists = spark.createDataFrame([(t, 10 * t + k) for t in range(5) for k in range(3)], "token long, id long")
    got = components.link_lists(spark, lists, lambda met, _: met, lambda pairs: pairs)
    assert {row["node"]: row["label"] for row in got.collect()} \
        == {10 * t + k: 10 * t for t in range(5) for k in range(3)}
    names = [name for name, _ in files]
    assert names[:names.index("components")] == ["lists", "lists"]
