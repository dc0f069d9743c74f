"""Token ids and pieces wait on the executors' disks: no task makes a file that is not a result."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
from pyspark.sql import DataFrameWriter

from cardsentry.llm import packing, token_ids
from cardsentry.session import new_folder
from tests.llm.corpus import awkward, documents

BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture
def paths(monkeypatch):
    made, plain = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet",
                        lambda self, path, *a, **b: (made.append(path), plain(self, path, *a, **b))[1])
    return made


def test_token_files_are_all_that_is_written(spark, paths):
    folder = new_folder(spark, "ids")
    before = set(spark.sparkContext._jsc.getPersistentRDDs())
    token_ids.write_ids(spark, documents(spark, awkward(random.Random(4))), folder, vocabulary=BPE, end_id=2)
    assert sorted(paths) == [f"{folder}/blocks", f"{folder}/ranks"]
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= before

def test_pieces_are_packed_without_files(spark, paths):
    rows = awkward(random.Random(5))
    packed = packing.pack(spark, documents(spark, rows), vocabulary=BPE, end_id=0)
    assert {row["doc_id"] for row in packed.collect()} == {doc for doc, _ in rows}
    assert paths == []
