"""Work that token files save: counting by array, blocks read where they lie, lines told apart by their ends."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cardsentry.llm import token_ids, tokens
from cardsentry.session import new_folder
from tests.llm.corpus import awkward, documents

BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("kind", [pa.binary(), pa.large_binary()])
def test_ids_of_an_array_are_joined(kind):
    lists = [[3, 1], [], [2], [65535, 0, 7]]
    column = pa.array([np.array(x, "<u2").tobytes() for x in lists], kind)
    for lo in range(5):
        for hi in range(lo, 5):
            got = token_ids._joined(column.slice(lo, hi - lo), np.dtype("<u2"))
            assert got.tolist() == [x for one in lists[lo:hi] for x in one]


def test_ids_are_counted_over_all_documents(spark, monkeypatch):
    monkeypatch.setattr(token_ids, "BLOCK_IDS", 7)
    rows = awkward(random.Random(6))
    size = tokens.unit_ids(BPE).tokenizer.get_vocab_size()
    whole = Tokenizer.from_file(BPE)
    wanted = Counter(2 for _ in rows)
    for _, text in rows:
        wanted.update(whole.encode(text or "", add_special_tokens=False).ids)
    got = token_ids.count_ids(token_ids.tokenize(documents(spark, rows), BPE, 2), size)
    assert {k: int(got[k]) for k in np.flatnonzero(got)} == dict(wanted)


def test_blocks_are_not_shuffled_to_be_read(spark):
    folder = new_folder(spark, "ids")
    token_ids.write_ids(spark, documents(spark, awkward(random.Random(1))), folder, vocabulary=BPE, end_id=2)
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = token_ids.read_documents(spark, folder)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_lines_are_cut_where_no_white_space_is_beside_them():
    odd = re.compile(r"\n(?!\S)|(?<!\S)\n").search
    rng = random.Random(8)
    for _ in range(5000):
        text = "".join(rng.choices("ab \n\t\x1c\x85\xa0é", k=rng.randint(0, 9)))
        assert tokens._lines(text) == ([text] if odd(text) else text.split("\n"))


def test_words_of_all_letters_and_lengths_have_the_ids_of_the_tokenizer():
    whole = Tokenizer.from_file(BPE)
    units = tokens.unit_ids(BPE)
    for unit in ("Straße", "ça", "été", "x" * 700, "é" * 300, "qzj" * 90, "a\nb"):
        assert np.frombuffer(units.bare.word(unit), units.dtype).tolist() \
            == [t.id for t in whole.model.tokenize("".join(tokens._byte_letters()[b] for b in unit.encode()))]
        text = f"so {unit} so"
        assert units.ids(text).tolist() == whole.encode(text, add_special_tokens=False).ids
