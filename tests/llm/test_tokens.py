"""Token ids, their file format, and packing: round trips against the tokenizer itself."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from cardsentry.llm import packing, token_ids
from cardsentry.llm.tokens import unit_ids
from cardsentry.session import new_folder
from tests.llm.corpus import awkward, documents, sentence

BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(BPE)
    made.encode_special_tokens = True
    return made


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aZé ñ,.'\n\t  s1½<|>日​\x1c\U0001f600")), max_size=60))
def test_units_give_the_ids_of_the_whole_text(text):
    whole = Tokenizer.from_file(BPE) if not hasattr(test_units_give_the_ids_of_the_whole_text, "t") \
        else test_units_give_the_ids_of_the_whole_text.t
    whole.encode_special_tokens = True
    test_units_give_the_ids_of_the_whole_text.t = whole
    assert unit_ids(BPE).ids(text).tolist() == whole.encode(text, add_special_tokens=False).ids


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2 ** 32 - 1)), max_size=70))
def test_codes_come_back(values):
    control, data = token_ids.encode(np.array(values, np.uint32))
    assert token_ids.decode(control, data, len(values)).tolist() == values
    assert len(control) == -(-len(values) // 4)


def test_written_ids_come_back_in_order(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(token_ids, "BLOCK_IDS", 1000)
    rows = awkward(random.Random(1))
    folder = new_folder(spark, "ids")
    token_ids.write_ids(spark, documents(spark, rows).coalesce(1), folder, vocabulary=BPE, end_id=2)
    got = token_ids.read_documents(spark, folder, keep_ids=True).orderBy("start").collect()
    expected = [(d, tokenizer.encode(t or "", add_special_tokens=False).ids + [2])
                for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]
    assert [(r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in got] == expected
    start = 0
    for row, (_, ids) in zip(got, expected):
        assert (row["start"], row["n_tokens"]) == (start, len(ids))
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_an_empty_table_has_no_ids_and_no_pieces(spark):
    folder = new_folder(spark, "ids")
    token_ids.write_ids(spark, documents(spark, []), folder, vocabulary=BPE, end_id=2)
    assert token_ids.read_documents(spark, folder).count() == 0
    assert packing.pack(spark, documents(spark, []), vocabulary=BPE, end_id=0).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 256), min_size=1, max_size=120))
def test_windows_hold_every_piece_once(lengths):
    found = packing.windows(lengths, 1024)
    assert sorted(k for w in found for k in w) == list(range(len(lengths)))
    assert max(sum(lengths[k] for k in w) for w in found) <= 1024


def test_differencing_is_near_equal():
    assert sorted(s for s, _ in packing.difference([8, 7, 6, 5, 4], 2)) == [14, 16]
    sums = [s for s, _ in packing.difference([random.Random(3).randint(1, 256)] * 64, 8)]
    assert max(sums) == min(sums)


def test_packed_documents_come_back(spark, tokenizer):
    rng = random.Random(2)
    rows = awkward(rng) + [(100 + k, sentence(rng, rng.randint(1, 700))) for k in range(150)]
    packed = packing.pack(spark, documents(spark, rows), vocabulary=BPE, end_id=0, keep_ids=True)
    pieces = packed.collect()
    by_sequence: dict = {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    for group in by_sequence.values():
        at = 0
        for p in sorted(group, key=lambda p: p["offset"]):
            assert p["offset"] == at
            assert zlib.crc32(bytes(p["ids"])) == p["ids_crc32"] and len(p["ids"]) == 4 * p["length"]
            at += p["length"]
        assert at <= 1024
    total = sum(p["length"] for p in pieces)
    assert total == sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    assert total / (1024 * len(by_sequence)) > 0.97
    for doc in {d for d, _ in rows} - {5, 7, None}:
        parts = sorted((p["start"], bytes(p["ids"])) for p in pieces if p["doc_id"] == doc)
        text = next(t for d, t in rows if d == doc)
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        assert np.frombuffer(b"".join(x for _, x in parts), "<u4").tolist() == ids
    whole = packing.sequences(packed).collect()
    assert len(whole) == len(by_sequence)
    for row in whole:
        n = len(row["ids"]) // 4
        assert n == 1024 or (n == row["n_ids"] and n & (n - 1) == 0)
