"""Chunked encoding against the tokenizer itself, and the way back."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from cardsentry.llm import bpe_chunks as B, queries as Q
from tests.llm.corpus import awkward, documents, sentence

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(WORD_BPE)
LETTERS = list("aZé ñ,.'\n\t  s1½<|>日​\x1c\U0001f600́ 　İıſK\r\x0b\x85'S") + ["<|endoftext|>", "'re", "ǅ"]


@pytest.mark.parametrize("bits", [1, 3, 9])
def test_chunks_give_the_ids_of_the_whole_text(monkeypatch, bits):
    monkeypatch.setattr(B, "CHUNK_BITS", bits)
    table = B.Chunks(WORD_BPE, most=50)

    @settings(max_examples=400, deadline=None)
    @given(st.lists(st.sampled_from(LETTERS), max_size=80).map("".join))
    def holds(text):
        assert table.ids(text).tolist() == WHOLE.encode(text, add_special_tokens=False).ids

    holds()


def test_copies_are_cut_alike_and_encoded_once():
    rng = random.Random(1)
    passage = sentence(rng, 3000)
    table = B.Chunks(WORD_BPE)
    table.ids(sentence(rng, 50) + " " + passage)
    known = len(table)
    table.ids("other words " + passage + " and an end")
    assert len(table) - known <= 4  # only the chunks around the two ends are new
    assert len(B.cuts(passage)) > 10


def test_long_texts_are_hashed_in_blocks(monkeypatch):
    text = sentence(random.Random(2), 3000)
    whole = B.cuts(text).tolist()
    monkeypatch.setattr(B, "_BLOCK", 1000)
    assert B.cuts(text).tolist() == whole


def test_documents_come_back(spark):
    rng = random.Random(3)
    rows = awkward(rng) + [(50 + k, sentence(rng, rng.randint(1, 400))) for k in range(40)]
    rows += [(90, "x" * 20_000 + " <|startoftext|> é"), (91, "日本" * 3000)]
    encoded = B.encode(documents(spark, rows), vocabulary=WORD_BPE)
    got = B.decode(encoded, vocabulary=WORD_BPE).collect()
    dtype = B.chunks(WORD_BPE).units.dtype
    held = sorted((r["doc_id"] is not None, r["doc_id"] or 0, np.frombuffer(r["ids"], dtype).tolist())
                  for r in encoded.collect())
    ids = [WHOLE.encode(t or "", add_special_tokens=False).ids for _, t in rows]
    assert held == sorted((d is not None, d or 0, x) for (d, _), x in zip(rows, ids))
    expected = [(d, len(x), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest(),
                 WHOLE.decode(x, skip_special_tokens=False)) for (d, _), x in zip(rows, ids)]
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded"]) for r in got),
                  key=str) == sorted(expected, key=str)
    assert all(hashlib.sha256(r["decoded"].encode()).hexdigest() == r["decoded_sha256"] for r in got)


def test_an_empty_table_has_no_ids(spark):
    assert B.encode(documents(spark, []), vocabulary=WORD_BPE).count() == 0


def test_registered_query_is_the_library(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = Q.QUERIES["op13_bpe_chunks"](spark, sf).collect()
    assert len(got) == len(texts)
    for row in got:
        ids = WHOLE.encode(texts[row["doc_id"]] or "", add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        said = WHOLE.decode(ids, skip_special_tokens=False)
        assert row["decoded_sha256"] == hashlib.sha256(said.encode()).hexdigest()
