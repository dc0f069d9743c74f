"""Toxicity and language: the algorithms against plain versions, and held-out accuracy."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cardsentry.llm import language_id as I, toxicity as T
from tests.llm.corpus import awkward, documents, sentence

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _names():
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    names = [model.id_to_piece(k) for k in range(model.get_piece_size())]
    kept = [p for p in names if p.lstrip(I.MARK).isalpha() and p == p.lower()]
    return {p: k for k, p in enumerate(kept)}


def _all_ways(word, names, probability):
    """Sum over all segmentations, by recursion."""
    marked = I.MARK + word

    def ways(at):
        if at == len(marked):
            return 1.0
        total = 0.0
        for end in range(at + 1, len(marked) + 1):
            piece = names.get(marked[at:end])
            if piece is not None:
                total += probability[piece] * ways(end)
            elif end == at + 1:
                total += I.UNKNOWN * ways(end)
        return total
    return ways(0)


def test_forward_sums_all_segmentations():
    names = _names()
    probability = np.random.default_rng(1).random(len(names)) / 1000
    words = ["the", "eau", "straße", "x", "日本", "schön", "qzx", "año"]
    got = I.word_scores(words, PIECES, np.column_stack([probability] * 2))
    for row, word in zip(got, words):
        assert row == pytest.approx([np.log(_all_ways(word, names, probability))] * 2)


def test_fit_never_lowers_the_likelihood():
    words, counts = ["house", "houses", "mouse", "the"], np.array([9.0, 3, 2, 40])
    likelihoods = [(I.word_scores(words, PIECES, I.fit(words, counts, PIECES, k)[:, None])[:, 0]
                    * counts).sum() for k in (1, 2, 4, 8)]
    assert all(b >= a - 0.5 for a, b in zip(likelihoods, likelihoods[1:]))


def test_languages_of_awkward_texts(spark):
    rng = random.Random(1)
    english, french = "the of and house with that".split(), "le de et maison avec que".split()
    rows = [(100 + k, " ".join(rng.choices(words, k=12)), lang) for k in range(60)
            for words, lang in ((english, "en"), (french, "fr"))]
    odd = [(d, t, None) for d, t in awkward(rng)] + [(11, "12 34 ½ ²", None), (12, "THE HOUSE", "en")]
    docs = documents(spark, rows + odd)
    model = I.learn(docs, F.col("doc_id") % 2 == 0, vocabulary=PIECES)
    assert model.names == ["en", "fr"]
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in I.predict(docs, model).collect()]
    assert len(got) == len(rows) + len(odd)
    expected = {d: lang for d, _, lang in rows} | {12: "en", 11: "und", 1: "und", 2: "und", 3: "und"}
    for doc, lang, score in got:
        assert 0 <= score <= 1 and (doc not in expected or lang == expected[doc]
                                    or (doc >= 100 and lang in ("en", "fr")))
    assert sum(lang == expected.get(doc) for doc, lang, _ in got) >= 60
    none = I.learn(docs.limit(0), F.lit(True), vocabulary=PIECES)
    assert {r["lang_pred"] for r in I.predict(docs, none).collect()} == {"und"}
    assert I.predict(docs.limit(0), model).count() == 0


def test_training_keeps_the_clean_part_from_going_negative():
    rng = np.random.default_rng(2)
    rows = [np.array([0, 1]) if k < 60 else np.array([0, 1] if rng.random() < 0.1 else [2 + k % 3])
            for k in range(600)]
    positive = np.arange(600) < 60
    weights, bias = T.train(rows, positive, 5, 0.1)
    assert (weights >= 0).all() and weights[:2].min() > 0.3 and weights[2:].max() < 0.3
    assert bias + weights[:2].sum() > 0 > bias


def _toxic_corpus(n=900):
    rng = random.Random(3)
    docs, labels = awkward(rng), [(4, 0), (5, 0), (5, None), (None, 1), (99_999, 1)]
    for k in range(n):
        words = sentence(rng, rng.randint(3, 60)).split()
        bad = rng.random() < 0.15
        if bad:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randint(0, len(words)), rng.choice(["Badword", "uglyish", "uglyest"]))
        docs.append((1000 + k, " ".join(words)))
        if rng.random() < 0.7:
            labels.append((1000 + k, int(bad)))
    return docs, labels


def test_toxic_texts_are_found_out_of_fold(spark):
    rows, marked = _toxic_corpus()
    docs = documents(spark, rows)
    labels = spark.createDataFrame(marked, "doc_id long, toxic int")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    model = T.learn(spark, docs, labels, fold != 0)
    scored = T.score(docs, model)
    assert set(scored.columns) == set(docs.columns)  # its own score takes the place of another
    got = {r["doc_id"]: r["score"] for r in scored.collect()}
    assert scored.count() == len(rows) and all(0 <= s <= 1 for s in got.values())
    truth = {d: t for d, t in marked if d is not None and d >= 1000}
    held = [d for d in truth if d in got and zlib.crc32(str(d).encode()) % 5 == 0]
    right = sum((got[d] >= 0.5) == bool(truth[d]) for d in held)
    assert right / len(held) > 0.95
    assert got[1] == got[2] == got[3] < 0.5


def test_nothing_to_learn_from(spark):
    docs = documents(spark, [(1, "a b"), (2, None)])
    labels = spark.createDataFrame([(1, 0), (2, None)], "doc_id long, toxic int")
    assert T.learn(spark, docs, labels, F.lit(True)) is None
    assert T.learn(spark, docs, labels.limit(0), F.lit(True)) is None
    assert [r["score"] for r in T.score(docs, None).collect()] == [0.0, 0.0]
