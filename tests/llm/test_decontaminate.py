"""Leaks against scoring every passage with every item."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest

from cardsentry.llm import decontaminate as D
from tests.llm.corpus import awkward, documents, sentence


def _brute(texts, items, threshold, least):
    """BM25 of all passages with all items, straight from the formula."""
    rows = [(i, *D.split_item(t)) for i, t in items if D.words(t)]
    df = Counter(w for r in rows for w in set(r[1] + r[2]))
    average = sum(len(r[1] + r[2]) for r in rows) / len(rows)
    step = max(len(r[1] + r[2]) for r in rows)
    found = set()
    for doc, text in texts:
        words = D.words(text)
        for at in range(0, len(words), step):
            passage = words[at:at + 2 * step]
            for item, question, answer in rows:
                counts = Counter(question + answer)
                norm = 1.2 * (0.25 + 0.75 * sum(counts.values()) / average)
                weight = {w: math.log(1 + (len(rows) - df[w] + 0.5) / (df[w] + 0.5)) * n * 2.2 / (n + norm)
                          for w, n in counts.items()}
                score = sum(weight[w] for w in set(passage) & set(weight)) / sum(weight.values())
                if score >= threshold and min(D.overlap(D.grams(question), passage),
                                              D.overlap(D.grams(answer), passage)) >= least:
                    found.add((doc, item))
    return found


def _case(seed):
    rng = random.Random(seed)
    items = [(k, f"{sentence(rng, rng.randint(6, 40), 300)}. {sentence(rng, rng.randint(1, 9), 300)}.")
             for k in range(60)] + [(900, None), (901, ""), (902, "single words here only"), (3, "again. yes")]
    texts = awkward(rng)
    for k in range(80):
        words = sentence(rng, rng.randint(1, 300), 300).split()
        for _ in range(rng.randint(0, 2)):
            copied = rng.choice(items[:60])[1].split()
            for _ in range(rng.randint(0, len(copied) // 4)):
                copied[rng.randrange(len(copied))] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = copied
        texts.append((100 + k, " ".join(words)))
    return items, texts


@pytest.mark.parametrize("seed,chunk", [(1, 1000), (2, 20)])
def test_leaks_equal_all_pairs(spark, monkeypatch, seed, chunk):
    monkeypatch.setattr(D, "CHUNK", chunk)
    items, texts = _case(seed)
    table = spark.createDataFrame(items, "item_id long, text string")
    got = D.leaks(spark, documents(spark, texts), table).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == _brute(texts, items, 0.6, 0.5)
    assert len({r["doc_id"] for r in got}) > 10
    kept = D.clean(spark, documents(spark, texts), table)
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in texts} - {r["doc_id"] for r in got}
    assert kept.columns == documents(spark, texts).columns


def test_questions_and_answers_of_their_own(spark):
    items = spark.createDataFrame([(1, "what is the colour of the sky", "it is blue", "x")],
                                  "item_id long, question string, answer string, text string")
    docs = documents(spark, [(1, "so: what is the colour of the sky? it is blue."),
                             (2, "what is the colour of the sky, nobody knows")])
    assert [r["doc_id"] for r in D.leaks(spark, docs, items).collect()] == [1]


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "some item text. yes it is")], "item_id long, text string")
    assert D.leaks(spark, documents(spark, []), items).count() == 0
    assert D.leaks(spark, documents(spark, [(1, "a b c")]), items.limit(0)).count() == 0
