"""The pipeline's near duplicates where ids and rows repeat, and its filters on awkward rows."""

from __future__ import annotations

import random

import corpus_pipeline as P
from tests.llm.corpus import awkward, documents, sentence


def _rows(table):
    return sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "") for r in table.collect()))


def test_unique_texts_stay_and_groups_keep_one(spark):
    rng = random.Random(4)
    a, b, c = (sentence(rng, 60) for _ in range(3))
    rows = [(1, a), (7, a), (7, b), (9, c), (9, c), (None, a + " more"), (4, None), (4, None), (5, "")]
    kept = P.drop_near_duplicates(spark, documents(spark, rows), "")
    assert kept.columns == list(P.COLUMNS)
    assert _rows(kept) == sorted([(False, 0, a + " more"), (True, 7, b), (True, 9, c), (True, 4, ""),
                                  (True, 4, ""), (True, 5, "")])


def test_awkward_rows_and_an_empty_table(spark):
    rows = awkward(random.Random(5))
    kept = P.drop_near_duplicates(spark, documents(spark, rows), "")
    texts = [t for _, _, t in _rows(kept)]
    assert {t for _, t in rows if t and not t.strip()} <= set(texts)
    assert len([t for t in texts if t.split()]) == len(set(t for t in texts if t.split()))
    assert P.drop_near_duplicates(spark, documents(spark, []), "").count() == 0
