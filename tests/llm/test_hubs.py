"""Copies that are like their origin and not like each other meet the origin, not one another."""

from __future__ import annotations

import random

from cardsentry.llm import ngram_join

COPIES = 240


def _rows():
    draw = random.Random(5)
    words = [f"w{k}" for k in range(150)]
    rows = [(0, " ".join(words))]
    for copy in range(1, COPIES + 1):
        changed = list(words)
        for k in draw.sample(range(5, 145), 3):
            changed[k] = f"c{copy}x{k}"
        rows.append((copy, " ".join(changed)))
    return rows


def test_a_group_with_an_origin_needs_few_comparisons(spark, monkeypatch):
    tested, verified = [], ngram_join._verified

    def counted(pairs, sets, percent):
        tested.append(pairs.count())
        return verified(pairs, sets, percent)

    monkeypatch.setattr(ngram_join, "_verified", counted)
    rows = _rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.components(spark, docs).collect()}
    sets = {doc: set(ngram_join.shingles(text, 5).tolist()) for doc, text in rows}
    linked = {doc for doc, s in sets.items() if 100 * len(s & sets[0]) >= 80 * len(s | sets[0])}
    assert len(linked) > COPIES // 2
    assert {doc for doc, component in got.items() if component == 0} >= linked
    assert sum(tested) < 12 * COPIES
