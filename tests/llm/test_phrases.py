"""Phrases from the indexes of shards against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from cardsentry.llm import phrases as P
from tests.llm.corpus import awkward, documents

LOWER = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})


def pieces(text):
    for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
        yield [w for w in re.split("[ \t]", piece) if w]


def plain(rows, least, share, top):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            for size in (1, 2, 3):
                for k in range(len(w) - size + 1):
                    key = lang, tuple(w[k:k + size])
                    f[key] += 1
    long = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    inside = Counter()
    for (lang, w), a in long.items():
        if len(w) == 3:
            for part in (w[:2], w[1:]):
                inside[lang, part] = max(inside[lang, part], a)
    out: dict = {}
    for (lang, w), a in long.items():
        if 100 * inside[lang, w] >= share * a and inside[lang, w]:
            continue
        cuts = [(1_000_000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((
            -score, -a, " ".join(w).encode(), lang, a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score))
    return sorted((lang, rank, x[2].decode(), *x[4:]) for lang, found in out.items()
                  for rank, x in enumerate(sorted(found)[:top], 1))


def mined(spark, table, **how):
    return sorted(map(tuple, P.collocations(spark, P.build(spark, table), **how).collect()))


@pytest.mark.parametrize("seed,shard_bytes,bits", [(0, 1 << 20, 26), (1, 300, 26), (2, 300, 17)])
def test_collocations_are_those_of_plain_counting(spark, monkeypatch, seed, shard_bytes, bits):
    monkeypatch.setattr(P, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(P, "FILTER_BITS", bits)
    rng = random.Random(seed)
    words = ["a", "A", "b", "c", "dé", "É", "new york", "x\ty", "b,", "c.", "x;y", "d!\n", "?", "..."]
    rows = [(k, " ".join(rng.choices(words, range(14, 0, -1), k=rng.randint(0, 30))),
             rng.choice(["en", "en", None, "und", "fr"])) for k in range(120)]
    rows += [(d, t, "en") for d, t in awkward(rng)]
    for how in ({"least": 3, "share": 50, "top": 40}, {"least": 1, "share": 101, "top": 10_000}):
        assert mined(spark, documents(spark, rows), **how) == plain(rows, **how)


def test_large_counts_are_exact(spark):
    """Products beyond 64 bits: counts as they may come from very many shards."""
    known = spark.createDataFrame(
        [("en", "a", 1, 9 * 10 ** 12), ("en", "b", 1, 7 * 10 ** 12 + 1), ("en", "a b", 2, 6 * 10 ** 12 - 7)],
        "lang string, phrase string, size int, n long")
    index = spark.createDataFrame([("en", 5, b"", b"", b"")], P._INDEX_DDL)
    held = P.counts
    P.counts = lambda *a, **k: known
    try:
        row = P.collocations(spark, index, least=10, share=50, top=5).first()
    finally:
        P.counts = held
    a, left, right = 6 * 10 ** 12 - 7, 9 * 10 ** 12, 7 * 10 ** 12 + 1
    assert row["score"] == 1_000_000 * a * a // (left * right)


def test_an_empty_table_has_no_phrase(spark):
    assert mined(spark, documents(spark, []), least=1, share=50, top=10) == []
    assert mined(spark, documents(spark, [(1, None), (2, "")]), least=1, share=50, top=10) == []


def test_intervals_stand_for_the_phrases_in_both_indexes(monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(rng.choices("abcd", k=rng.randint(1, 9))).encode() for _ in range(60)]
    opened = P.Shard(P.shard("en", texts))
    said = opened.words.to_pylist()
    for sort in (P._sorted_by, lambda major, minor: np.lexsort((minor, major))):
        monkeypatch.setattr(P, "_sorted_by", sort)
        assert P.shard("en", texts) == P.shard("en", texts)
    three = opened.extended(opened.extended(opened.single()))
    joined = [f" {t.decode()} " for t in texts]
    for k in range(len(three.size)):
        phrase = [said[w[k] - 1] for w in three.words]
        expected = sum(len(re.findall(f"(?= {' '.join(phrase)} )", t)) for t in joined)
        assert three.size[k] == expected
        # the words before the forward interval are those that precede the phrase in the texts
        at = slice(three.forward[k], three.forward[k] + three.size[k])
        before = Counter(said[s - 1] for s in opened.forward[at] if s)
        plain_before = Counter(m for t in joined for m in re.findall(
            f"(?<= )(\\w)(?= {' '.join(phrase)} )", t))
        assert before == plain_before


def test_words_before_and_behind(spark):
    table = documents(spark, [(1, "a b c. a b", "x\ny"), (2, "b c, c b a b c d", "x\ny"), (3, "a b", None)])
    got = {(r["lang"], r["phrase"]): (r["n"], r["n_before"], r["n_behind"])
           for r in P.counts(spark, P.build(spark, table), least=1, edges=True).collect()}
    assert got["x\ny", "a b"] == (3, 1, 2) and got["x\ny", "b c"] == (3, 2, 1)
    assert got["x\ny", "b"] == (5, 4, 4) and got["und", "a b"] == (1, 0, 0)
    assert got["x\ny", "a b c"] == (2, 1, 1) and ("x\ny", "c a") not in got
