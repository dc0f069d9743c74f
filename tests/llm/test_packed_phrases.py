"""Phrases on their way through a shuffle: added up, sorted, and a few bytes each."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa

from cardsentry.llm import phrases


def test_packed_phrases_come_back_summed_and_small():
    rng = random.Random(4)
    words = [f"wé{k:x}" for k in range(300)]
    texts = phrases._Texts(("n", "n_before"))
    wanted, before = Counter(), Counter()
    for lang in ("en", "en", "x\ny", "en", "x\ny"):
        said = sorted({" ".join(rng.choices(words, k=rng.randint(1, 3))) for _ in range(4000)})
        n = [rng.choice([1, 3, 70_000, 5 << 32]) for _ in said]
        part = np.array([len(p) % 3 for p in said])
        texts.add(lang, part, pa.array(said), [np.array(n), np.array(n) // 2])
        for phrase, count in zip(said, n):
            wanted[lang, phrase] += count
            before[lang, phrase] += count // 2
    batches = list(texts.packed())
    assert texts.size == 0 and list(texts.packed()) == []
    rows = pa.Table.from_batches(batches)
    assert sorted(zip(rows["lang"].to_pylist(), rows["part"].to_pylist())) == [
        (lang, part) for lang in ("en", "x\ny") for part in range(3)]
    assert rows.nbytes < sum(24 + len(p.encode()) for _, p in wanted) / 3
    back = phrases._Texts(("n", "n_before"))
    back.unpacked(rows)
    got = {(lang, r["phrase"]): (r["n"], r["n_before"], r["part"])
           for lang, table in back.summed() for r in table.to_pylist()}
    assert got == {key: (n, before[key], len(key[1]) % 3) for key, n in wanted.items()}


def test_no_phrase_gives_no_row():
    texts = phrases._Texts(("n",))
    texts.add("en", np.empty(0), pa.array([], pa.string()), [np.empty(0, np.int64)])
    assert sum(b.num_rows for b in texts.packed()) == 0


def test_indexes_are_kept_in_planes():
    symbols = np.array([0, 1, 70_000, 0, 2 ** 31 - 1], np.int64)
    assert phrases._unplaned(phrases._planes(symbols), "<i4").tolist() == symbols.tolist()
    drawn = np.random.default_rng(1).geometric(0.002, 100_000)
    plain = phrases.zstandard.ZstdCompressor().compress(drawn.astype("<u4").tobytes())
    assert len(phrases._planes(drawn)) < 0.95 * len(plain)
