"""Hashes of phrases on their way through a shuffle: whole, summed, and a few bytes each."""

from __future__ import annotations

import numpy as np

from cardsentry.llm import phrases


def test_packed_hashes_come_back_summed_and_small():
    draw = np.random.default_rng(3)
    drawn = draw.integers(0, 1 << 32, 200_000).astype(np.uint32)
    drawn[:3] = 0, (1 << 32) - 1, 1 << 31
    held = [(drawn, np.ones(len(drawn), np.int64)), (drawn[:1000], np.full(1000, 70_000))]
    rows = phrases._packed(held, 7).to_pylist()
    assert [r["part"] for r in rows] == list(range(7))
    hashes = [np.cumsum(phrases._unplaned(r["steps"]), dtype=np.uint32) for r in rows]
    assert all(int(h) * 7 >> 32 == r["part"] for r, x in zip(rows, hashes) for h in x[[0, -1]])
    counts = np.concatenate([phrases._unplaned(r["counts"]) for r in rows])
    known, at = np.unique(drawn, return_inverse=True)
    wanted = np.bincount(at) + np.bincount(at[:1000], np.full(1000, 70_000), len(known))
    assert np.array_equal(np.concatenate(hashes), known) and np.array_equal(counts, wanted)
    assert sum(len(r["steps"]) + len(r["counts"]) for r in rows) < 4 * len(known)
