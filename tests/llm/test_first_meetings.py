"""Dense families of sets: every link is found, and each pair is looked at about once."""

from __future__ import annotations

import random

import pytest

from cardsentry.llm import components as C, ngram_join as N
from tests.llm.corpus import components


def _family(rng, sets, common, own):
    """Sets around a common core, that miss some of it and have numbers of their own."""
    core = rng.sample(range(10 ** 6), common)
    return [set(rng.sample(core, common - rng.randrange(own))) | {rng.randrange(2 ** 40)
                                                               for _ in range(rng.randrange(own))}
            for _ in range(sets)]


@pytest.mark.parametrize("recent", [0, 2, 16])
def test_dense_families_against_brute_force(spark, monkeypatch, recent):
    monkeypatch.setattr(C, "ROUNDS", 1)
    monkeypatch.setattr(C, "LEADERS", 1)
    monkeypatch.setattr(C, "RECENT", recent)
    rng = random.Random(recent)
    found = _family(rng, 60, 50, 8) + _family(rng, 40, 20, 4) + _family(rng, 30, 200, 40)
    sets = dict(enumerate(found, 1))
    table = spark.createDataFrame(
        [(k, len(s), sorted(s), [len(s)] + [0] * 15) for k, s in sets.items()],
        "set_id long, size long, hashes array<long>, spread array<long>")
    got = {r["set_id"]: r["label"] for r in N.linked(spark, table, 80).collect()}
    links = [(a, b) for a in sets for b in sets if b < a
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    groups = components(sets, links)
    assert links and got == {k: groups[k] for p in links for k in p}


def test_pairs_in_full_meet_once(spark, monkeypatch):
    """Sets of 84 % common text never link, and share most of the lists they stand in."""
    monkeypatch.setattr(C, "ROUNDS", 0)
    seen = []
    lists = spark.createDataFrame([(t, k, t) for k in range(80) for t in range(10)],
                                  "token long, id long, place long")

    def narrow(met, full):
        return met

    def none_link(pairs):
        seen.append(pairs.count())
        return pairs.limit(0)

    original = C._first_meetings

    def counted(*args):
        met = original(*args)
        seen.append(met.filter("not arrays_overlap(recent, b_recent)").count())
        return met

    monkeypatch.setattr(C, "_first_meetings", counted)
    C.link_lists(spark, lists, narrow, none_link, order="place")
    assert seen == [80 * 79 // 2] * 2
