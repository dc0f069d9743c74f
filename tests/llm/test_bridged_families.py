"""Two families of near copies whose only link is one pair, met in lists of both families."""

from __future__ import annotations

from cardsentry.llm import ngram_join as N
from tests.llm.corpus import components


def _families():
    """Sets of 50 numbers; x and y share 45 of them, no other two sets of the families link."""
    first, second, third, *tail = range(1, 46)  # in this order among numbers as rare as they are
    own_x, own_y = list(range(100, 105)), list(range(200, 205))
    x, y = {first, second, third, *tail, *own_x}, {first, second, third, *tail, *own_y}
    sets = {100: x, 101: y}
    for k in range(10):
        sets[1 + k] = x - {second} | {1000 + k}
        sets[11 + k] = y - {first, third} | {2000 + k, 3000 + k}
    for k in range(3):  # x's own numbers are more frequent than what it shares with y
        sets[200 + k] = {*own_x, *range(4000 + 100 * k, 4045 + 100 * k)}
    return sets


def test_a_pair_met_from_both_sides_links(spark):
    sets = _families()
    links = [(a, b) for a in sets for b in sets if b < a
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert [p for p in links if len({k in (101, *range(11, 21)) for k in p}) > 1] == [(101, 100)]
    table = spark.createDataFrame(
        [(k, len(s), sorted(s), [len(s)] + [0] * 15) for k, s in sets.items()],
        "set_id long, size long, hashes array<long>, spread array<long>")
    got = {r["set_id"]: r["label"] for r in N.linked(spark, table, 80).collect()}
    groups = components(sets, links)
    assert got == {k: groups[k] for p in links for k in p}
