"""Line dedup, n-gram join and components against comparing everything with everything."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from hypothesis import given, settings, strategies as st

from cardsentry.llm import components as C, line_dedup as L, ngram_join as N, spotsigs
from tests.llm.corpus import awkward, components, documents, sentence


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=500, deadline=None)
@given(st.text("ab", max_size=12), st.text("ab", max_size=12), st.integers(1, 3))
def test_banded_distance_and_shared_keys(a, b, edits):
    near = _distance(a, b) <= edits
    assert L.within(a, b, edits) == near
    if near and min(len(a), len(b)) > edits:
        assert set(L.keys(a, edits)) & set(L.keys(b, edits))


def _edited(rng, text, n):
    for _ in range(n):
        k = rng.randrange(len(text) + 1)
        text = rng.choice([text[:k] + "q" + text[k:], text[:max(0, k - 1)] + text[k:],
                           text[:max(0, k - 1)] + "z" + text[k:]])
    return text


def _line_case(seed):
    rng = random.Random(seed)
    base = [sentence(rng, rng.randint(5, 30)) for _ in range(30)]
    rows = awkward(rng)
    for k in range(100):
        lines = [_edited(rng, rng.choice(base), rng.choice([0, 0, 1, 2, 3])) if rng.random() < 0.5
                 else sentence(rng, rng.randint(1, 12)) for _ in range(rng.randint(0, 8))]
        rows.append((100 + k, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_equal_all_pairs(spark, seed):
    rows = _line_case(seed)
    places = defaultdict(list)
    for doc, text in rows:
        for number, line in L.lines_of(text, 5):
            places[line].append((doc is not None, doc or 0, number))
    lines = list(places)
    links = [(x, y) for k, x in enumerate(lines) for y in lines[:k]
             if abs(len(x) - len(y)) <= 2 and L.within(x, y, 2)]
    classes = components(lines, links)
    first = defaultdict(list)
    for line in lines:
        first[classes[line]] += places[line]
    expected = {(p, n): min(first[classes[line]])[1:] for line in lines for *p, n in
                [(a, b, c) for a, b, c in places[line]] for p in [tuple(p)]}
    got = L.judged(spark, documents(spark, rows)).collect()
    for r in got:
        key = ((r["doc_id"] is not None, r["doc_id"] or 0), r["line_no"])
        assert expected[key] == (r["class_doc_id"] or 0, r["class_line_no"])
    assert len(got) == sum(map(len, places.values()))


def test_dedup_keeps_first_lines_and_other_columns(spark):
    line = "this line stands in many documents of the corpus"
    rows = [(1, f"{line}\nown one"), (2, f"{line}!\nshort"), (3, line), (4, None), (5, ""),
            (6, f" {line} \n\n{line}"), (None, f"x\n{line}"), (7, "own\ntext"), (7, "own\ntext")]
    table = documents(spark, rows)
    got = L.dedup(spark, table)
    assert got.columns == table.columns
    texts = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str)
    # the null id comes first in the order, so its line is the one that stays
    assert texts == sorted([(1, "own one"), (2, "short"), (4, None), (5, ""), (None, f"x\n{line}"),
                            (7, "own\ntext"), (7, "own\ntext")], key=str)
    assert L.dedup(spark, table.limit(0)).count() == 0


def _shingles(text, n=5):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[k:k + n]) for k in range(max(1, len(words) - n + 1)))


def _near_case(seed):
    rng = random.Random(seed)
    rows = awkward(rng)
    common = sentence(rng, 30)
    for k in range(60):
        base = sentence(rng, rng.randint(1, 120)) + (" " + common if k % 3 == 0 else "")
        rows.append((100 + 10 * k, base))
        for j in range(rng.randint(0, 4)):
            words = base.split()
            for _ in range(rng.randint(0, max(1, len(words) // 40))):
                words[rng.randrange(len(words))] = f"new{j}"
            rows.append((101 + 10 * k + j, " ".join(words)))
    hub = sentence(rng, 200).split()  # a group of near copies, each with an own change or two
    for k in range(80):
        words = list(hub)
        for _ in range(k % 5):
            words[rng.randrange(200)] = f"v{k}"
        rows.append((5000 + k, " ".join(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_near_duplicates_equal_all_pairs(spark, seed):
    rows = _near_case(seed)
    sets = [_shingles(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    groups = components(range(len(rows)), links)
    least: dict = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[groups[k]] = min(least.get(groups[k], doc), doc)
    expected = sorted((str(doc), len(s), str(least.get(groups[k]))) for k, ((doc, _), s) in
                      enumerate(zip(rows, sets)))
    got = N.components(spark, documents(spark, rows))
    assert sorted((str(r[0]), r[1], str(r[2])) for r in got.collect()) == expected
    assert N.components(spark, documents(spark, [])).count() == 0


def test_components_of_chains_and_hubs(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    got = {r["node"]: r["label"] for r in C.connected(
        spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 160)}}


def test_fingerprints_of_awkward_texts(spark):
    rows = awkward(random.Random(4)) + [(50, "the cat sat on the mat of the house with a dog")]
    got = spotsigs.fingerprints(documents(spark, rows)).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, (r[1] or "").encode()))
    expected = []
    for k, (doc, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        changed = spotsigs.edited(text, following)
        mine, other, after = map(spotsigs.signatures, (text, changed, following))
        expected.append((str(doc), len(text), spotsigs.pack(mine), spotsigs.pack(other),
                         spotsigs.likeness(mine, other), spotsigs.likeness(mine, after)))
    assert sorted((str(r["doc_id"]), r["n_chars"], r["fingerprint"], r["edited_fingerprint"],
                   r["near_edited"], r["near_next"]) for r in got) == sorted(expected)
    assert spotsigs.fingerprints(documents(spark, [])).count() == 0
    one = spotsigs.fingerprints(documents(spark, [(1, "the cat sat on a mat")])).first()
    assert one["near_next"] == 1.0


@given(st.sets(st.integers(0, 60)), st.sets(st.integers(0, 60)), st.floats(0, 1))
def test_pruned_likeness(a, b, threshold):
    import numpy as np
    x, y = (np.array(sorted(s), np.uint32) for s in (a, b))
    value = len(a & b) / len(a | b) if a | b else 1.0
    assert spotsigs.likeness(x, y, threshold) == (value if value >= threshold else 0.0)
    assert spotsigs.unpack(spotsigs.pack(x)).tolist() == sorted(a)


def test_near_fingerprints(spark):
    rng = random.Random(5)
    base = " ".join(f"the {sentence(rng, 4)}" for _ in range(80))
    rows = [(1, base), (2, base), (3, base + " the end of it all"), (4, " ".join(
        f"the {sentence(rng, 4)}" for _ in range(80))), (5, None), (6, "")]
    got = spotsigs.near(spark, spotsigs.fingerprints(documents(spark, rows)))
    assert {r["doc_id"]: r["class_id"] for r in got.collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 5}
