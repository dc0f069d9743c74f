"""Merkle manifest against plain trees, and what an altered row, a lost node or a tie does."""

from __future__ import annotations

import hashlib
import random
import zlib

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cardsentry.llm import merkle
from tests.llm.corpus import awkward, documents, sentence


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(nodes: list[str]) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][k:k + 2])) for k in range(0, len(out[-1]), 2)])
    return out


def path(tree, at):
    return [(at >> k & 1, row[at >> k ^ 1] if at >> k ^ 1 < len(row) else "")
            for k, row in enumerate(tree[:-1])]


def plain(rows, altered):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of each (doc, source, lang, n, text)."""
    def leaf(doc, source, lang, n, text):
        return h("".join(map(field, (doc, source, lang, n, text))))

    by_lang: dict = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append(row)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[lang] = levels([leaf(*r) for r in by_lang[lang]])
    top = levels([trees[x][-1][0] for x in langs])
    out = []
    for place, lang in enumerate(langs):
        for at, row in enumerate(by_lang[lang]):
            steps = path(trees[lang], at) + path(top, place)
            now = leaf(row[0], row[1], lang, row[3] + 1, row[4]) if altered(row) else leaf(*row)
            for left, sibling in steps:
                now = h(sibling + now) if left else h(now + sibling)
            out.append((row[0], leaf(*row), trees[lang][-1][0], top[-1][0],
                        h("".join(s for _, s in steps)), now, now == top[-1][0]))
    return sorted(out, key=str)


def altered(row):
    return row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0


def found(spark, rows, extra=False):
    table = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    if extra:
        for name in ("hash", "idx", "tree", "n", "part", "presented", "leaf_part", "row", "all", "id"):
            table = table.withColumn(name, F.lit("x"))
    made = merkle.manifest(spark, table, changed={"n_chars": F.col("n_chars") + 1},
                           where=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0)
    got = made.verified().select("doc_id", "hash", "subroot", "root", "proof_sha256", "folded_root",
                                 "verified").collect()
    return made, sorted(map(tuple, got), key=str)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 61])
def test_proofs_are_those_of_the_plain_trees(spark, monkeypatch, size):
    monkeypatch.setattr(merkle, "HEIGHT", 2)
    monkeypatch.setattr(merkle, "LEAVES", 5)
    rng = random.Random(size)
    rows = [(k * 3, rng.choice(["a", None]), rng.choice(["en", "en", "en", "dé", None, ""]),
             rng.choice([None, k]), sentence(rng, 4)) for k in range(size)]
    made, got = found(spark, rows)
    assert got == plain(rows, altered)
    assert made.roots().first()["root"] == got[0][3]


def test_nulls_ties_repeated_rows_and_clashing_names(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEAVES", 3)
    rows = [(d, None if d == 5 else "s", "en" if d != 8 else None, len(t) if t else None, t)
            for d, t in awkward(random.Random(4))]
    rows += [(7, "s", "en", 1, "same")] * 20
    made, got = found(spark, rows, extra=True)
    assert got == plain(rows, altered)


def test_an_empty_table_has_no_root(spark):
    made, got = found(spark, [])
    assert got == [] and made.roots().count() == 0


def test_only_altered_rows_fail(spark):
    rows = [(k, "s", "en" if k % 3 else "fr", 5, "some text") for k in range(400)]
    _, got = found(spark, rows)
    assert {r[0] for r in got if not r[6]} == {r[0] for r in rows if altered(r)}


def test_a_partition_asks_only_for_what_it_cannot_derive():
    """Leaves 4 to 7 of eight share their subtree: one node and two roots are missing."""
    asked = merkle._missing(pd.DataFrame({
        "leaf_part": 0, "tree": 0, "n": 8, "n_trees": 1, "idx": [4, 5, 6, 7]}))
    assert sorted(map(tuple, asked[["tree", "level", "idx"]].to_numpy().tolist())) == [
        (-1, 0, 0), (0, 2, 0), (0, 3, 0)]
    rng = random.Random(1)
    for _ in range(50):
        n = rng.randint(1, 200)
        own = sorted(rng.sample(range(n), rng.randint(1, min(n, 9))))
        asked = merkle._missing(pd.DataFrame({
            "leaf_part": 0, "tree": 0, "n": n, "n_trees": 1, "idx": own}))
        nodes = {(r.level, r.idx) for r in asked[asked["tree"] == 0].itertuples()}
        nodes.discard((merkle.height(n), 0))
        need = {(k, p >> k ^ 1) for p in own for k in range(merkle.height(n))
                if p >> k ^ 1 < merkle.width(n, k)}
        above = {(k, p >> k) for p in own for k in range(merkle.height(n) + 1)}
        assert nodes == need - above


def test_documents_table_holds_the_given_columns(spark):
    assert documents(spark, [(1, "a")]).select(*merkle.COLUMNS).count() == 1
