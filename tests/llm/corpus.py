"""Small inputs with every awkward case, and plain-Python versions of what operators do."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns whose names clash with those that operators use inside.
CLASHING = ("row", "ids", "key", "label", "line", "token", "set_id", "other", "score", "bucket")


def documents(spark, rows, clashing=True):
    """(doc_id, text[, lang]) rows as a table, with extra columns of clashing names."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1]) if r[1] else 0) for r in rows]
    table = spark.createDataFrame(full, DOCS)
    for name in CLASHING if clashing else ():
        table = table.selectExpr("*", f"'x' AS {name}")
    return table


def sentence(rng: random.Random, n: int, vocabulary: int = 2000) -> str:
    return " ".join(f"w{rng.randrange(vocabulary):x}" for _ in range(n))


def awkward(rng: random.Random) -> list[tuple]:
    """Null and empty texts, blanks, one very long text, repeated rows, a repeated and a null id."""
    long = sentence(rng, 30_000)
    twin = sentence(rng, 40)
    return [(1, None), (2, ""), (3, " \n\t "), (4, long), (5, twin), (5, twin), (6, twin),
            (7, twin + " more"), (7, sentence(rng, 20)), (None, twin), (None, None), (8, "a"),
            (9, "日本語 テスト 😀 é"), (10, "x" * 5000)]


def components(nodes, links):
    """Smallest reachable node of each node; None is the smallest of all."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        parent[find(a)] = find(b)
    groups: dict = {}
    for n in nodes:
        groups.setdefault(find(n), []).append(n)
    return {n: min(groups[find(n)]) for n in nodes}
