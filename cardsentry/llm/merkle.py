"""Merkle manifest of a table of documents, with proofs shared by an octopus multiproof.

Every row is a leaf, the sha-256 of its columns. The leaves of a language, by ascending doc_id,
make one binary tree; the roots of the languages, in order, make the tree above them. A node is
the sha-256 of the hexadecimal digests of its two children, or of its one child at the end of an
odd level.

A tree grows in aligned blocks of ``2 ** HEIGHT`` nodes, each block in one task, so a table of n
rows takes about log(n) / HEIGHT rounds, each over a small share of the rows of the one before.
To prove leaves, a partition of at most ``LEAVES`` of them works out the least set of coordinates
(tree, level, index) that it cannot derive itself: a sibling counts only where it is neither one
of the partition's leaves nor above one. These nodes are fetched by one join, the interiors that
proofs have in common are derived once, and the proof of each leaf is expanded on the spot.

Order: null languages and null doc_ids first, languages by their UTF-8 bytes, rows of one doc_id
by their leaf. Null columns count as such; a null text is not an empty one. A language of one row
has its leaf as root; an empty table has no tree and gives no row. Only the named columns and the
keys are read; other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardsentry.session import new_folder, written

HEIGHT = 10
LEAVES = 4096
TOP = -1  # the tree whose leaves are the roots of the others
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_NODE = "tree long, level int, idx long, hash string"


def leaf(columns: Mapping[str, Column]) -> Column:
    """The digest of one row: each column as its length in bytes and itself, or a dash."""
    parts = []
    for column in columns.values():
        value = column.cast("string")
        parts.append(F.coalesce(
            F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def above(left: str, right: str = "") -> str:
    return hashlib.sha256((left + right).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    return max(0, int(n) - 1).bit_length()


def width(n: int, level: int) -> int:
    """Nodes of a level of a tree of n leaves."""
    return -(-int(n) >> level) if level else int(n)


def _placed(spark: SparkSession, rows: DataFrame, by: str, order: list[str]) -> DataFrame:
    """Rows with ``idx``, their place among those of the same ``by``, ``n``, how many these are,
    and ``part``, ``at``: the range of all rows they stand in and their place there.

    Rows move to ranges of the whole order, so a value that most rows share is split. ``row``
    tells equal rows apart.
    """
    held = written(rows.withColumn("row", F.monotonically_increasing_id()), new_folder(spark, "leaves"))
    keys = [by, *order, "row"]
    ordered = written(held.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        *rows.columns, F.monotonically_increasing_id().alias("id")), new_folder(spark, "leaves"))
    part = F.shiftright("id", 33)
    runs = ordered.groupBy(part.alias("p"), F.col(by).alias("b")).agg(
        F.min("id").alias("first"), F.count("*").alias("k"))
    whole = Window.partitionBy("b")  # a row for each range that the value reaches
    runs = runs.select("p", "b", "first", F.sum("k").over(whole).alias("n"), (
        F.sum("k").over(whole.orderBy("p").rowsBetween(Window.unboundedPreceding, 0))
        - F.col("k")).alias("base"))
    joined = ordered.join(runs, (part == F.col("p")) & F.col(by).eqNullSafe(F.col("b")))
    return joined.select(*rows.columns, "n", (F.col("id") - F.col("first") + F.col("base")).alias("idx"),
                         F.col("p").alias("part"), (F.col("id") - F.shiftleft("p", 33)).alias("at"))


def _block(level: int):
    """Interior nodes above an aligned block of nodes of one level."""
    def run(nodes: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("idx")
        tree, n = int(nodes["tree"].iloc[0]), int(nodes["n"].iloc[0])
        first, hashes, out = int(nodes["idx"].iloc[0]), nodes["hash"].tolist(), []
        for at in range(level, min(level + HEIGHT, height(n))):
            hashes = [above(*hashes[k:k + 2]) for k in range(0, len(hashes), 2)]
            first >>= 1
            out += [(tree, at + 1, first + k, h, n) for k, h in enumerate(hashes)]
        return pd.DataFrame(out, columns=["tree", "level", "idx", "hash", "n"])
    return run


def _grown(spark: SparkSession, leaves: DataFrame) -> DataFrame:
    """All nodes (tree, level, idx, hash) above and with the leaves (tree, idx, hash, n)."""
    now = leaves.select("tree", F.lit(0).alias("level"), "idx", "hash", "n")
    found, level = now, 0
    tallest = height(now.agg(F.max("n")).first()[0] or 0)
    while level < tallest:
        block = F.shiftright("idx", HEIGHT).alias("block")
        higher = written(now.groupBy("tree", block).applyInPandas(_block(level), _NODE + ", n long"),
                         new_folder(spark, "nodes"))
        level += HEIGHT
        found = found.unionByName(higher)
        now = higher.filter(F.col("level") == level)
    return found.select("tree", "level", "idx", "hash")


def _missing(leaves: pd.DataFrame) -> pd.DataFrame:
    """The coordinates that a partition of leaves cannot derive, and the roots it is held against."""
    part, n_trees = int(leaves["leaf_part"].iloc[0]), int(leaves["n_trees"].iloc[0])
    wanted = []

    def climb(tree: int, n: int, known: set[int]) -> None:
        for level in range(height(n)):
            count = width(n, level)
            wanted.extend((part, tree, level, k ^ 1) for k in known
                          if k ^ 1 not in known and k ^ 1 < count)
            known = {k >> 1 for k in known}
        wanted.append((part, tree, height(n), 0))

    for (tree, n), group in leaves.groupby(["tree", "n"]):
        climb(int(tree), int(n), set(group["idx"].tolist()))
    climb(TOP, n_trees, set(leaves["tree"].tolist()))
    return pd.DataFrame(wanted, columns=["leaf_part", "tree", "level", "idx"])


def _derived(n: int, known: dict[int, str], fetched: dict) -> list[dict[int, str]]:
    """Per level, all nodes that are known: fetched ones and those above what is known below."""
    levels = []
    for level in range(height(n)):
        here = known | fetched.get(level, {})
        levels.append(here)
        count = width(n, level)
        known = {k: above(here[2 * k], here[2 * k + 1] if 2 * k + 1 < count else "")
                 for k in {k >> 1 for k in known}}
    levels.append(known)
    return levels


def _path(levels: list[dict[int, str]], idx: int) -> list[tuple[int, str]]:
    """(whether the sibling stands on the left, the sibling or nothing) up to the root."""
    return [(idx >> at & 1, levels[at].get(idx >> at ^ 1, "")) for at in range(len(levels) - 1)]


def _fold(start: str, path: list[tuple[int, str]]) -> str:
    for on_left, sibling in path:
        start = above(sibling, start) if on_left else above(start, sibling)
    return start


def _expand(leaves: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
    """Proof and verdict of each leaf of a partition, from its leaves and the nodes it fetched."""
    fetched: dict[int, dict[int, dict[int, str]]] = {}
    for tree, level, idx, digest in zip(
            nodes["node_tree"], nodes["level"], nodes["node_idx"], nodes["digest"]):
        fetched.setdefault(tree, {}).setdefault(level, {})[idx] = digest
    n_trees, trees, tops = int(leaves["n_trees"].iloc[0]), {}, {}
    for (tree, n), group in leaves.groupby(["tree", "n"]):
        trees[tree] = _derived(n, dict(zip(group["idx"], group["hash"])), fetched.get(tree, {}))
        tops[tree] = trees[tree][-1][0]
    top = _derived(n_trees, tops, fetched[TOP])
    root = fetched[TOP][height(n_trees)][0]
    out = []
    for tree, idx, original, presented in zip(
            leaves["tree"], leaves["idx"], leaves["hash"], leaves["presented"]):
        path = _path(trees[tree], idx) + _path(top, tree)
        # A leaf that is what it was folds to what the partition has derived already.
        folded = top[-1][0] if presented == original else _fold(presented, path)
        out.append((fetched[tree][len(trees[tree]) - 1][0], root,
                    above("".join([sibling for _, sibling in path])), folded, folded == root))
    made = pd.DataFrame(out, columns=["subroot", "root", "proof_sha256", "folded_root", "verified"])
    return pd.concat([leaves[["doc_id", "lang", "hash", "idx"]].reset_index(drop=True), made], axis=1)


class Manifest:
    """The leaves and the nodes of a table, as written tables."""

    def __init__(self, leaves: DataFrame, nodes: DataFrame):
        self.leaves, self.nodes = leaves, nodes

    def roots(self) -> DataFrame:
        """The root of everything; no row for an empty table."""
        return self.nodes.filter(F.col("tree") == TOP).agg(
            F.max_by("hash", "level").alias("root")).filter("root is not null")

    def verified(self) -> DataFrame:
        """One row per leaf: its proof, and whether the presented row folds to the root."""
        asked = self.leaves.select("leaf_part", "tree", "n", "n_trees", "idx")
        missing = asked.groupBy("leaf_part").applyInPandas(
            _missing, "leaf_part long, tree long, level int, idx long")
        fetched = missing.join(self.nodes, ["tree", "level", "idx"]).select(
            F.col("leaf_part").alias("asked_by"), F.col("tree").alias("node_tree"), "level",
            F.col("idx").alias("node_idx"), F.col("hash").alias("digest"))
        return self.leaves.groupBy("leaf_part").cogroup(fetched.groupBy("asked_by")).applyInPandas(
            _expand, "doc_id long, lang string, hash string, idx long, subroot string, root string, "
                     "proof_sha256 string, folded_root string, verified boolean")


def manifest(spark: SparkSession, docs: DataFrame, *, changed: Mapping[str, Column] | None = None,
             where: Column | None = None) -> Manifest:
    """Manifest of all documents. Rows that meet ``where`` are later presented with the columns of
    ``changed`` in the place of their own."""
    columns = {name: F.col(name) for name in COLUMNS}
    presented = leaf(columns) if where is None else F.when(where, leaf(columns | dict(changed or {})))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("lang").cast("string").alias("lang"), leaf(columns).alias("hash"),
                       presented.alias("presented"))
    placed = _placed(spark, rows, "lang", ["doc_id", "hash"])
    names = placed.groupBy("lang").agg(F.max("n").alias("n_lang")).withColumn("all", F.lit(0))
    numbered = _placed(spark, names, "all", ["lang"]).select(
        F.col("lang").alias("name"), F.col("idx").alias("tree"), F.col("n").alias("n_trees"))
    leaves = written(
        placed.join(numbered, F.col("lang").eqNullSafe(F.col("name"))).select(
            "doc_id", "lang", "hash", F.coalesce("presented", "hash").alias("presented"), "tree", "idx",
            "n", "n_trees", (F.shiftleft("part", 33) + F.floor(F.col("at") / LEAVES)).alias("leaf_part")),
        new_folder(spark, "leaves"))
    trees = _grown(spark, leaves)
    heights = leaves.select("tree", "n", "n_trees").distinct().select(
        "tree", "n_trees", F.when(F.col("n") < 2, 0).otherwise(
            F.length(F.bin(F.col("n") - 1))).cast("int").alias("level"))
    subroots = written(trees.join(heights, ["tree", "level"]).select(
        F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), "hash",
        F.col("n_trees").alias("n")), new_folder(spark, "nodes"))
    return Manifest(leaves, trees.unionByName(_grown(spark, subroots)))
