"""Documents joined where their sets of word n-grams are alike, by prefix filtering.

A document's set holds the 64-bit hashes of its distinct ``n``-word shingles (one hash of the
whole sequence if it has fewer words). Two sets link when 100 * intersection >= ``percent`` *
union. The search loses no link between different sets:

1. Shingles of one set alone can never be shared. They stand first in every rare-first order, so
   a document whose prefix (n - ceil(t n) + 1 rarest shingles) holds nothing else has no partner.
   Counting is done once over all shingles, as packed 32-bit marks that each task has combined.
2. Equal sets become one. The sets left are ordered rare-first, and each puts those shingles of
   its prefix that others share into an inverted list, with size and place.
3. Pairs that meet in a list pass a length filter, a positional filter at the first place where
   they meet, and a suffix filter (sizes of the parts of the sets between fixed pivots of the hash
   order bound what they can share), and are verified once, by the exact intersection.
4. A list whose sets are all connected is done. So lists link everything to a few leaders first
   (few pairs, even in a group of thousands), and only sets still apart are paired off, each pair
   where it meets first.

Texts are lower-cased from A to Z; words are runs without ASCII white space. Null and empty texts
have the empty set, which links with nothing. Rows may repeat a doc_id; nulls come first. An
empty table gives no row. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.llm.components import link_lists
from cardsentry.session import new_folder, written

_BLOCK = 1 << 20  # shingles that a task combines before it passes them on
_ROWS = 512
_PARTS = 16  # parts of the suffix filter
_K = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, n: int) -> np.ndarray:
    """The sorted hashes of a text's distinct word n-grams."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(n, len(words))
    mixed = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        mixed = (mixed ^ hashes[k:len(words) - size + 1 + k]) * _K
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def _set_id(hashes: np.ndarray) -> int:
    """One number for equal sets, as a signed 64-bit integer."""
    value = xxhash.xxh3_64_intdigest(hashes.tobytes())
    return value - (1 << 64) if value >> 63 else value


def _needed(n: np.ndarray, percent: int) -> np.ndarray:
    """The least number of shingles that a set of n must share with any partner."""
    return -(-percent * n // 100)


_META = "block long, part int, marks binary, counts binary, docs binary, sets binary, sizes binary"


def _spread(n: int, parts: int):
    """Packed marks of the shingles of a block of documents, one row per part of the hash space.

    A shingle that several documents of the block have is sent once, without an owner.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), 0
        docs, found, held = [], [], 0

        def flush() -> pa.RecordBatch:
            block = (task << 32) + made
            sizes = np.array([len(x) for x in found], np.int64)
            flat = np.concatenate(found)
            owner = np.repeat(np.arange(len(found)), sizes)
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            first = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]][:len(flat)])
            many = np.diff(np.r_[first, len(flat)]) > 1
            flat, owner = flat[first], np.where(many, len(found), owner[first])
            part = ((flat >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((owner, part))
            flat, owner, part = flat[order], owner[order], part[order]
            bounds = np.searchsorted(part, np.arange(parts + 1))
            rows = [{"block": block, "part": int(block % parts),
                     "docs": np.array([d if d is not None else 0 for d in docs], "<i8").tobytes(),
                     "sets": np.array([_set_id(x) for x in found], "<i8").tobytes(),
                     "sizes": np.array([-1 - s if d is None else s
                                        for d, s in zip(docs, sizes)], "<i8").tobytes()}]
            for p in range(parts):
                lo, hi = bounds[p], bounds[p + 1]
                if lo < hi:
                    counts = np.bincount(owner[lo:hi], minlength=len(found) + 1)
                    rows.append({"block": block, "part": p, "counts": counts.astype("<u2").tobytes()
                                 if counts.max() < 65536 else counts.astype("<u4").tobytes(),
                                 "marks": flat[lo:hi].astype("<u4").tobytes()})
            return pa.RecordBatch.from_pylist(rows, _ROW)

        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                rows = batch.slice(at, _ROWS)
                for doc, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                    docs.append(doc)
                    found.append(shingles(text, n))
                    held += len(found[-1]) + 1
                    if held >= _BLOCK:
                        yield flush()
                        made, docs, found, held = made + 1, [], [], 0
        if docs:
            yield flush()
    return run


_ROW = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("marks", pa.binary()),
                  ("counts", pa.binary()), ("docs", pa.binary()), ("sets", pa.binary()),
                  ("sizes", pa.binary())])


def _alone(rows: pd.DataFrame) -> pd.DataFrame:
    """How many shingles of this part each document of a block has to itself."""
    meta = rows[rows["docs"].notna()]
    rows = rows[rows["marks"].notna()].sort_values("block")
    out = [meta.assign(marks=None, counts=None)]
    if len(rows):
        marks = [np.frombuffer(x, "<u4") for x in rows["marks"]]
        flat = np.concatenate(marks)
        order = np.argsort(flat, kind="stable")
        ranked = flat[order]
        single = np.r_[True, ranked[1:] != ranked[:-1]] & np.r_[ranked[1:] != ranked[:-1], True]
        alone = np.empty(len(flat), bool)
        alone[order] = single
        ends = np.cumsum([len(x) for x in marks])
        found = []
        for raw, end, held in zip(rows["counts"], ends, marks):
            counts = np.frombuffer(raw, "<u2")
            if counts.sum(dtype=np.int64) != len(held):
                counts = np.frombuffer(raw, "<u4")
            owner = np.repeat(np.arange(len(counts)), counts)
            mine = np.bincount(owner[alone[end - len(held):end]], minlength=len(counts))[:-1]
            found.append(mine.astype("<u4").tobytes())
        out.append(rows.assign(counts=found, marks=None))
    return pd.concat(out)[["block", "part", "marks", "counts", "docs", "sets", "sizes"]]


def _alive(percent: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        meta = rows[rows["docs"].notna()].iloc[0]
        sizes = np.frombuffer(meta["sizes"], "<i8")
        no_id = sizes < 0
        sizes = np.where(no_id, -1 - sizes, sizes)
        alone = np.zeros(len(sizes), np.int64)
        for raw in rows.loc[rows["counts"].notna(), "counts"]:
            alone += np.frombuffer(raw, "<u4")
        docs = pd.array(np.frombuffer(meta["docs"], "<i8"), "Int64")
        docs[no_id] = pd.NA
        return pd.DataFrame({
            "doc_id": docs, "n_shingles": sizes,
            "set_id": np.frombuffer(meta["sets"], "<i8"),
            "alive": (sizes > 0) & (sizes - alone >= _needed(sizes, percent))})
    return run


def profile(docs: DataFrame, *, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, set_id of every row, and whether its prefix is shared with another."""
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spread = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("text").cast("string").alias("text")).mapInArrow(
        _spread(n, parts), _META)
    counted = spread.groupBy("part").applyInPandas(_alone, _META)
    return counted.groupBy("block").applyInPandas(
        _alive(percent), "doc_id long, n_shingles long, set_id long, alive boolean")


def shared_sets(docs: DataFrame, profiled: DataFrame, *, n: int = 5) -> DataFrame:
    """set_id, size, hashes of each different set that may have a partner."""
    chosen = (profiled.filter("alive").groupBy("set_id").agg(F.min("doc_id").alias("rep"))
              .select(F.col("set_id").alias("wanted"), "rep"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
    taken = texts.join(chosen, F.col("doc_id").eqNullSafe(F.col("rep"))).select("wanted", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                rows = batch.slice(at, _ROWS)
                found = [shingles(text, n) for text in rows.column(1).to_pylist()]
                kept = [x for x, w in zip(found, rows.column(0).to_pylist()) if _set_id(x) == w]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_set_id(x) for x in kept], pa.int64()),
                     pa.array([len(x) for x in kept], pa.int64()),
                     pa.array([x.view(np.int64) for x in kept], pa.list_(pa.int64())),
                     pa.array([np.bincount(x >> np.uint64(60), minlength=_PARTS) for x in kept],
                              pa.list_(pa.int64()))], ["set_id", "size", "hashes", "spread"])

    return taken.mapInArrow(
        run, "set_id long, size long, hashes array<long>, spread array<long>").dropDuplicates(
        ["set_id"])


def _unique(rows: pd.DataFrame, parts: int):
    """The sets of a block in order, and their different hashes by part of the hash space."""
    rows = rows.sort_values("set_id", ignore_index=True)
    flat = np.concatenate([np.asarray(x, np.int64).view(np.uint64) for x in rows["hashes"]])
    values, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
    part = ((values >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    bounds = np.searchsorted(part[order], np.arange(parts + 1))
    return rows, values, inverse, counts, order, bounds


def _frequencies(sets: DataFrame, parts: int) -> DataFrame:
    """For each block and part, in how many sets each of its hashes stands."""
    def spread(rows: pd.DataFrame) -> pd.DataFrame:
        _, values, _, counts, order, bounds = _unique(rows, parts)
        out = [(int(rows["block"].iloc[0]), p,
                (values[order[lo:hi]] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes(),
                counts[order[lo:hi]].astype("<u4").tobytes())
               for p, (lo, hi) in enumerate(zip(bounds, bounds[1:])) if lo < hi]
        return pd.DataFrame(out, columns=["block", "part", "marks", "counts"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        marks = [np.frombuffer(x, "<u4") for x in rows["marks"]]
        counts = np.concatenate([np.frombuffer(x, "<u4") for x in rows["counts"]])
        _, inverse = np.unique(np.concatenate(marks), return_inverse=True)
        total = np.bincount(inverse, counts).astype("<u4")[inverse]
        cuts = np.cumsum([len(x) for x in marks])[:-1]
        return pd.DataFrame({"block": rows["block"], "part": rows["part"],
                             "counts": [x.tobytes() for x in np.split(total, cuts)]})

    return (sets.groupBy("block").applyInPandas(
        spread, "block long, part int, marks binary, counts binary")
        .groupBy("part").applyInPandas(add, "block long, part int, counts binary"))


def prefixes(sets: DataFrame, percent: int, blocks: int) -> DataFrame:
    """token, set_id, size, place, common: the shared shingles in the rare-first prefix of each set.

    ``common`` grows with the number of sets that have the set's shingles: the text that the copies
    of a group were made from has the largest, a copy with many changes a small one.
    """
    parts = max(1, int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = sets.select("set_id", "hashes", F.pmod(
        F.xxhash64("set_id"), F.lit(blocks)).alias("block"))

    names = ("token", "set_id", "size", "place", "common")

    def order(rows: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame({c: [] for c in names})
        rows, values, inverse, _, order, bounds = _unique(rows, parts)
        total = np.empty(len(values), np.int64)
        for p, raw in zip(found["part"], found["counts"]):
            total[order[bounds[p]:bounds[p + 1]]] = np.frombuffer(raw, "<u4")
        columns = [[], [], [], [], []]
        end, weight = 0, np.rint(1024 * np.log2(total)).astype(np.int64)
        for set_id, hashes in zip(rows["set_id"], rows["hashes"]):
            end += len(hashes)
            mine = inverse[end - len(hashes):end]
            length = len(mine) - int(_needed(np.int64(len(mine)), percent)) + 1
            ranked = mine[np.lexsort((values[mine], total[mine]))][:length]
            place = np.flatnonzero(total[ranked] > 1)
            for column, value in zip(columns, (values[ranked[place]].view(np.int64),
                                               np.full(len(place), set_id),
                                               np.full(len(place), len(mine)), place,
                                               np.full(len(place), weight[mine].sum()))):
                column.append(value)
        return pd.DataFrame({c: np.concatenate(x) for c, x in zip(names, columns)})

    return (placed.groupBy("block").cogroup(_frequencies(placed, parts).groupBy("block"))
            .applyInPandas(order, "token long, set_id long, size long, place long, common long"))


def _may_link(percent: int, shared: Column) -> Column:
    """Length filter, and a bound on what the two sets of a pair can share."""
    small, large = F.least("size", "b_size"), F.greatest("size", "b_size")
    return (100 * small >= percent * large) & (
        (100 + percent) * shared >= percent * (F.col("size") + F.col("b_size")))


def _rest() -> Column:
    return F.least(F.col("size") - F.col("place"), F.col("b_size") - F.col("b_place")) - 1


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose exact intersection is large enough."""
    def side(name: str) -> DataFrame:
        return sets.select(F.col("set_id").alias(name), *(
            F.col(c).alias(f"{name}_{c}") for c in ("size", "hashes", "spread")))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    total = F.col("a_size") + F.col("b_size")
    most = F.aggregate(F.zip_with("a_spread", "b_spread", lambda x, y: F.least(x, y)), F.lit(0).cast("long"),
                       lambda x, y: x + y)
    within = (100 + percent) * most >= percent * total
    inter = F.size(F.array_intersect("a_hashes", "b_hashes"))
    return both.filter(F.when(within, (100 + percent) * inter >= percent * total)
                       .otherwise(False)).select("a", "b")


def linked(spark: SparkSession, sets: DataFrame, percent: int) -> DataFrame:
    """set_id, label: the components of the sets that link with another one."""
    total = sets.agg(F.sum("size")).first()[0] or 0
    lists = prefixes(sets, percent, max(1, total // _BLOCK)).withColumnRenamed("set_id", "id")

    def narrow(met: DataFrame, full: bool) -> DataFrame:
        # A place where two sets meet bounds what they share before and behind it.
        before = F.least("place", "b_place")
        if not full:
            return met.filter(_may_link(percent, before + 1 + _rest()))
        before = F.least(before, F.col("older") + F.col("b_older"))
        # Sets that link share one of the (1 - 2t / (1 + t)) n + 1 rarest of the smaller set.
        small = F.least(F.struct("size", "id", "place"), F.struct(
            F.col("b_size").alias("size"), F.col("b_id").alias("id"), F.col("b_place").alias("place")))
        return met.filter(_may_link(percent, before + 1 + _rest())
                          & ((100 + percent) * small["place"] <= (100 - percent) * small["size"]))

    return link_lists(spark, lists, narrow, lambda pairs: _verified(pairs, sets, percent),
                      order="place", hub="common").select(F.col("node").alias("set_id"), "label")


def components(spark: SparkSession, docs: DataFrame, *, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    profiled = written(profile(docs, n=n, percent=percent), new_folder(spark, "profile"))
    sets = written(shared_sets(docs, profiled, n=n), new_folder(spark, "sets"))
    labels = linked(spark, sets, percent)
    least = (profiled.filter("alive").groupBy("set_id").agg(F.min("doc_id").alias("least"))
             .join(labels, "set_id", "left").withColumn("label", F.coalesce("label", "set_id")))
    smallest = least.groupBy("label").agg(F.min("least").alias("component_id"))
    found = least.join(smallest, "label").select("set_id", "component_id")
    alive = profiled.filter("alive").join(found, "set_id")
    columns = ("doc_id", "n_shingles", "component_id")
    alone = profiled.filter("not alive").withColumn("component_id", F.col("doc_id"))
    return alive.select(*columns).unionByName(alone.select(*columns))
