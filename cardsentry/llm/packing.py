"""Documents packed into sequences of equal capacity by multiway differencing.

A document's ids (and an end id) are cut into pieces: as many full sequences as it fills, then
pieces of at most ``piece`` ids. Full pieces are sequences of their own. The others are dealt by
a hash into groups of about ``GROUP``; in each group Karmarkar-Karp differencing splits the
pieces into k near-equal windows: each piece starts as a partial partition of its own, and the
two partitions with the largest imbalance are merged again and again, the large windows of one
onto the small ones of the other. k starts at the least number that can hold the ids and rises
while a window exceeds the capacity.

Null and empty texts are documents of one id, the end id. Rows that repeat a doc_id are packed
each for itself. An empty table gives no piece. Only ``doc_id`` and ``text`` are read; other
columns may have any name.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.llm.tokens import unit_ids
from cardsentry.session import kept

GROUP = 2048
_ROWS = 512


def difference(lengths: list[int], k: int) -> list[tuple[int, list[int]]]:
    """k windows of near-equal sums, the largest first: (sum, indexes of its pieces).

    Windows without a piece are left out. Ties are broken by the order of the pieces.
    """
    heap = [(-n, at, [(n, [at])]) for at, n in enumerate(lengths)]
    heapq.heapify(heap)
    made = len(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        if len(a) < len(b):
            a, b = b, a
        empty = k - len(a)  # windows of a that hold nothing take the largest of b
        rest = b[empty:]
        kept = len(a) - len(rest)
        met = [(x[0] + y[0], x[1] + y[1]) for x, y in zip(a[kept:], reversed(rest))]
        merged = sorted(a[:kept] + b[:empty] + met, key=lambda window: -window[0])
        smallest = merged[-1][0] if len(merged) == k else 0
        heapq.heappush(heap, (smallest - merged[0][0], made, merged))
        made += 1
    return heap[0][2] if heap else []


def windows(lengths: list[int], capacity: int) -> list[list[int]]:
    """Pieces (none above the capacity) of each window, no window above the capacity."""
    k = max(1, -(-sum(lengths) // capacity))
    while True:
        found = difference(lengths, k)
        if not found or found[0][0] <= capacity:
            return [items for _, items in found]
        k += max(1, k // 256)


def cut(n: int, capacity: int, piece: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids."""
    full = n - n % capacity
    return ([(at, capacity) for at in range(0, full, capacity)]
            + [(at, min(piece, n - at)) for at in range(full, n, piece)])


def pieces(docs: DataFrame, *, vocabulary: str, end_id: int, capacity: int, piece: int,
           keep_ids: bool) -> DataFrame:
    """The pieces of all documents; ``row`` numbers them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = unit_ids(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                out = [[] for _ in names]
                rows = batch.slice(at, _ROWS)
                for doc, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                    ids = np.append(units.ids(text), end_id).astype("<u4")
                    for start, length in cut(len(ids), capacity, piece):
                        part = ids[start:start + length].tobytes()
                        row = (doc, start, length, zlib.crc32(part), len(ids), part)
                        for column, value in zip(out, row):
                            column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, kind) for x, kind in zip(out, kinds)], names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if keep_ids else [])]
    kinds = [pa.int64()] * 5 + [pa.binary()] * keep_ids
    ddl = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
            .mapInArrow(run, ddl + ", ids binary" * keep_ids)
            .withColumn("row", F.monotonically_increasing_id()))


def pack(spark: SparkSession, docs: DataFrame, *, vocabulary: str, end_id: int,
         capacity: int = 1024, piece: int = 256, keep_ids: bool = False) -> DataFrame:
    """Every piece with its sequence and its place there.

    Pieces are kept on disk, so texts are cut and encoded once; then rows without text move.
    Sequence ids are unique, not gapless: even ones hold several pieces, odd ones a full piece.
    """
    all_pieces = kept(pieces(docs, vocabulary=vocabulary, end_id=end_id, capacity=capacity,
                             piece=piece, keep_ids=keep_ids))
    columns = [c for c in all_pieces.columns if c != "row"]
    small = all_pieces.filter(F.col("length") < capacity)
    groups = -(-small.count() // GROUP) or 1

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "row"], ascending=[False, True], ignore_index=True)
        found = windows(group["length"].tolist(), capacity)
        order = [at for items in found for at in items]
        placed = group.iloc[order].copy()
        lengths = placed["length"].to_numpy()
        sizes = np.array([len(items) for items in found])
        window = np.repeat(np.arange(len(found)), sizes)
        before = np.cumsum(lengths) - lengths
        first = np.repeat(before[np.cumsum(sizes) - sizes], sizes)
        placed["sequence_id"] = (placed["group"].astype("int64") * (1 << 20) + window) * 2
        placed["offset"] = before - first
        return placed[columns + ["sequence_id", "offset"]]

    ddl = ", ".join(f"{c} {t}" for c, t in all_pieces.select(*columns).dtypes)
    packed = (small.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
              .groupBy("group").applyInPandas(place, f"{ddl}, sequence_id long, offset long"))
    full = all_pieces.filter(F.col("length") == capacity).select(
        *columns, (F.col("row") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(full)


def sequences(packed: DataFrame, *, capacity: int = 1024, pad_id: int = 0) -> DataFrame:
    """The token windows themselves: sequence_id, n_ids, ids padded to the capacity.

    Takes the result of ``pack`` with ``keep_ids``. A window whose length is a power of two
    stays as it is.
    """
    gathered = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_ids"),
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    n = F.col("n_ids")
    whole = n.bitwiseAND(n - 1) == 0
    padding = F.unhex(F.repeat(F.lit(int(pad_id).to_bytes(4, "little").hex()),
                               (F.lit(capacity) - n).cast("int")))
    return gathered.select("sequence_id", "n_ids",
                           F.when(whole, joined).otherwise(F.concat(joined, padding)).alias("ids"))
