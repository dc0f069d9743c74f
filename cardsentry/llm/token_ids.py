"""Token ids in files: frequency-ranked, byte-aligned, variable-length, separate control bytes.

Every id of the corpus is counted and gets its rank (the most frequent id is rank 0, ties go to
the smaller id). A rank takes one to four bytes; its length less one is a two-bit code, four
codes to a control byte. Control bytes and data bytes stand apart, so a block is decoded with
numpy table look-ups and no loop over ids.

A folder of this format holds ``blocks`` (documents in ascending order; a block has whole
documents and about ``BLOCK_IDS`` ids) and ``ranks`` (rank, token id). Both are Parquet, so they
can be read and written in any store that Spark reaches, and a lost task is written again.

Order: ascending doc_id, nulls first; rows with the same doc_id in the order of the input files.
Null and empty texts have the end id alone. An empty table gives a folder with no block. Only
``doc_id`` and ``text`` are read; other columns may have any name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardsentry.llm.tokens import unit_ids
from cardsentry.session import kept

BLOCK_IDS = 1 << 18
_ROWS = 512  # rows that a task holds as Python objects at once

_WIDTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1  # control byte: 4 widths
_STARTS = np.cumsum(_WIDTHS, axis=1) - _WIDTHS
_TOTALS = _WIDTHS.sum(axis=1)


def encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    values = np.ascontiguousarray(values, "<u4")
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    more = codes[:len(values)]  # bytes of a value beyond its first
    for most in (0xFF, 0xFFFF, 0xFFFFFF):
        more += values > most
    ends = np.cumsum(more, dtype=np.int64) + np.arange(1, len(values) + 1)
    starts = ends - more - 1
    data = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    data[starts] = values.astype(np.uint8)
    for k in range(1, int(more.max(initial=0)) + 1):
        wide = np.flatnonzero(more >= k)
        data[starts[wide] + k] = (values[wide] >> np.uint32(8 * k)).astype(np.uint8)
    four = codes.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    return control.tobytes(), data.tobytes()


def decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of a block."""
    codes = np.frombuffer(control, np.uint8)
    totals = _TOTALS[codes]
    starts = ((np.cumsum(totals) - totals)[:, None] + _STARTS[codes]).ravel()[:n]
    widths = _WIDTHS[codes].ravel()[:n]
    raw = np.frombuffer(data, np.uint8)
    values = raw[starts].astype(np.uint32)
    for k in range(1, int(widths.max(initial=1))):
        wide = np.flatnonzero(widths > k)
        values[wide] |= raw[starts[wide] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


def tokenize(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """doc_id, position of the row in the input, ids of the whole text and the end id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = unit_ids(vocabulary)
        end = np.array([end_id], "<u4").astype(units.dtype).tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                rows = batch.slice(at, _ROWS)
                ids = [units.ids(text).tobytes() + end for text in rows.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(ids, pa.binary())],
                    ["doc_id", "row", "ids"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.monotonically_increasing_id().alias("row"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, row long, ids binary")


def _width(vocabulary_size: int) -> np.dtype:
    return np.dtype("<u2") if vocabulary_size <= 65536 else np.dtype("<u4")


def _joined(ids: pa.Array, dtype: np.dtype) -> np.ndarray:
    """The ids of all documents of an array, one after another; no value is null."""
    if not len(ids):
        return np.empty(0, dtype)
    ids = ids.cast(pa.large_binary())
    _, ends, data = ids.buffers()
    ends = np.frombuffer(ends, "<i8")[ids.offset:ids.offset + len(ids) + 1]
    return np.frombuffer(data or b"", np.uint8)[ends[0]:ends[-1]].view(dtype)


def count_ids(tokens: DataFrame, size: int) -> np.ndarray:
    """How often each id occurs in all documents; its length is bounded by the vocabulary."""
    dtype = _width(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            ids = _joined(batch.column(0), dtype)
            for at in range(0, len(ids), BLOCK_IDS):
                total += np.bincount(ids[at:at + BLOCK_IDS], minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    counts = np.zeros(size, np.int64)
    summed = tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(
        F.sum("n").alias("n"))
    for row in summed.collect():  # one row for each id of the vocabulary at most
        counts[row["id"]] = row["n"]
    return counts


def _pack(ranks: np.ndarray, dtype: np.dtype):
    """Sorted documents of a partition to blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = block = before = held = 0
        docs, lengths, chunks = [], [], []

        def full() -> pa.RecordBatch:
            control, data = encode(ranks[np.concatenate(chunks)])
            return pa.RecordBatch.from_pylist([{
                "part": part, "block": block, "before": before, "n_ids": held,
                "doc_ids": docs, "lengths": lengths, "control": control, "data": data}], _BLOCK)

        for batch in batches:
            for at in range(batch.num_rows):
                part = batch.column(2)[at].as_py()
                ids = np.frombuffer(batch.column(1)[at].as_buffer(), dtype)
                docs.append(batch.column(0)[at].as_py())
                lengths.append(len(ids))
                chunks.append(ids)
                held += len(ids)
                if held >= BLOCK_IDS:
                    yield full()
                    block, before, held, docs, lengths, chunks = block + 1, before + held, 0, [], [], []
        if docs:
            yield full()
    return run


_BLOCK = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("before", pa.int64()),
                    ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                    ("lengths", pa.list_(pa.int64())), ("control", pa.binary()),
                    ("data", pa.binary())])
_BLOCK_DDL = ("part long, block long, before long, n_ids long, doc_ids array<long>, "
              "lengths array<long>, control binary, data binary")


def write_ids(spark: SparkSession, docs: DataFrame, folder: str, *, vocabulary: str,
              end_id: int) -> None:
    """Writes the ids of all documents below ``folder``.

    The text is read once and never shuffled: only ids move, to ranges of doc_id. A doc_id that
    many rows share is split by the rows' positions.
    """
    size = unit_ids(vocabulary).tokenizer.get_vocab_size()
    dtype = _width(size)
    tokens = kept(tokenize(docs, vocabulary, end_id))
    counts = count_ids(tokens, size)
    order = np.lexsort((np.arange(size), -counts))
    ranks = np.empty(size, np.uint32)
    ranks[order] = np.arange(size, dtype=np.uint32)
    spark.createDataFrame([(k, int(v)) for k, v in enumerate(order)], "rank long, id long") \
        .coalesce(1).write.parquet(f"{folder}/ranks")
    (tokens.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row")
     .select("doc_id", "ids", F.spark_partition_id().cast("long").alias("part"))
     .mapInArrow(_pack(ranks, dtype), _BLOCK_DDL)
     .write.option("compression", "zstd").parquet(f"{folder}/blocks"))
    tokens.unpersist()


def read_documents(spark: SparkSession, folder: str, *, keep_ids: bool = False) -> DataFrame:
    """One row per document, decoded from the files: doc_id, start, n_tokens, ids_crc32.

    With ``keep_ids`` the ids come along as little-endian unsigned 32-bit integers.
    """
    ranks = spark.read.parquet(f"{folder}/ranks")  # bounded by the vocabulary
    table = np.zeros(max(1, ranks.count()), "<u4")
    for row in ranks.collect():
        table[row["rank"]] = row["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                ids = table[decode(block["control"], block["data"], block["n_ids"])]
                lengths = np.array(block["lengths"], np.int64)
                ends = np.cumsum(lengths)
                parts = [ids[e - n:e].tobytes() for e, n in zip(ends, lengths)]
                columns = [pa.array(block["doc_ids"], pa.int64()),
                           pa.array(block["start"] + ends - lengths), pa.array(lengths),
                           pa.array([zlib.crc32(x) for x in parts], pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    columns + ([pa.array(parts, pa.binary())] if keep_ids else []), names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if keep_ids else [])]
    blocks = spark.read.schema(_BLOCK_DDL).parquet(f"{folder}/blocks")
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))  # a row for each file
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    placed = blocks.join(F.broadcast(parts), "part").select(
        (F.col("base") + F.col("before")).alias("start"), "n_ids", "doc_ids", "lengths", "control",
        "data")
    ddl = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * keep_ids
    return placed.mapInArrow(run, ddl)
