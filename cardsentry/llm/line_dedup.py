"""Lines that repeat across the corpus, up to a few edits: a segment-partition edit join.

A line is cut into ``edits`` + 1 segments. If two lines are within ``edits`` edits, one of them
holds a segment of the other unchanged, at a place that the lengths and the segment's number
confine to a few starts. So each different line puts its segments into an index by (length,
number, text) and probes the indexes of its own length and of those up to ``edits`` shorter with
the few substrings that can meet. Lines that meet, and whose letters by remainder of their code
points differ by no more than the edits allow, are verified by a banded bit-parallel edit
distance, unless they are connected already (``components.link_lists``).

Only hashes move in the search: each task combines equal lines and sends 64-bit keys in packed
blocks, and the texts of the few lines that meet are fetched afterwards.

Lines are separated by line feeds and compared without white space at their ends. Edits are looked
for between lines of ``least`` words or of five times as many characters (scripts without blanks);
with ``short``, all other lines that are not empty are copies if they are equal. A class is a set
of lines connected by such likeness; its first occurrence, in the order (doc_id, text hash, line number),
is kept, the others go. Rows that repeat both doc_id and text count as one document. Null ids
come first, null and empty texts have no line. Only ``doc_id`` and ``text`` are read here;
``dedup`` keeps all other columns.
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

_ROWS = 512
_KEY, _GONE = "__line_dedup_key", "__line_dedup_gone"
_BLOCK = 30_000  # different lines whose keys a task sends at once


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def line_hash(line: str) -> int:
    return _signed(xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass")))


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """(start, length) of the segments of a line, as even as can be."""
    short, longer = divmod(length, edits + 1)
    sizes = [short + (k > edits - longer) for k in range(edits + 1)]
    return [(sum(sizes[:k]), size) for k, size in enumerate(sizes)]


def keys(line: str, edits: int) -> list[int]:
    """Index keys of the line's segments and of its substrings that can meet a segment."""
    n = len(line)

    def key(start: int, size: int, length: int, k: int) -> int:
        part = line[start:start + size].encode("utf-8", "surrogatepass")
        return xxhash.xxh3_64_intdigest(part, length * (edits + 1) + k)

    found = [key(start, size, n, k) for k, (start, size) in enumerate(segments(n, edits))]
    for length in range(max(edits + 1, n - edits), n + 1):
        shift = n - length
        for k, (place, size) in enumerate(segments(length, edits)):
            first = max(0, place - k, place + shift - (edits - k))
            last = min(n - size, place + k, place + shift + (edits - k))
            found += [key(start, size, length, k) for start in range(first, last + 1)
                      if shift or start != place]
    return found


def within(a: str, b: str, edits: int) -> bool:
    """Whether two lines are at most ``edits`` edits apart.

    Only the diagonals up to ``edits`` beside the main one are followed. Bit d of state k says
    that the letters of a read so far match those of b, d - edits more of them, with k edits.
    """
    if a == b:
        return True
    if abs(len(a) - len(b)) > edits:
        return False
    head, most = 0, min(len(a), len(b))
    step = 1 << 12
    while head < most and a[head:head + step] == b[head:head + step] and step:
        head += step
    head = min(head, most)
    while head < most and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < most - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[head:len(a) - tail], b[head:len(b) - tail]
    mask = (1 << (2 * edits + 1)) - 1
    states = [0] * (edits + 1)
    states[0] = 1 << edits
    for k in range(1, edits + 1):
        states[k] = states[k - 1] | (states[k - 1] << 1 & mask)
    for i, letter in enumerate(a):
        same = 0
        for d in range(-min(edits, i), edits + 1):
            if i + d < len(b) and b[i + d] == letter:
                same |= 1 << (d + edits)
        before, states[0] = states[0], states[0] & same
        for k in range(1, edits + 1):
            # the letter matches, is changed, or is left out; or letters of b come in
            now = states[k] & same | before | before >> 1 | states[k - 1] << 1
            before, states[k] = states[k], now & mask
        if not any(states):
            return False
    return bool(states[edits] >> (len(b) - len(a) + edits) & 1)


def lines_of(text: str | None, least: int) -> list[tuple[int, str]]:
    """(number, line) of the lines of a text that take part."""
    stripped = enumerate(x.strip() for x in text.split("\n")) if text else ()
    return [(k, x) for k, x in stripped
            if x and (len(x) >= 5 * least or len(x.split(None, least)) >= least)]


def _texts(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    doc = F.col("doc_id").cast("long")
    return docs.select(doc.alias("doc_id"), F.xxhash64(doc, text).alias("key"), text.alias("text"))


def occurrences(docs: DataFrame, least: int) -> DataFrame:
    """doc_id, key, line_no, line (a hash) of every line that takes part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                out = [[], [], [], []]
                for doc, key, text in zip(*(c.to_pylist() for c in batch.slice(at, _ROWS).columns)):
                    for number, line in lines_of(text, least):
                        for column, value in zip(out, (doc, key, number, line_hash(line))):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out],
                                                 ["doc_id", "key", "line_no", "line"])

    return _texts(docs).mapInArrow(run, "doc_id long, key long, line_no long, line long")


def meetings(docs: DataFrame, edits: int, least: int) -> DataFrame:
    """token, id, size: the different lines that share a key with another line."""
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, str] = {}

        def flush() -> pa.RecordBatch:
            mine = [keys(line, edits) for line in kept.values()]
            counts = np.array([len(x) for x in mine])
            flat = np.fromiter((k for x in mine for k in x), np.uint64, int(counts.sum()))
            line = np.repeat(np.fromiter(kept, np.int64, len(kept)), counts)
            size = np.repeat(np.array([len(x) for x in kept.values()], "<u4"), counts)
            part = ((flat >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            bounds = np.searchsorted(part[order], np.arange(parts + 1))
            rows = [(p, *(x[order[lo:hi]].tobytes() for x in (flat, line, size)))
                    for p, (lo, hi) in enumerate(zip(bounds, bounds[1:])) if lo < hi]
            kept.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows), (
                    pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
                ["part", "keys", "lines", "sizes"])

        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                for text in batch.column(0).slice(at, _ROWS).to_pylist():
                    for _, line in lines_of(text, least):
                        kept.setdefault(line_hash(line), line)
                if len(kept) >= _BLOCK:
                    yield flush()
        if kept:
            yield flush()

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        key, line, size = (np.concatenate([np.frombuffer(x, t) for x in rows[c]]) for c, t in (
            ("keys", "<u8"), ("lines", "<i8"), ("sizes", "<u4")))
        order = np.lexsort((line, key))
        key, line, size = key[order], line[order], size[order]
        new_key = np.r_[True, key[1:] != key[:-1]]
        once = new_key | np.r_[True, line[1:] != line[:-1]]
        key, line, size = key[once], line[once], size[once]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        many = np.repeat(np.diff(np.r_[starts, len(key)]) > 1, np.diff(np.r_[starts, len(key)]))
        return pd.DataFrame({"token": key[many].view(np.int64), "id": line[many],
                             "size": size[many].astype(np.int64)})

    return (docs.select(F.col("text").cast("string").alias("text"))
            .mapInArrow(send, "part int, keys binary, lines binary, sizes binary")
            .groupBy("part").applyInPandas(meet, "token long, id long, size long"))


def _lines(docs: DataFrame, wanted: DataFrame, least: int) -> DataFrame:
    """id, line: the texts of the wanted lines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                found = {line_hash(line): line for text in batch.column(0).slice(at, _ROWS).to_pylist()
                         for _, line in lines_of(text, least)}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.string())],
                    ["id", "line"])

    return (docs.select(F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "id long, line string").join(wanted, "id", "left_semi")
            .dropDuplicates(["id"]))


def _letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many letters of a line fall to each of 32 remainders of their code points."""
    for batch in batches:
        codes = (np.frombuffer(x.encode("utf-32-le", "surrogatepass"), "<u4") & 31
                 for x in batch.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([np.bincount(x, minlength=32).astype(np.int32) for x in codes],
                                       pa.list_(pa.int32()))], ["id", "letters"])


def classes(spark: SparkSession, docs: DataFrame, *, edits: int = 2, least: int = 5) -> DataFrame:
    """line (a hash), label: the class of each line that is like another, different line."""
    lists = written(meetings(docs, edits, least), new_folder(spark, "lists"))
    texts = written(_lines(docs, lists.select("id").distinct(), least), new_folder(spark, "lines"))

    lists = lists.join(texts.mapInArrow(_letters, "id long, letters array<int>"), "id")

    def narrow(met: DataFrame, full: bool) -> DataFrame:
        # An edit changes two of the sums of letters by one.
        apart = F.aggregate(F.zip_with("letters", "b_letters", lambda x, y: F.abs(x - y)), F.lit(0),
                            lambda x, y: x + y)
        return met.filter(F.when(F.abs(F.col("size") - F.col("b_size")) <= edits, apart <= 2 * edits)
                          .otherwise(False))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [within(x, y, edits) for x, y in zip(
                batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield batch.select([0, 1]).filter(pa.array(near, pa.bool_()))

    def verified(pairs: DataFrame) -> DataFrame:
        one = texts.select(F.col("id").alias("a"), F.col("line").alias("a_line"))
        two = texts.select(F.col("id").alias("b"), F.col("line").alias("b_line"))
        return pairs.join(one, "a").join(two, "b").select("a", "b", "a_line", "b_line").mapInArrow(
            check, "a long, b long")

    return link_lists(spark, lists, narrow, verified).select(F.col("node").alias("line"), "label")


def _place() -> Column:
    return F.struct("doc_id", "key", "line_no")


def judged(spark: SparkSession, docs: DataFrame, *, edits: int = 2, least: int = 5,
           short: bool = False) -> DataFrame:
    """Every line that takes part (with ``short`` all that are not empty): doc_id, key, line_no, its
    class (the place of the class's first line: class_doc_id, class_line_no), and whether the line
    is kept.

    A line that stands in a third of all documents is summed up before it moves, and the join
    back is an ordinary one, which Spark splits where it is skewed.
    """
    all_lines = written(occurrences(docs, 0 if short else least),
                        new_folder(spark, "occurrences"))
    labels = classes(spark, docs, edits=edits, least=least)
    first = all_lines.groupBy("line").agg(F.min(_place()).alias("first"))
    named = first.join(labels, "line", "left").withColumn("label", F.coalesce("label", "line"))
    alike = (named.groupBy("label").agg(F.min("first").alias("kept")))
    of_line = named.join(alike, "label").select("line", "kept")
    return all_lines.join(of_line, "line").select(
        "doc_id", "key", "line_no", F.col("kept.doc_id").alias("class_doc_id"),
        F.col("kept.line_no").alias("class_line_no"), _place().eqNullSafe(F.col("kept")).alias("kept"))


def dedup(spark: SparkSession, docs: DataFrame, *, edits: int = 2, least: int = 5,
          short: bool = True) -> DataFrame:
    """The documents without their repeated lines, all columns kept.

    Documents that lose a line and have no text left are dropped; those that had none stay.
    """
    gone = (judged(spark, docs, edits=edits, least=least, short=short).filter("not kept")
            .groupBy(F.col("key").alias(_KEY)).agg(F.collect_set("line_no").alias(_GONE)))
    text = F.col("text").cast("string")
    joined = docs.join(gone, F.xxhash64(F.col("doc_id").cast("long"), text) == F.col(_KEY), "left")
    kept = F.array_join(F.filter(
        F.split(text, "\\n", -1),
        lambda line, k: ~F.array_contains(_GONE, k.cast("long"))), "\n")
    names = docs.columns
    changed = F.when(F.col(_GONE).isNull(), text).otherwise(kept)
    return joined.withColumn("text", changed).filter(
        F.col(_GONE).isNull() | (F.trim("text") != "")).select(*names)
