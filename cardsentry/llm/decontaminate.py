"""Benchmark decontamination: every passage of the corpus as a query against the test items.

The test items are the documents of a BM25 inverted index; a score is divided by the score an
item has against itself, so one threshold fits all. Each text is read in passages of twice the
longest item's words, one item's length apart, so a whole copy always lies within a passage.
Retrieval is exact, by block-max WAND over items in blocks of neighbouring numbers:

1. For all passages of some texts at once, the largest impacts of each word in each block are
   added up (numpy). A block whose sum stays below the threshold holds no answer and is skipped.
2. In each block left, WAND runs over its part of the posting lists: lists in order of their
   current item, a pivot where the sum of the lists' maxima in the block reaches the threshold,
   and a full score for the pivot alone.

Every item above the threshold is then verified: the share of the question's word trigrams that
the passage has, and the same for the answer. Both must reach ``least``; with ``alone``, a share
(``ALONE`` in production), a question of ``long_question`` trigrams that is there to that share is a leak
whatever became of its answer. Items with ``question`` and ``answer`` columns
bring their own; of others the last sentence is the answer (the last quarter of the words if
there is only one).

The items are taken in chunks of about ``CHUNK``, each a bounded index, each meeting all texts.
Null or empty texts hold no passage, items without a word are left out, and items that repeat
both id and words count once. ``clean`` judges rows by id and text, so a row that only shares the id
of a leak stays. Words are runs of letters and digits,
lower-cased. Only ``doc_id``, ``text`` and ``item_id`` (and the two above) are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = 1000  # items of an index
BLOCK = 4  # items of a block
ALONE = 0.8  # the share of a question that is a leak without its answer
_LEAKED = "__decontaminate_leaked"
_K1, _B = 1.2, 0.75
_WORDS = re.compile(r"[^\W_]+").findall
_SENTENCES = re.compile(r"(?<=[.!?])\s+|\n+").split


def words(text: str | None) -> list[str]:
    return _WORDS(text.lower()) if text else []


def split_item(text: str) -> tuple[list[str], list[str]]:
    """The words of the question and of the answer of an item that is one text."""
    sentences = [w for w in map(words, _SENTENCES(text)) if w]
    if len(sentences) > 1:
        return [w for s in sentences[:-1] for w in s], sentences[-1]
    flat = sentences[0] if sentences else []
    cut = len(flat) - max(1, len(flat) // 4)
    return flat[:cut], flat[cut:]


def grams(sequence: list[str], n: int = 3) -> set[tuple[str, ...]]:
    n = min(n, len(sequence))
    return {tuple(sequence[k:k + n]) for k in range(len(sequence) - n + 1)} if n else set()


def overlap(part: set[tuple[str, ...]], passage: list[str]) -> float:
    """The share of a part's n-grams that the passage has; 1 for an empty part."""
    if not part:
        return 1.0
    return len(part & grams(passage, len(next(iter(part))))) / len(part)


@dataclass
class Index:
    ids: list[int]
    questions: list[set]
    answers: list[set]
    numbers: dict[str, int]  # of words
    items: list[np.ndarray]  # posting lists: items in order ...
    impacts: list[np.ndarray]  # ... and their share of the item's own score
    maxima: np.ndarray  # largest impact of each word in each block
    size: int  # items of a block
    longest: int  # words of the longest item


def build(rows: list[tuple[int, list[str], list[str]]], df: dict[str, int], n_items: int,
          average: float) -> Index:
    """An index of items (id, question words, answer words); df and average are of all items."""
    rows = sorted(rows, key=lambda r: (sorted(Counter(r[1] + r[2]).items(), key=lambda x: -x[1])[:1],
                                       r[0]))  # items alike in their commonest word are neighbours
    postings: dict[str, list[tuple[int, float]]] = {}
    for at, (_, question, answer) in enumerate(rows):
        counts = Counter(question + answer)
        long = _K1 * (1 - _B + _B * sum(counts.values()) / average)
        weights = {w: np.log(1 + (n_items - df[w] + 0.5) / (df[w] + 0.5)) * n * (_K1 + 1) / (n + long)
                   for w, n in sorted(counts.items())}
        own = sum(weights.values())
        for w, value in weights.items():
            postings.setdefault(w, []).append((at, value / own))
    numbers = {w: k for k, w in enumerate(postings)}
    items = [np.array([i for i, _ in p]) for p in postings.values()]
    impacts = [np.array([x for _, x in p]) for p in postings.values()]
    size = BLOCK
    maxima = np.zeros((len(items), -(-len(rows) // size)), np.float32)
    for k, (where, value) in enumerate(zip(items, impacts)):
        np.maximum.at(maxima[k], where // size, np.nextafter(value.astype(np.float32), np.float32(2)))
    return Index([r[0] for r in rows], [grams(r[1]) for r in rows], [grams(r[2]) for r in rows],
                 numbers, items, impacts, maxima, size,
                 max((len(r[1]) + len(r[2]) for r in rows), default=1))


def wand(index: Index, terms: np.ndarray, threshold: float, block: int) -> dict[int, float]:
    """Every item of a block that scores the threshold or more."""
    found: dict[int, float] = {}
    end = min((block + 1) * index.size, len(index.ids))
    cursors = [[int(np.searchsorted(index.items[t], block * index.size)), t]
               for t in terms[index.maxima[terms, block] > 0].tolist()]

    def item(cursor) -> int:
        at, t = cursor
        return int(index.items[t][at]) if at < len(index.items[t]) else end

    slack = 1e-9  # sums in another order must not lose an item on the threshold
    while True:
        cursors = sorted((c for c in cursors if item(c) < end), key=item)
        total, pivot = 0.0, end
        for cursor in cursors:  # the block's maxima are the bounds of its lists
            total += float(index.maxima[cursor[1], block])
            if total >= threshold - slack:
                pivot = item(cursor)
                break
        if pivot >= end:
            return found
        score = 0.0
        for cursor in cursors:
            t = cursor[1]
            if item(cursor) < pivot:
                cursor[0] += int(np.searchsorted(index.items[t][cursor[0]:], pivot))
            if item(cursor) == pivot:
                score += float(index.impacts[t][cursor[0]])
                cursor[0] += 1
        if score >= threshold - slack:
            found[pivot] = score


def search(index: Index, texts: list[list[str]], threshold: float) -> Iterator[tuple]:
    """(text, item, score, question overlap, answer overlap, first word) of verified passages."""
    step = index.longest
    known = [np.fromiter((index.numbers.get(w, -1) for w in text), np.int64, len(text))
             for text in texts]
    halves = [max(1, -(-len(text) // step)) for text in texts]
    first = np.cumsum([0, *halves])
    half = np.concatenate([first[k] + np.arange(len(x)) // step for k, x in enumerate(known)])
    flat = np.concatenate(known)
    keys = np.unique(half[flat >= 0] * len(index.items) + flat[flat >= 0])
    at, term = keys // len(index.items), keys % len(index.items)
    sums = np.zeros((first[-1] + 1, index.maxima.shape[1]), np.float32)
    if len(keys):
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        sums[at[starts]] = np.add.reduceat(index.maxima[term], starts, axis=0)
    last = np.zeros(len(sums), bool)
    last[first[1:] - 1] = True
    sums[:-1] += np.where(last[:-1, None], 0, sums[1:])  # a passage is two halves
    maybe = (sums >= threshold - 1e-4)[:-1]
    for passage in np.flatnonzero(maybe.any(axis=1)):
        text = int(np.searchsorted(first, passage, "right")) - 1
        start = int(passage - first[text]) * step
        terms = known[text][start:start + 2 * step]
        terms, said = np.unique(terms[terms >= 0]), texts[text][start:start + 2 * step]
        for block in np.flatnonzero(maybe[passage]).tolist():
            for item, score in wand(index, terms, threshold, block).items():
                yield (text, item, min(1.0, score), overlap(index.questions[item], said),
                       overlap(index.answers[item], said), start)


def indexes(items: DataFrame) -> Iterator[Index]:
    """The indexes of all items, one bounded chunk at a time."""
    own = {"question", "answer"} <= set(items.columns)
    texts = items.select("item_id", *(F.col(c).cast("string") for c in (
        ("question", "answer") if own else ("text",))))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[words(t) for t in r] if own else list(split_item(r[0] or ""))
                    for r in zip(*(c.to_pylist() for c in batch.columns[1:]))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[k] for r in rows], pa.list_(pa.string()))
                                    for k in (0, 1))], ["item_id", "question", "answer"])

    parsed = (texts.mapInArrow(parse, "item_id long, question array<string>, answer array<string>")
              .dropDuplicates(["item_id", "question", "answer"])
              .withColumn("words", F.concat("question", "answer")).filter(F.size("words") > 0))
    n, total = parsed.agg(F.count("*"), F.sum(F.size("words"))).first()
    if not n:
        return
    frequencies = parsed.select(F.explode(F.array_distinct("words")).alias("word"))
    counted = frequencies.groupBy("word").agg(F.count("*").alias("df"))
    chunks = -(-n // CHUNK)
    dealt = parsed.withColumn("chunk", F.pmod(F.xxhash64("item_id", "words"), F.lit(chunks)))
    for chunk in range(chunks):
        part = dealt.filter(F.col("chunk") == chunk)
        rows = [(r["item_id"], r["question"], r["answer"]) for r in
                part.select("item_id", "question", "answer").collect()]  # about CHUNK
        used = part.select(F.explode("words").alias("word")).distinct()
        yield build(rows, {r["word"]: r["df"] for r in counted.join(used, "word").collect()}, n,
                    total / n)


_ROW = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()),
                  ("question_overlap", pa.float64()), ("answer_overlap", pa.float64()),
                  ("first_word", pa.int64())])


def leaks(spark: SparkSession, docs: DataFrame, items: DataFrame, *, threshold: float = 0.6,
          least: float = 0.5, alone: float | None = None,
          long_question: int = 8) -> DataFrame:
    """doc_id, item_id and the best passage's score, overlaps and first word, if it is verified."""
    def run(index: Index):
        def search_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    rows = batch.slice(at, 256)
                    best: dict[tuple, tuple] = {}
                    texts = [words(t) for t in rows.column(1).to_pylist()]
                    ids = rows.column(0).to_pylist()
                    for text, item, score, question, answer, start in search(index, texts, threshold):
                        whole = (alone is not None and question >= alone
                                 and len(index.questions[item]) >= long_question)
                        key, value = (text, index.ids[item]), (score, question, answer, -start)
                        if (whole or min(question, answer) >= least) and value > best.get(key, (-1,)):
                            best[key] = value
                    yield pa.RecordBatch.from_pylist(
                        [{"doc_id": ids[text], "item_id": item, "score": v[0],
                          "question_overlap": v[1], "answer_overlap": v[2], "first_word": -v[3]}
                         for (text, item), v in best.items()], _ROW)
        return search_in

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
    ddl = ("doc_id long, item_id long, score double, question_overlap double, "
           "answer_overlap double, first_word long")
    found = spark.createDataFrame([], ddl)
    for index in indexes(items):
        found = found.unionByName(texts.mapInArrow(run(index), ddl))
    return found


def clean(spark: SparkSession, docs: DataFrame, items: DataFrame, **limits: float) -> DataFrame:
    """The documents without a verified leak, all columns as they are."""
    key = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    bad = leaks(spark, docs.select(key.alias("doc_id"), "text"), items, **limits).select(
        F.col("doc_id").alias(_LEAKED)).distinct()
    return docs.join(bad, key == F.col(_LEAKED), "left_anti")
