"""Collocations of words, mined from FM-indexes of shards.

Texts are cut into pieces at ``.,;:!?`` and line breaks, pieces into words at blanks and tabs, A to
Z lowered. A shard holds about ``SHARD_BYTES`` of one language as word numbers (0 ends a piece) and
is kept as two Burrows-Wheeler transforms, of the words and of the words backwards. Suffixes are
sorted by their first ``depth`` words only, which is all that the intervals of phrases up to that
length look at, and no suffix looks beyond the end of its piece.

A phrase is a pair of intervals of equal size, one in each index. All phrases of a length are
extended at once: the symbols in a phrase's backward interval are the words that follow it, their
counts are the sizes of the longer phrases, and the two new intervals come from the smaller symbols
(forward) and from the first place of the symbol (backward). So each shard gives phrases with
their counts, and if asked how many occurrences have a word before and behind; shards are summed. A
phrase is spelled out, and extended to three words, only where its parts may be frequent in the
whole language; a bitmap of fixed size says so from sums over hashes, and what it takes in by
mistake only costs time.

A null language is ``und``; null and empty texts have no words. Rows that repeat a doc_id count
each for themselves, and doc_id is not read; other columns may have any name. Ties in the ranking
go to the larger count, then to the smaller phrase in UTF-8 bytes. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardsentry.session import new_folder, written

SHARD_BYTES = 2 << 20
DEPTH = 3
FILTER_BITS = 26
_HELD = 1 << 21  # hashes that a task adds up before it passes them on
_HELD_TEXTS = 40 << 20  # bytes of phrases, likewise
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PACK = 21  # bits of a place, a symbol and a rank in one sort key

_BREAKS = bytes.maketrans(b".,;:!?\n\v\f\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ",
                          b"\n\n\n\n\n\n\n\n\n\n abcdefghijklmnopqrstuvwxyz")
_INDEX = pa.schema([("lang", pa.string()), ("n_words", pa.int64()),
                    ("words", pa.binary()), ("forward", pa.binary()),
                    ("backward", pa.binary())])
_INDEX_DDL = "lang string, n_words long, words binary, forward binary, backward binary"


def _sorted_by(major: np.ndarray, minor: np.ndarray) -> np.ndarray:
    """Places in the order of (major, minor, place)."""
    n = len(major)
    if n < 1 << _PACK and (not n or max(major.max(), minor.max()) < 1 << _PACK):
        keys = (major.astype(np.int64) << 2 * _PACK) | (minor.astype(np.int64) << _PACK)
        keys |= np.arange(n)
        keys.sort()
        return keys & ((1 << _PACK) - 1)
    return np.lexsort((minor, major))  # a single text longer than a shard


def _firsts(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where a new combination of keys starts."""
    new = np.zeros(len(sorted_keys[0]), bool)
    new[:1] = True
    for keys in sorted_keys:
        new[1:] |= keys[1:] != keys[:-1]
    return np.flatnonzero(new)


def _planes(values: np.ndarray, kind: str = "<u4") -> bytes:
    """Unsigned values with their bytes of one rank side by side, compressed."""
    flat = np.ascontiguousarray(values, kind)
    return zstandard.ZstdCompressor().compress(flat.view(np.uint8).reshape(-1, flat.itemsize).T.tobytes())


def _unplaned(raw: bytes, kind: str = "<u4") -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def transform(symbols: np.ndarray, depth: int) -> np.ndarray:
    """The symbol before each suffix, suffixes sorted by their first ``depth`` symbols; the text
    is circular and starts and ends with 0."""
    rank = following = symbols
    order = _sorted_by(rank, np.zeros_like(rank))
    for k in range(1, depth):
        following = np.where(following != 0, np.roll(symbols, -k), 0)
        order = _sorted_by(rank, following)
        if k + 1 < depth:
            starts = _firsts(rank[order], following[order])
            dense = np.zeros(len(order), np.int64)
            dense[starts[1:]] = 1
            rank = np.empty(len(order), np.int64)
            rank[order] = np.cumsum(dense)
    return symbols[order - 1]


def shard(lang: str, texts: list[bytes], depth: int = DEPTH) -> dict:
    """One row of the index."""
    data = b"\n".join(texts).translate(_BREAKS).replace(b"\n", b" \n ")
    coded = pc.list_flatten(pc.split_pattern(pa.array([b"\n " + data + b" \n"], pa.large_binary()), " ")) \
        .dictionary_encode()
    known = coded.dictionary.to_pylist()
    number = np.empty(len(known), np.int64)
    words = []
    for k, word in enumerate(known):
        number[k] = -1 if word == b"" else 0 if word == b"\n" else len(words) + 1
        if number[k] > 0:
            words.append(word)
    symbols = number[coded.indices.to_numpy()]
    symbols = symbols[symbols >= 0]
    symbols = symbols[np.append(True, (symbols[1:] != 0) | (symbols[:-1] != 0))]
    pack = zstandard.ZstdCompressor().compress  # rows travel through Arrow buffers
    return {"lang": lang, "n_words": int((symbols > 0).sum()), "words": pack(b" ".join(words)),
            "forward": _planes(transform(symbols, depth)),
            "backward": _planes(transform(symbols[::-1], depth))}


def build(spark: SparkSession, docs: DataFrame, *, depth: int = DEPTH) -> DataFrame:
    """The index of all documents, a row per shard, written in the shared folder."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def out(lang: str) -> pa.RecordBatch:
            pa.default_memory_pool().release_unused()
            sizes.pop(lang)
            return pa.RecordBatch.from_pylist([shard(lang, held.pop(lang), depth)], _INDEX)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not text.is_valid:
                    continue
                held.setdefault(lang, []).append(text.as_buffer().to_pybytes())
                sizes[lang] = sizes.get(lang, 0) + len(held[lang][-1])
                if sizes[lang] >= SHARD_BYTES:
                    yield out(lang)
                elif sum(sizes.values()) >= 4 * SHARD_BYTES or len(sizes) > 64:
                    yield out(max(sizes, key=sizes.get))
        for lang in list(held):
            yield out(lang)

    return written(docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                               F.col("text").cast("string").alias("text")).mapInArrow(run, _INDEX_DDL),
                   new_folder(spark, "phrase-index"))


class Intervals:
    """Phrases of one length: their words, and where they stand in the two indexes."""

    def __init__(self, words: tuple, forward: np.ndarray, backward: np.ndarray, size: np.ndarray):
        self.words, self.forward, self.backward, self.size = words, forward, backward, size

    def chosen(self, which: np.ndarray) -> Intervals:
        return Intervals(tuple(w[which] for w in self.words), self.forward[which],
                         self.backward[which], self.size[which])


class Shard:
    """The two indexes of a shard, opened."""

    def __init__(self, row: dict):
        unpack = zstandard.ZstdDecompressor().decompress
        words = unpack(row["words"])
        self.words = pa.array(words.decode().split(" ") if words else [], pa.string())
        self.forward = _unplaned(row["forward"], "<i4")
        self.backward = _unplaned(row["backward"], "<i4")
        counts = np.bincount(self.forward, minlength=len(self.words) + 1)
        self.starts = np.cumsum(counts) - counts
        self.word_hashes = None
        self.counts = counts
        self.before = np.append(0, np.cumsum(self.forward != 0)).astype(np.int32)
        self.behind = np.append(0, np.cumsum(self.backward != 0)).astype(np.int32)
        order = _sorted_by(self.backward, np.zeros_like(self.backward))
        self.step = np.empty(len(order), np.int32)  # place of a symbol's occurrence one word on
        self.step[order] = np.arange(len(order))

    def single(self) -> Intervals:
        words = np.arange(1, len(self.counts))
        return Intervals((words,), self.starts[1:], self.starts[1:], self.counts[1:])

    def extended(self, phrases: Intervals) -> Intervals:
        """All phrases one word longer on the right."""
        n = int(phrases.size.sum())
        ends = np.cumsum(phrases.size)
        owner = np.repeat(np.arange(len(phrases.size)), phrases.size)
        place = np.arange(n) + (phrases.backward - (ends - phrases.size))[owner]
        symbol = self.backward[place].astype(np.int64)
        order = _sorted_by(owner, symbol)
        owner, symbol, place = owner[order], symbol[order], place[order]
        at = _firsts(owner, symbol)
        size = np.diff(np.append(at, n))
        owner, symbol = owner[at], symbol[at]
        smaller = at - (ends - phrases.size)[owner]
        made = Intervals((*(w[owner] for w in phrases.words), symbol),
                         phrases.forward[owner] + smaller, self.step[place[at]].astype(np.int64), size)
        return made.chosen(symbol != 0)

    def hashes(self, lang: str, phrases: Intervals) -> np.ndarray:
        """32 bits for each phrase that are the same in every shard of the language."""
        if self.word_hashes is None:
            salt = xxhash.xxh3_64_intdigest(lang)
            self.word_hashes = np.array([xxhash.xxh3_64_intdigest(w, salt) for w in
                                         self.words.to_pylist()], np.uint64)
        mixed = np.full(len(phrases.size), len(phrases.words), np.uint64)
        for w in phrases.words:
            mixed = (mixed ^ self.word_hashes[w - 1]) * _MIX
            mixed ^= mixed >> np.uint64(32)
        return (mixed * _MIX >> np.uint64(32)).astype(np.uint32)

    def texts(self, phrases: Intervals) -> pa.Array:
        parts = [self.words.take(pa.array(w - 1)) for w in phrases.words]
        return pc.binary_join_element_wise(*parts, " ") if len(parts) > 1 else parts[0]

    @staticmethod
    def _within(sums: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (sums[start + size] - sums[start]).astype(np.int64)

    def rows(self, phrases: Intervals, edges: bool) -> list[np.ndarray]:
        """The counts of phrases, and with ``edges`` how many occurrences have a word before and
        behind."""
        return [phrases.size] + edges * [self._within(self.before, phrases.forward, phrases.size),
                                         self._within(self.behind, phrases.backward, phrases.size)]


_NAMES = ("n", "n_before", "n_behind")


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Shard]]:
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            yield row["lang"], Shard(row)
            pa.default_memory_pool().release_unused()


def _summed(hashes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different hashes, ascending, and their sums."""
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    at = _firsts(hashes)
    return hashes[at], np.add.reduceat(n[order], at) if len(at) else n


_PACKED = pa.schema([("part", pa.int32()), ("steps", pa.binary()), ("counts", pa.binary())])


def _packed(held: list[tuple[np.ndarray, np.ndarray]], parts: int) -> pa.RecordBatch:
    """A row for each part of the hash space: the steps from hash to hash, and their sums."""
    hashes, n = _summed(*(np.concatenate(x) for x in zip(*held)))
    edges = (np.arange(parts + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(parts)
    bounds = np.searchsorted(hashes.astype(np.uint64), edges)
    full = [(p, lo, hi) for p, (lo, hi) in enumerate(zip(bounds, bounds[1:])) if lo < hi]
    return pa.RecordBatch.from_arrays(
        [pa.array([p for p, _, _ in full], pa.int32()),
         pa.array([_planes(np.diff(hashes[lo:hi], prepend=np.uint32(0))) for _, lo, hi in full], pa.binary()),
         pa.array([_planes(n[lo:hi]) for _, lo, hi in full], pa.binary())], schema=_PACKED)


class _Texts:
    """Phrases of languages and their counts, added up, as rows of a few bytes a phrase.

    A row has the phrases of one language and part, ascending, and their sums.
    """

    def __init__(self, sums: tuple[str, ...]):
        self.sums, self.held, self.size = sums, {}, 0
        self.schema = pa.schema([("part", pa.int32()), ("lang", pa.string()), ("phrases", pa.binary()),
                                 *((c, pa.binary()) for c in sums)])
        self.ddl = "part int, lang string, phrases binary, " + ", ".join(f"{c} binary" for c in sums)

    def add(self, lang: str, part: np.ndarray | int, texts: pa.Array, counted: list[np.ndarray]) -> None:
        part = np.broadcast_to(np.asarray(part, np.int32), len(texts))
        self.held.setdefault(lang, []).append(
            pa.table([pa.array(part), texts, *counted], names=["part", "phrase", *self.sums]))
        self.size += texts.nbytes

    def summed(self) -> Iterator[tuple[str, pa.Table]]:
        """phrase, part and sums of each language; nothing is held any more."""
        for lang in list(self.held):
            yield lang, pa.concat_tables(self.held.pop(lang)).group_by("phrase", use_threads=False).aggregate(
                [("part", "min"), *((c, "sum") for c in self.sums)]).rename_columns(["phrase", "part", *self.sums])
            pa.default_memory_pool().release_unused()
        self.size = 0

    def packed(self) -> Iterator[pa.RecordBatch]:
        for lang, table in self.summed():
            order = pc.sort_indices(table["phrase"]).to_numpy()
            order = order[np.argsort(table["part"].to_numpy()[order], kind="stable")]
            part = table["part"].to_numpy()[order]
            at = _firsts(part)
            ends = np.append(at, len(part))
            phrases = table["phrase"].take(pa.array(order)).combine_chunks()
            texts = pc.binary_join(pa.LargeListArray.from_arrays(ends, phrases), "\n")  # no phrase holds a line break
            pack = zstandard.ZstdCompressor().compress
            counted = [[_planes(n[lo:hi], "<u8") for lo, hi in zip(at, ends[1:])]
                       for n in (table[c].to_numpy()[order] for c in self.sums)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[at], pa.int32()), pa.array([lang] * len(at), pa.string()),
                 pa.array([pack(x.as_buffer()) for x in texts], pa.binary()),
                 *(pa.array(x, pa.binary()) for x in counted)], schema=self.schema)

    def unpacked(self, rows: pa.Table) -> None:
        unpack = zstandard.ZstdDecompressor().decompress
        for row in rows.to_pylist():
            texts = pa.array(unpack(row["phrases"]).decode().split("\n"), pa.string())
            self.add(row["lang"], row["part"], texts, [_unplaned(row[c], "<i8") for c in self.sums])


def _filter(hashes: DataFrame) -> bytes:
    """A bitmap of 2 ** FILTER_BITS bits over the upper bits of hashes, whatever their number."""
    place = F.shiftrightunsigned("hash", 32 - FILTER_BITS).cast("long") + 1
    rows = hashes.select(F.bitmap_bucket_number(place).alias("bucket"),
                         F.bitmap_bit_position(place).alias("bit")).groupBy("bucket").agg(
        F.bitmap_construct_agg("bit").alias("bits")).collect()  # 4096 bytes each, 2048 rows at most
    out = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for row in rows:
        at = (row["bucket"] - 1) * 4096
        out[at:at + 4096] = np.frombuffer(row["bits"], np.uint8)
    return out.tobytes()


def counts(spark: SparkSession, index: DataFrame, *, least: int, edges: bool = False) -> DataFrame:
    """lang, phrase, size, n of all phrases of one to three words that occur ``least`` times in
    their language, written; with ``edges`` also n_before and n_behind, the occurrences that a
    word precedes and follows.

    Most phrases occur a few times in all, so first their hashes alone are summed, those of three
    words where both pairs may be frequent; then what may be frequent is summed as what it is.
    """
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def hashed(found: Callable[[str, Shard], list[Intervals]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0
            for lang, opened in _opened(batches):
                for phrases in found(lang, opened):
                    held.append((opened.hashes(lang, phrases), phrases.size))
                    size += len(phrases.size)
                if size >= _HELD:
                    yield _packed(held, parts)
                    held, size = [], 0
            if size:
                yield _packed(held, parts)

        def often(rows: pd.DataFrame) -> pd.DataFrame:
            hashes = [np.cumsum(_unplaned(x), dtype=np.uint32) for x in rows["steps"]]
            counted = [_unplaned(x).astype(np.int64) for x in rows["counts"]]
            hashes, n = _summed(np.concatenate(hashes), np.concatenate(counted))
            return pd.DataFrame({"hash": hashes[n >= least].view(np.int32)})

        # Steps and sums in bytes take a quarter of the place that rows of both take in a shuffle.
        sums = index.mapInArrow(run, "part int, steps binary, counts binary")
        return spark.sparkContext.broadcast(_filter(sums.groupBy("part").applyInPandas(often, "hash int")))

    def frequent(bits, lang: str, opened: Shard, phrases: Intervals) -> Intervals:
        bits = np.frombuffer(bits.value, np.uint8)
        place = (opened.hashes(lang, phrases) >> np.uint32(32 - FILTER_BITS)).astype(np.int64)
        return phrases.chosen((bits[place >> 3] >> (place & 7).astype(np.uint8) & 1) == 1)

    def short(lang: str, opened: Shard) -> list[Intervals]:
        words = opened.single()
        return [words, opened.extended(words)]

    few = hashed(short)  # a bitmap, its size is fixed

    def long(lang: str, opened: Shard) -> list[Intervals]:
        pairs = frequent(few, lang, opened, opened.extended(opened.single()))
        if not len(pairs.size):
            return []
        three = opened.extended(pairs)
        known = (pairs.words[0] << 32) | pairs.words[1]  # ascending
        asked = (three.words[1] << 32) | three.words[2]
        found = np.minimum(np.searchsorted(known, asked), len(known) - 1)
        return [three.chosen(known[found] == asked)]

    more = hashed(long)

    sums = _NAMES if edges else _NAMES[:1]
    ddl = _Texts(sums).ddl

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = _Texts(sums)
        for lang, opened in _opened(batches):
            for bits, found in ((few, short), (more, long)):
                for phrases in found(lang, opened):
                    often = frequent(bits, lang, opened, phrases)
                    part = opened.hashes(lang, often).astype(np.uint64) * np.uint64(parts) >> np.uint64(32)
                    texts.add(lang, part, opened.texts(often), opened.rows(often, edges))
            if texts.size >= _HELD_TEXTS:
                yield from texts.packed()
        yield from texts.packed()

    def named(rows: pa.Table) -> pa.Table:
        texts = _Texts(sums)
        texts.unpacked(rows)
        found = [pa.table([pa.array([lang] * len(some), pa.string()), some["phrase"],
                           pc.cast(pc.add(pc.count_substring(some["phrase"], " "), 1), pa.int32()),
                           *(some[c] for c in sums)], schema=out)
                 for lang, table in texts.summed()
                 for some in [table.filter(pc.greater_equal(table["n"], least))]]
        return pa.concat_tables(found)

    out = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()),
                     *((c, pa.int64()) for c in sums)])
    # Sorted, a phrase and its sums take a third of the place that a row of both takes in a shuffle.
    summed = index.mapInArrow(spelled, ddl).groupBy("part").applyInArrow(
        named, "lang string, phrase string, size int, " + ", ".join(f"{c} long" for c in sums))
    return written(summed, new_folder(spark, "phrases"))


def collocations(spark: SparkSession, index: DataFrame, *, least: int, share: int,
                 top: int) -> DataFrame:
    """The strongest phrases of each language.

    Phrases of two or three words that occur ``least`` times; cut in two, a phrase scores a million
    times its count squared by the counts of its parts, and its weakest cut counts. Phrases within a
    longer one that has ``share`` percent of their count are dropped.
    """
    known = counts(spark, index, least=least)
    totals = index.groupBy("lang").agg(F.sum("n_words").alias("total"))
    words = F.split("phrase", " ")
    long = known.filter("size > 1").withColumn("w", words)
    splits = long.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", F.col("n").alias("a"), "k",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"))
    part = known.select(F.col("lang").alias("of"), F.col("phrase").alias("part"), F.col("n").alias("f"))
    for side, count in (("first", "l"), ("rest", "r")):
        splits = splits.join(part, (F.col("lang") == F.col("of")) & (F.col(side) == F.col("part"))) \
            .drop("of", "part").withColumnRenamed("f", count)
    wide = {c: F.col(c).cast("decimal(19,0)") for c in "alr"}
    squared = (wide["a"] * wide["a"]).cast("decimal(38,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    held = splits.withColumn("over", squared.cast("decimal(38,0)")) \
        .withColumn("under", (wide["l"] * wide["r"]).cast("decimal(38,0)")) \
        .withColumn("score", F.expr("over div under"))
    cut = held.groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inside = known.filter("size = 3").select("lang", "n", F.explode(F.array(
        F.array_join(F.slice(words, 1, 2), " "), F.array_join(F.slice(words, 2, 2), " "))).alias("phrase"))
    longest = inside.groupBy("lang", "phrase").agg(F.max("n").alias("longest"))
    kept = cut.join(longest, ["lang", "phrase"], "left").filter(
        F.col("longest").isNull() | (100 * F.col("longest") < share * F.col("a")))
    flat = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    salted = flat.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    few = salted.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
