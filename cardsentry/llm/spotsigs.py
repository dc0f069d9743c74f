"""SpotSigs: document fingerprints from chains of content words behind common words.

Every occurrence of an anchor (a common function word) spots the next ``CHAIN`` words that are no
anchors; anchor and chain are hashed to 32 bits. The set of these signatures is the fingerprint,
kept as base64 of its sorted numbers. Navigation and boilerplate hold few function words, so the
running text decides. A text without an anchor has the hash of its words as its one signature.

Likeness is the Jaccard value of two sets. A comparison with a threshold is pruned by length: if
the smaller set is less than threshold times the larger one, no value can reach it. ``near`` joins
a whole table that way: sets meet in the lists of the rare signatures they share, only those of
lengths that can reach the threshold are paired, and the lists are those of ``ngram_join``.

Null and empty texts have the empty fingerprint; two empty ones are alike (1). Only ``doc_id``
and ``text`` are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHAIN = 3
_WORDS = re.compile(r"\w+").findall
_K = np.uint64(0x9E3779B97F4A7C15)

# Function words of English, French, German and Spanish.
ANCHORS = frozenset("""
a an and are as at be been but by for from had has have he her his if in is it its not of on or
she that the their they this to was we were what which who will with you
au aux avec ce ces dans de des du elle en est et il je la le les leur lui mais ne nous ou par pas
pour que qui sa se ses son sur un une vous
als am auf aus bei das dem den der des die ein eine einem einen einer er es für hat ich im ist
mit nach nicht sich sie sind so und vom von war wie wird zu zum zur
al como con del el ella era esta fue ha hay la las lo los más me mi no nos o para pero por se si
sin su sus también una y
""".split())
_ANCHOR_HASHES = np.sort(np.array([xxhash.xxh3_64_intdigest(w) for w in ANCHORS], np.uint64))


def signatures(text: str | None) -> np.ndarray:
    """The sorted signatures of a text."""
    words = _WORDS(text.lower()) if text else []
    if not words:
        return np.empty(0, np.uint32)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    place = np.minimum(np.searchsorted(_ANCHOR_HASHES, hashes), len(_ANCHOR_HASHES) - 1)
    anchor = _ANCHOR_HASHES[place] == hashes
    content = np.concatenate([hashes[~anchor], np.zeros(CHAIN, np.uint64)])  # short chains end in 0
    after = np.cumsum(~anchor)[anchor]
    mixed = hashes[anchor] * _K
    for k in range(CHAIN):
        mixed = (mixed ^ content[after + k]) * _K
        mixed ^= mixed >> np.uint64(31)
    mixed = mixed[content[after] != 0]  # an anchor with nothing behind it spots nothing
    if not len(mixed):
        mixed = np.array([xxhash.xxh3_64_intdigest(hashes.tobytes())], np.uint64)
    return np.unique((mixed >> np.uint64(32)).astype(np.uint32))


def pack(found: np.ndarray) -> str:
    return base64.b64encode(found.astype("<u4").tobytes()).decode()


def unpack(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4")


def likeness(a: np.ndarray, b: np.ndarray, threshold: float = 0.0) -> float:
    """Jaccard value of two sorted sets, or 0 where it cannot reach the threshold."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if small < threshold * large or not small:
        return 0.0
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    value = shared / (small + large - shared)
    return value if value >= threshold else 0.0


def edited(text: str, following: str) -> str:
    """The last half of a text replaced by as much of the start of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                  ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                  ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order; each is given out when the one behind it has come."""
    held = None  # bucket, is a visitor, doc_id, text, signatures
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            out = []
            for bucket, visitor, doc, text in zip(
                    *(c.to_pylist() for c in batch.slice(at, 256).columns)):
                text = text or ""
                mine = signatures(text)
                if held and held[0] == bucket and not held[1]:
                    changed = edited(held[3], text)
                    other = signatures(changed)
                    out.append({
                        "doc_id": held[2], "n_chars": len(held[3]),
                        "edited_sha256": hashlib.sha256(
                            changed.encode("utf-8", "surrogatepass")).hexdigest(),
                        "fingerprint": pack(held[4]), "edited_fingerprint": pack(other),
                        "near_edited": likeness(held[4], other),
                        "near_next": likeness(held[4], mine)})
                held = (bucket, visitor, doc, text, mine)
            yield pa.RecordBatch.from_pylist(out, _OUT)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and two likenesses.

    The following document is the next in descending doc_id (nulls last, equal ids by text), and
    the first one behind the last. Documents are dealt to ranges of doc_id, and the first of each
    range visits the range above it, so texts are shuffled once and no task sees the whole order.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = texts.select(F.percentile_approx("doc_id", [k / n for k in range(1, n)] or [1.0], 10 * n)
                        .alias("cuts")).first()["cuts"] or []
    bounds = np.unique(np.array(cuts, np.int64))  # fewer than partitions

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            found = np.searchsorted(bounds, ids.fill_null(0).to_numpy(zero_copy_only=False)) + 1
            found[ids.is_null().to_numpy(zero_copy_only=False)] = 0
            yield batch.append_column("bucket", pa.array(found, pa.int64()))

    dealt = texts.mapInArrow(deal, "doc_id long, text string, bucket long")
    firsts = [(r["bucket"], r["first"]) for r in
              texts.select("doc_id").mapInArrow(deal, "doc_id long, bucket long").groupBy("bucket")
              .agg(F.max("doc_id").alias("first")).orderBy("bucket").collect()]
    visits = spark.createDataFrame(
        [(first, firsts[(k + 1) % len(firsts)][0]) for k, (_, first) in enumerate(firsts)],
        "first long, above long")  # a row for each range
    seen = dealt.join(F.broadcast(visits), F.col("doc_id").eqNullSafe(F.col("first")), "left")
    copies = F.array_compact(F.array(
        F.struct("bucket", F.lit(False).alias("visitor")),
        F.when(F.col("above").isNotNull(), F.struct(
            F.col("above").alias("bucket"), F.lit(True).alias("visitor")))))
    return (seen.select("doc_id", "text", F.explode(copies).alias("to"))
            .select("to.bucket", "to.visitor", "doc_id", "text")
            .repartition(n, "bucket")
            .sortWithinPartitions("bucket", "visitor", F.desc_nulls_last("doc_id"), "text")
            .mapInArrow(_compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint "
                                  "string, edited_fingerprint string, near_edited double, "
                                  "near_next double"))


def near(spark: SparkSession, fingerprinted: DataFrame, *, percent: int = 80) -> DataFrame:
    """doc_id, class_id: documents whose fingerprints are alike, by chains of such likeness."""
    from cardsentry.llm import ngram_join
    from cardsentry.session import new_folder, written

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [unpack(x).astype(np.uint64) * _K for x in batch.column(0).to_pylist()]
            found = [np.sort(x) for x in found if len(x)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([ngram_join._set_id(x) for x in found], pa.int64()),
                 pa.array([len(x) for x in found], pa.int64()),
                 pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64())),
                 pa.array([np.bincount(x >> np.uint64(60), minlength=16) for x in found],
                          pa.list_(pa.int64()))], ["set_id", "size", "hashes", "spread"])

    different = fingerprinted.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    held = written(different, new_folder(spark, "fingerprints"))
    held_sets = written(held.select("fingerprint").mapInArrow(
        sets, "set_id long, size long, hashes array<long>, spread array<long>"),
        new_folder(spark, "sets"))
    labels = ngram_join.linked(spark, held_sets, percent)

    @F.pandas_udf("long")
    def set_id(values: pd.Series) -> pd.Series:
        return values.map(lambda x: ngram_join._set_id(np.sort(unpack(x).astype(np.uint64) * _K)))

    named = held.withColumn("set_id", set_id("fingerprint")).join(labels, "set_id", "left") \
        .withColumn("label", F.coalesce("label", "set_id"))
    classes = named.groupBy("label").agg(F.min("least").alias("class_id"))
    return fingerprinted.join(named.join(classes, "label").select("fingerprint", "class_id"),
                              "fingerprint").select("doc_id", "class_id")
