"""Toxicity by non-negative positive-unlabelled learning.

Learns from confirmed toxic texts (P) and unlabelled ones (U), which hold toxic texts at the rate
of the class prior. The risk of a classifier g with logistic loss l is

    prior * E_P[l(g)] + max(0, E_U[l(-g)] - prior * E_P[l(-g)]),

whose second part, an unbiased estimate of the risk on clean texts, is kept from going below
zero: where a batch brings it there, the step goes up that part alone. The classifier is linear with weights
of at least zero, so words that say nothing weigh nothing and a long clean text does not drift.

Features are the words of a text and their beginnings of 3 to 8 letters, lower-cased, each
counted once; those far more frequent in P than in U are weighed. The prior is the share of toxic
rows among all labelled rows that may be learned from. The bias is set last, so that about the
prior's share of U scores above one half. The fit reads at most about ``positives`` toxic and ``unlabelled`` other texts, drawn by a
hash of doc_id, and weighs at most ``features`` features; scoring reads every text whole.

A null or empty text has no feature and gets the score of the bias alone. Without a toxic row
every score is 0. Labels may repeat a doc_id: a document is toxic if one of its labels says so.
Repeated documents are scored each for itself. Only ``doc_id``, ``text`` and ``toxic`` are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.session import new_folder, written

_WORDS = re.compile(r"[^\W\d_]+").findall
_ROWS = 512
STEMS = (3, 4, 5, 6, 7, 8)


def features_of(word: str) -> list[str]:
    """A word, marked as whole, and its beginnings."""
    return [f"{word}$", *(word[:n] for n in STEMS if len(word) >= n)]


def words_of(text: str | None) -> set[str]:
    return set(_WORDS(text.lower())) if text else set()


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]  # at most ``features`` of them
    bias: float


def train(rows: list[np.ndarray], positive: np.ndarray, size: int, prior: float, *,
          rounds: int = 60, rate: float = 0.1, shrink: float = 3e-3, batch: int = 512,
          seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias from the feature numbers of each text. ``positive`` marks P; the rest is U."""
    random = np.random.default_rng(seed)
    at_p, at_u = np.flatnonzero(positive), np.flatnonzero(~positive)
    lengths = np.array([len(r) for r in rows])
    ends = np.cumsum(lengths)
    flat = np.concatenate(rows) if len(rows) else np.zeros(0, np.int64)
    weights, bias = np.zeros(size), float(np.log(prior / (1 - prior)))
    moments = [np.zeros(size + 1), np.zeros(size + 1)]
    steps = max(1, len(at_u) // batch)
    done = 0
    for _ in range(rounds):
        shuffled_u = random.permutation(at_u)
        for k in range(steps):
            u = shuffled_u[k * batch:(k + 1) * batch]
            p = at_p[random.integers(0, len(at_p), min(len(at_p), batch))]
            grad = np.zeros(size + 1)
            parts = []
            for chosen in (p, u):
                n = lengths[chosen]
                places = np.repeat(ends[chosen] - np.cumsum(n), n) + np.arange(n.sum())
                owner = np.repeat(np.arange(len(chosen)), n)
                z = bias + np.bincount(owner, weights[flat[places]], len(chosen))
                parts.append((1 / (1 + np.exp(-z)), owner, flat[places], z))
            (sp, op, fp, zp), (su, ou, fu, zu) = parts
            clean = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()

            def add(slope, owner, at, scale, grad=grad):
                grad[:size] += np.bincount(at, slope[owner], size) * scale / len(slope)
                grad[size] += slope.mean() * scale

            if clean >= 0:
                add(sp - 1, op, fp, prior)  # l(g) on P
                add(su, ou, fu, 1)  # l(-g) on U
                add(sp, op, fp, -prior)  # less its share of P
            else:
                add(su, ou, fu, -1)
                add(sp, op, fp, prior)
            done += 1
            moments[0] = 0.9 * moments[0] + 0.1 * grad
            moments[1] = 0.999 * moments[1] + 0.001 * grad ** 2
            move = rate * (moments[0] / (1 - 0.9 ** done)) / (
                np.sqrt(moments[1] / (1 - 0.999 ** done)) + 1e-8)
            weights = np.maximum(0, weights - move[:size] - shrink)
            bias -= move[size]
    # The share of unlabelled texts above one half becomes nearly the prior, unless that would
    # reach into the bulk of them.
    scores = bias + np.array([weights[row].sum() for at, row in enumerate(rows) if not positive[at]])
    if len(scores):
        bias -= max(np.quantile(scores, 1 - 0.95 * prior), 0.4 * min(0, np.median(scores))) - 1e-6
    return weights, float(bias)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of each kind a task has seen each feature."""
    seen = {True: Counter(), False: Counter()}
    for batch in batches:
        for positive, text in zip(*(c.to_pylist() for c in batch.columns)):
            seen[positive].update({f for w in words_of(text) for f in features_of(w)})
    names = [f for f, n in seen[True].items()] + [f for f in seen[False] if f not in seen[True]]
    yield pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), *(pa.array([seen[k][f] for f in names], pa.int64())
                                         for k in (True, False))], ["feature", "p", "u"])


def _present(wanted: dict[str, int]):
    """The numbers of the wanted features of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted({wanted[f] for w in words_of(text) for f in features_of(w) if f in wanted})
                     for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["positive", "found"])
    return run


def learn(spark: SparkSession, docs: DataFrame, labels: DataFrame, usable: Column, *,
          positives: int = 2000, unlabelled: int = 8000, features: int = 5000,
          least: int = 4) -> Model | None:
    """Fits the classifier; ``usable`` says of a doc_id whether it may be learned from."""
    marked = labels.filter(usable & F.col("toxic").isNotNull()).groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("toxic"))
    sums = marked.agg(F.count("*").alias("n"), F.sum("toxic").alias("p")).first()
    if not sums["p"]:
        return None
    prior = min(max(sums["p"] / sums["n"], 0.001), 0.5)

    def drawn(n: int, bound: int) -> Column:
        return F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1e6 * min(1, bound / max(1, n)))

    toxic = marked.filter((F.col("toxic") == 1) & drawn(sums["p"], positives)).select(
        F.col("doc_id").alias("p_id"))  # about ``positives`` ids
    texts = docs.filter(usable).select(F.col("doc_id").alias("doc_id"),
                                       F.col("text").cast("string").alias("text"))
    n_texts = texts.select("doc_id").count()
    sample = written(
        texts.join(F.broadcast(toxic), F.col("doc_id") == F.col("p_id"), "left")
        .withColumn("positive", F.col("p_id").isNotNull())
        .filter(F.col("positive") | drawn(n_texts, unlabelled)).select("positive", "text"),
        new_folder(spark, "toxic-sample"))
    n_p = sample.filter("positive").count()
    n_u = max(1, sample.count() - n_p)
    if not n_p:
        return None
    counted = (sample.select("positive", "text").mapInArrow(_counts, "feature string, p long, u long")
               .groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u")))
    # Toxic texts are the prior's share of U, so a feature of theirs is over-represented in P:
    # wanted are those far above what U alone would give, by ratio and by standard errors.
    usual = n_p * (F.col("u") + 1) / n_u
    error = (F.col("p") - usual) / F.sqrt(usual + 1)
    chosen = (counted.filter((F.col("p") >= least) & (F.col("p") > 3 * usual) & (error > 5))
              .orderBy(F.desc(error), "feature").limit(features))
    names = sorted(row["feature"] for row in chosen.select("feature").collect())
    wanted = {name: k for k, name in enumerate(names)}
    table = sample.mapInArrow(_present(wanted), "positive boolean, found array<long>").collect()
    table.sort(key=lambda row: (row["positive"], row["found"]))  # the same fit on every run
    weights, bias = train([np.array(r["found"], np.int64) for r in table],
                          np.array([r["positive"] for r in table], bool), len(names), prior)
    return Model({n: float(w) for n, w in zip(names, weights) if w > 0}, bias)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """All columns of the rows and ``score``, from 0 to 1."""
    schema = docs.drop("score").schema
    if model is None:
        return docs.drop("score").withColumn("score", F.lit(0.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, tuple[str, ...]] = {}  # a word's weighed features; most have none
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            scores = []
            for at in range(0, batch.num_rows, _ROWS):
                for text in texts.slice(at, _ROWS).to_pylist():
                    found: set[str] = set()
                    for word in words_of(text):
                        hits = kept.get(word)
                        if hits is None:
                            if len(kept) >= 500_000:
                                kept.clear()
                            hits = tuple(f for f in features_of(word) if f in model.weights)
                            kept[word] = hits
                        if hits:
                            found.update(hits)
                    z = model.bias + sum(sorted(model.weights[f] for f in found))
                    scores.append(float(1 / (1 + np.exp(-np.clip(z, -60, 60)))))
            yield batch.append_column("score", pa.array(scores, pa.float64()))

    return docs.drop("score").mapInArrow(run, schema.add("score", "double"))
