"""Language of a text by piece unigrams, summed over all segmentations of its words.

Each language has a probability for every piece of a fixed public vocabulary. A word (a run of
letters, lower-cased, with the word mark in front) has, in each language, the probability that
the forward algorithm sums over all ways to cut it into pieces; a letter no piece covers costs
``UNKNOWN``. A text's language is the one that gives its words the largest product, its score the
posterior with equal priors.

Probabilities are fitted by expectation and maximisation on word counts: at most about
``sample`` documents per language, drawn by a hash of doc_id, and of their words the ``words``
most frequent. Counts come from the cluster, the fit runs on these bounded tables. A run of
letters above ``LONGEST`` is cut there. Languages are few: their names are collected.

Texts that are null or have no letter get ``und`` and score 0, and so do all texts when nothing
could be learned (an empty table, or no language known). Ties go to the first name in order.
Repeated rows are scored each for itself. Only ``doc_id``, ``text`` and ``lang`` are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LONGEST = 40
UNKNOWN = 1e-6
MARK = "▁"  # the vocabulary's sign for the start of a word
_WORDS = re.compile(r"[^\W\d_]+").findall
_ROWS = 512


def _step(hashes: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Hashes of strings that are one letter longer."""
    hashes = (hashes ^ letters) * np.uint64(0x9E3779B97F4A7C15)
    return hashes ^ hashes >> np.uint64(29)


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    return flat.reshape(len(words), -1).astype(np.uint64)


@lru_cache(maxsize=2)
def _pieces(vocabulary: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes of the lower-case letter pieces of a SentencePiece model and of their beginnings,
    sorted; the piece's number or -2 for a mere beginning; and how many pieces there are."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    names = (model.id_to_piece(k) for k in range(model.get_piece_size()))
    kept = [p for p in names if p.lstrip(MARK).isalpha() and p == p.lower()]
    known = {p[:n]: -2 for p in kept for n in range(1, len(p))} | {p: k for k, p in enumerate(kept)}
    by_length: dict[int, list[str]] = {}
    for name in known:
        by_length.setdefault(len(name), []).append(name)
    hashes, numbers = [], []
    for length, group in by_length.items():
        codes, found = _codes(group), np.zeros(len(group), np.uint64)
        for k in range(length):
            found = _step(found, codes[:, k])
        hashes.append(found)
        numbers.append(np.array([known[name] for name in group]))
    flat, values = np.concatenate(hashes), np.concatenate(numbers)
    order = np.argsort(flat)
    return flat[order], values[order], len(kept)


@dataclass
class Lattice:
    """Pieces of many words, by end: word, start, end, piece (-1: a letter without a piece)."""

    word: np.ndarray
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    length: np.ndarray  # of each word


def lattice(words: list[str], vocabulary: str) -> Lattice:
    """All pieces of all words, found for words of one length at once."""
    known, numbers, _ = _pieces(vocabulary)
    lengths = np.array([len(w) + 1 for w in words], np.int64)
    edges = []
    for n in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == n)
        codes = _codes([MARK + words[k] for k in rows])
        for start in range(n):
            alive, hashes = np.arange(len(rows)), np.zeros(len(rows), np.uint64)
            for end in range(start + 1, n + 1):
                hashes = _step(hashes, codes[alive, end - 1])
                place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = known[place] == hashes
                piece = np.where(hit, numbers[place], -3)
                if end == start + 1:  # a letter without a piece of its own can stand alone
                    piece = np.where(piece < 0, -1, piece)
                    taken = np.ones(len(piece), bool)
                else:
                    taken = piece >= 0
                count = int(taken.sum())
                edges.append(np.stack([rows[alive[taken]], np.full(count, start),
                                       np.full(count, end), piece[taken]]))
                alive, hashes = alive[hit], hashes[hit]
                if not len(alive):
                    break
    table = np.concatenate(edges, axis=1) if edges else np.zeros((4, 0), np.int64)
    table = table[:, np.lexsort((table[1], table[0], table[2]))]
    return Lattice(*table, lengths)


def _weights(found: Lattice, probabilities: np.ndarray) -> np.ndarray:
    weights = probabilities[found.piece]
    weights[found.piece < 0] = UNKNOWN
    return weights


def forward(found: Lattice, probabilities: np.ndarray) -> np.ndarray:
    """Sums over all segmentations of each word's prefixes: [word, end, language]."""
    n, most = len(found.length), int(found.length.max(initial=0))
    sums = np.zeros((n, most + 1, probabilities.shape[1]))
    sums[:, 0] = 1
    weights = _weights(found, probabilities)
    for end in range(1, most + 1):
        lo, hi = np.searchsorted(found.end, [end, end + 1])
        if lo == hi:
            continue
        word = found.word[lo:hi]
        firsts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        ways = sums[word, found.start[lo:hi]] * weights[lo:hi]
        sums[word[firsts], end] = np.add.reduceat(ways, firsts, axis=0)
    return sums


def word_scores(words: list[str], vocabulary: str, probabilities: np.ndarray) -> np.ndarray:
    """Log-probability of each word in each language."""
    if not words:
        return np.zeros((0, probabilities.shape[1]))
    found = lattice(words, vocabulary)
    sums = forward(found, probabilities)
    return np.log(np.maximum(sums[np.arange(len(words)), found.length], 1e-300))


def fit(words: list[str], counts: np.ndarray, vocabulary: str, rounds: int = 5) -> np.ndarray:
    """Piece probabilities of one language from word counts."""
    size = _pieces(vocabulary)[2]
    probability = np.full((size, 1), 1 / size)
    if not words:
        return probability[:, 0]
    found = lattice(words, vocabulary)
    for _ in range(rounds):
        ahead = forward(found, probability)[:, :, 0]
        weights = _weights(found, probability)[:, 0]
        behind = np.zeros_like(ahead)
        behind[np.arange(len(words)), found.length] = 1
        order = np.argsort(-found.start, kind="stable")
        bounds = np.searchsorted(-found.start[order], -np.arange(ahead.shape[1] + 1))
        for start in range(ahead.shape[1] - 1, -1, -1):  # all that start later are done
            these = order[bounds[start]:] if start == 0 else order[bounds[start]:bounds[start - 1]]
            ways = weights[these] * behind[found.word[these], found.end[these]]
            np.add.at(behind[:, start], found.word[these], ways)
        whole = ahead[np.arange(len(words)), found.length]
        use = ahead[found.word, found.start] * weights * behind[found.word, found.end]
        use *= (counts / np.maximum(whole, 1e-300))[found.word]
        known = found.piece >= 0
        expected = np.bincount(found.piece[known], use[known], size) + 0.01
        probability = (expected / expected.sum())[:, None]
    return probability[:, 0]


def letters(text: str | None) -> list[str]:
    """Runs of letters, lower-cased, none longer than ``LONGEST``."""
    found = _WORDS(text.lower()) if text else []
    if found and max(map(len, found)) > LONGEST:
        found = [w[k:k + LONGEST] for w in found for k in range(0, len(w), LONGEST)]
    return found


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}

    def out() -> pa.RecordBatch:
        rows = [(lang, w, n) for lang, c in counts.items() for w, n in c.items()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
            list(zip(*rows)) or [[], [], []], (pa.string(), pa.string(), pa.int64()))],
            ["lang", "word", "n"])

    for batch in batches:
        for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
            counts.setdefault(lang, Counter()).update(w for w in letters(text) if w.isalpha())
        if sum(map(len, counts.values())) > 500_000:
            yield out()
            counts.clear()
    yield out()


@dataclass
class Model:
    names: list[str]
    probabilities: np.ndarray  # [piece, language], bounded by vocabulary and languages
    vocabulary: str


def learn(docs: DataFrame, usable: Column, *, vocabulary: str, sample: int = 2000,
          words: int = 20_000) -> Model:
    """Fits the languages named in the rows that may be learned from."""
    known = docs.filter(usable & F.col("lang").isNotNull()).select(
        F.col("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    names = sorted(sizes)
    if not names:
        return Model([], np.zeros((_pieces(vocabulary)[2], 0)), vocabulary)
    share = F.create_map(*(F.lit(x) for lang in names
                           for x in (lang, int(1e6 * min(1.0, sample / sizes[lang])))))
    drawn = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share[F.col("lang")])
    counted = (drawn.select("lang", "text").mapInArrow(_count_words, "lang string, word string, n long")
               .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = counted.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= words)
    table: dict[str, list] = {lang: [] for lang in names}
    for row in top.orderBy("lang", "place").collect():  # ``words`` rows per language at most
        table[row["lang"]].append((row["word"], row["n"]))
    columns = [fit([w for w, _ in table[lang]], np.array([n for _, n in table[lang]], float),
                   vocabulary) for lang in names]
    return Model(names, np.column_stack(columns), vocabulary)


class _WordTable(dict):
    """Scores of words seen by a worker, emptied when ``most`` are kept."""

    def __init__(self, model: Model, most: int = 800_000):
        super().__init__()
        self.model, self.most = model, most
        self.scores = np.zeros((0, len(model.names)), np.float32)
        self.is_word = np.zeros(0, bool)

    def add(self, texts: list[list[str]]) -> None:
        if len(self) >= self.most:
            self.clear()
            self.scores, self.is_word = self.scores[:0], self.is_word[:0]
        new = list(set().union(*texts).difference(self))
        spelled = np.array([any(map(str.isalpha, w)) for w in new], bool)
        scores = word_scores(new, self.model.vocabulary, self.model.probabilities)
        scores[~spelled] = 0
        self.update((w, k) for k, w in enumerate(new, len(self.scores)))
        self.scores = np.concatenate([self.scores, scores.astype(np.float32)])
        self.is_word = np.concatenate([self.is_word, spelled])


_TABLES: dict[int, _WordTable] = {}  # a worker keeps the words of the model it uses


def _word_table(model: Model) -> _WordTable:
    key = hash((model.vocabulary, *model.names, model.probabilities.tobytes()))
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = _WordTable(model)
    return _TABLES[key]


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _word_table(model)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                rows = batch.slice(at, _ROWS)
                texts = [letters(text) for text in rows.column(1).to_pylist()]
                table.add(texts)
                langs, scores = [], []
                for words in texts:
                    places = np.fromiter(map(table.__getitem__, words), np.int64, len(words))
                    if not model.names or not table.is_word[places].any():
                        langs.append("und")
                        scores.append(0.0)
                        continue
                    total = table.scores[places].sum(axis=0, dtype=np.float64)
                    odds = np.exp(total - total.max())
                    langs.append(model.names[int(odds.argmax())])
                    scores.append(float(odds.max() / odds.sum()))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, lang_pred string, score double")
