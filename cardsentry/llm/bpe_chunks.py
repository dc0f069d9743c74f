"""BPE ids of whole texts by content-defined chunks, and the texts that ids decode to.

A text is cut where a rolling hash over its last 32 characters says so, wherever that is: copies
of a passage are cut at the same places in every document, so a worker encodes a chunk once and
keeps its ids. The ids at the two ends of a chunk may be wrong, since a cut may run through a
word. So a join of two chunks is repaired: the text around it is encoded anew, from a window that
grows over further chunks until both of its ends lie at white space. There the ids of the chunks
and those of the whole text agree exactly: the normalizer of the vocabulary composes no character
across a blank, and its pre-tokenizer drops blanks and looks at nothing beyond them.

Null and empty texts have no ids, and decode to the empty text. Strings of special tokens in a
text become those tokens, as the tokenizer does it unless told otherwise. Rows that repeat a
doc_id, or have none, are encoded each for itself; an empty table gives no row. Only ``doc_id``
and ``text`` (``ids`` for decoding) are read; other columns may have any name.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsentry.llm.tokens import _byte_letters

CHUNK_BITS = 9  # a chunk has about 512 characters
_BLOCK = 1 << 20  # characters hashed at once
_ROWS = 512  # texts that a task holds as Python objects at once
_LONGEST = 64  # longer units are not kept
_BLANK = re.compile(r"[ \t\n\r]")
_BLANKS = re.compile(r"[ \t\n\r]+")
# Letters, digits and signs that are so in every Unicode version, and that normalizing only lowers.
_PLAIN = re.compile(r"[ -~\nÀ-ÖØ-öø-įı-ɏ]*").fullmatch
_LETTERS = re.compile(r"[a-zß-öø-ɏ]+").fullmatch
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ɏ]+|[0-9]|[^\sa-zß-öø-ɏ0-9]+").findall


def cuts(text: str) -> np.ndarray:
    """Places inside a text where one chunk ends and the next starts; they hang on the 32
    characters before them alone."""
    found = []
    for at in range(0, len(text), _BLOCK):
        before = min(at, 31)
        points = np.frombuffer(text[at - before:at + _BLOCK].encode("utf-32-le", "surrogatepass"),
                               "<u4")
        h = points * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        for k in (1, 2, 4, 8, 16):  # after this, h sums 2 * k characters, the last one unshifted
            shifted = h[:-k] << np.uint32(k)
            h[k:] += shifted
        found.append(np.flatnonzero(h[before:] >> np.uint32(32 - CHUNK_BITS) == 0) + at + 1)
    places = np.concatenate(found) if found else np.empty(0, np.int64)
    return places[places < len(text)]


class _Units(dict):
    """Text between blanks to its ids, as little-endian bytes: context plays no part there."""

    def __init__(self, path: str, most: int):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if self.size <= 65536 else np.dtype("<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.merge = self.tokenizer.model.tokenize
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.most = most

    def _pack(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def encode(self, unit: str) -> bytes:
        if len(unit) > _LONGEST or not _PLAIN(unit) or "|" in unit and any(
                s in unit for s in self.special):
            return self._pack(self.tokenizer.encode(unit, add_special_tokens=False).ids)
        low = unit.lower()
        words = (low,) if _LETTERS(low) else _WORDS(low)
        if len(words) > 1 or low != unit:
            return b"".join(map(self.__getitem__, words))
        # One word of the pre-tokenizer: only the merges are left to do.
        shown = low if low.isascii() else "".join([self.letters[b] for b in low.encode()])
        return self._pack([t.id for t in self.merge(shown)])

    def __missing__(self, unit: str) -> bytes:
        ids = self.encode(unit)
        if len(unit) <= _LONGEST:
            if len(self) >= self.most:
                self.clear()
            self[unit] = ids
        return ids


class Chunks(dict):
    """Chunk to (text before its first blank, ids of its whole units, text after its last blank);
    a chunk without a blank has None as its ids. Emptied when it holds ``most`` chunks."""

    def __init__(self, path: str, most: int = 40_000):
        super().__init__()
        self.units, self.most = _Units(path, 1_200_000), most

    def __missing__(self, chunk: str):
        parts = chunk.split() if _PLAIN(chunk) else _BLANKS.split(chunk)
        first = last = ""
        if not _BLANK.search(chunk):
            made = (chunk, None, "")
        else:
            parts = [p for p in parts if p]
            if parts and chunk[0] not in " \t\n\r":
                first = parts.pop(0)
            if parts and chunk[-1] not in " \t\n\r":
                last = parts.pop()
            made = (first, b"".join(map(self.units.__getitem__, parts)), last)
        if len(self) >= self.most:
            self.clear()
        self[chunk] = made
        return made

    def ids(self, text: str | None) -> np.ndarray:
        """Ids of one whole text."""
        if not text:
            return np.empty(0, self.units.dtype)
        ends = cuts(text).tolist() + [len(text)]
        out: list[bytes] = []
        window: list[str] = []  # text around joins that has not met a blank yet
        start = 0
        for end in ends:
            first, whole, last = self[text[start:end]]
            start = end
            if first:
                window.append(first)
            if whole is None:
                continue
            if window:
                out.append(self.units["".join(window)])
            out.append(whole)
            window = [last] if last else []
        if window:
            out.append(self.units["".join(window)])
        return np.frombuffer(b"".join(out), self.units.dtype)


@lru_cache(maxsize=2)
def chunks(path: str) -> Chunks:
    """One per worker process and vocabulary file."""
    return Chunks(path)


@lru_cache(maxsize=2)
def token_texts(path: str) -> tuple[list[str], str]:
    """What each id stands for, and what stands between two of them: a vocabulary without a
    decoder puts a blank there."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    if tokenizer.decoder is not None:
        raise ValueError("vocabularies with a decoder of their own are not covered")
    size = tokenizer.get_vocab_size(with_added_tokens=True)
    return [tokenizer.id_to_token(k) or "" for k in range(size)], " "


def encode(docs: DataFrame, *, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian, two bytes each for up to 65,536 ids, else four)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = chunks(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                rows = batch.slice(at, _ROWS)
                found = [table.ids(text) for text in rows.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array([len(x) for x in found], pa.int64()),
                     pa.array([x.tobytes() for x in found], pa.binary())],
                    ["doc_id", "n_tokens", "ids"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, *, vocabulary: str, keep_text: bool = True) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the decoded text, and the text itself.

    ``ids_sha256`` is the digest of the ids in decimal with a blank between them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = chunks(vocabulary).units.dtype
        shown, between = token_texts(vocabulary)
        decimal = [str(k) for k in range(len(shown))]

        def digest(text: str) -> str:
            return hashlib.sha256(text.encode()).hexdigest()

        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                rows = batch.slice(at, _ROWS)
                said, texts = [], []
                for ids in rows.column(2):
                    ids = np.frombuffer(ids.as_buffer(), dtype).tolist()
                    said.append(digest(" ".join(map(decimal.__getitem__, ids))))
                    text = between.join(map(shown.__getitem__, ids))
                    texts.append((digest(text), text if keep_text else None))
                columns = [rows.column(0), rows.column(1), pa.array(said),
                           pa.array([t[0] for t in texts])]
                if keep_text:
                    columns.append(pa.array([t[1] for t in texts]))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "decoded"][:4 + keep_text]
    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(
        run, ddl + ", decoded string" * keep_text)
