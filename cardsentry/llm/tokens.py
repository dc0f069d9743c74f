"""Token ids of whole texts, with the units of a text looked up once per worker.

The pre-tokenizer of the byte-level vocabulary ends a piece, in every text, before a space that
is followed by a character other than white space, and around a line feed that has no white space
beside it. So a text is cut there, and the ids of the units, one after another, are the ids of
the text. Units repeat, so their ids are kept.
"""

from __future__ import annotations

import re
import struct
from codecs import charmap_decode
from functools import lru_cache

import numpy as np

# Characters whose class (letter, digit, sign, white space) all Unicode versions agree on.
_PLAIN = re.compile(r"[ -~\nÀ-ÖØ-öø-ɏ]*").fullmatch
_ODD_SPACE = re.compile(r" (?!\S)").search
_UNITS = re.compile(r" (?=\S)").split


def _lines(text: str) -> list[str]:
    """The lines of a text, or the text alone if a line feed of it has white space beside it."""
    lines = text.split("\n")
    if len(lines) > 1 and (not all(lines) or any([x[-1].isspace() for x in lines[:-1]])
                           or any([x[0].isspace() for x in lines[1:]])):
        return [text]
    return lines


def _byte_letters() -> dict[int, str]:
    """The printable stand-ins that a byte-level vocabulary has for the 256 bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class _Bare(dict):
    """Unit at the start of a line to its ids, as little-endian bytes."""

    def __init__(self, path: str, most: int):
        super().__init__()
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.merge = self.tokenizer.model.tokenize
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 65536 else np.dtype("<u4")
        self.pack = f"<%d{'H' if self.dtype.itemsize == 2 else 'I'}"
        self.packs = [struct.Struct(self.pack % n).pack for n in range(64)]
        self.pieces = regex.compile(public_tokenizers.PATTERN).findall
        letters = _byte_letters()
        self.letters = "".join([letters[b] for b in range(256)])
        self.most = most

    def word(self, unit: str) -> bytes:
        """A unit that is one piece: only the merges are left to do."""
        shown, _ = charmap_decode(unit.encode(), "strict", self.letters)
        ids = [token.id for token in self.merge(shown)]
        return self.packs[len(ids)](*ids) if len(ids) < 64 else struct.pack(self.pack % len(ids), *ids)

    def encode(self, unit: str) -> bytes:
        pieces = self.pieces(unit) if _PLAIN(unit) else ()
        if len(pieces) > 1:
            return self.encode(pieces[0]) + b"".join([self[piece] for piece in pieces[1:]])
        if pieces:
            return self.word(unit)
        ids = self.tokenizer.encode(unit, add_special_tokens=False).ids
        return struct.pack(self.pack % len(ids), *ids)

    def __missing__(self, unit: str) -> bytes:
        ids = self.encode(unit)
        if len(self) >= self.most:
            self.clear()
        self[unit] = ids
        return ids


class UnitIds(dict):
    """Unit after a space (the key is without it) to the ids of both.

    Each of the two tables is emptied when it holds ``most`` units.
    """

    def __init__(self, path: str, most: int = 1_200_000):
        super().__init__()
        self.bare = _Bare(path, most // 4)
        self.tokenizer, self.dtype, self.most = self.bare.tokenizer, self.bare.dtype, most

    def __missing__(self, unit: str) -> bytes:
        if unit[-1:] in ",." and unit[:-1].isalpha() and _PLAIN(unit):
            ids = self[unit[:-1]] + self.bare[unit[-1]]  # most bare words are known by then
        elif unit.isalpha() and _PLAIN(unit):
            ids = self.bare.word(" " + unit)
        else:
            ids = self.bare.encode(" " + unit)
        if len(self) >= self.most:
            self.clear()
        self[unit] = ids
        return ids

    def _line(self, text: str) -> bytes:
        first, *rest = _UNITS(text) if _ODD_SPACE(text) else text.split(" ")
        return (self.bare[first] if first else b"") + b"".join(map(self.__getitem__, rest))

    def ids(self, text: str | None) -> np.ndarray:
        """Ids of one whole text; none for a null or empty one."""
        if not text:
            return np.empty(0, self.dtype)
        return np.frombuffer(self.bare["\n"].join(map(self._line, _lines(text))), self.dtype)


@lru_cache(maxsize=2)
def unit_ids(path: str) -> UnitIds:
    """One per worker process and vocabulary file."""
    return UnitIds(path)
