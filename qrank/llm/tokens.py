"""Encoding of whole texts with a public tokenizer, fast and exactly.

A byte-level BPE splits a text into pieces by a public pattern and merges
within each piece.  Words recur, so each Python worker remembers the ids of
words and of pieces (bounded, least recently used half first) and asks the
library's BPE model for new pieces alone; that also skips its slow splitting.
Texts whose pieces depend on longer runs of white space, or with characters
outside the ranges below, or with the string of an added token, are encoded whole
by the library.  The result is the library's own for every text, with its default
settings: such a string becomes the token's id (tested).
"""

from __future__ import annotations

import re
import sys
import unicodedata
from array import array

import numpy as np

from .common import worker_cache

#: Characters whose class (letter, number, space, other) no Unicode version has changed.
LAST = 0x24F
PLAIN = re.compile(f"[\n -~¡-{chr(LAST)}]*")
#: White space whose pieces depend on what stands around it: inside a text, and at its end.
RUNS, END_RUNS = ("  ", " \n", "\n\n\n", "\n\n "), ("\n\n", " ")
#: Entries that each half of a memory of words, or of pieces, holds before the older half is forgotten.
CACHE_WORDS, CACHE_PIECES = 250_000, 160_000


def simple(text: str) -> bool:
    """Whether the ids of a text are those of its lines' words in a row."""
    return not (any(x in text for x in RUNS) or text.endswith(END_RUNS)) and PLAIN.fullmatch(text) is not None


def _class(kind: str) -> str:
    """Regular-expression ranges of the plain characters of a Unicode main category."""
    return "".join(re.escape(chr(c)) for c in range(33, LAST + 1) if unicodedata.category(chr(c))[0] == kind)


def piece_pattern() -> re.Pattern:
    """The public byte-level splitting pattern, for plain texts without white-space runs."""
    letter, number = _class("L"), _class("N")
    return re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{number}]+| ?[^\s{letter}{number}]+|\s")


def byte_letters() -> dict[int, str]:
    """The public byte-level alphabet: printable bytes stand for themselves,
    the others for the characters from U+0100 on, in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Memory(dict):
    """Ids by word (or piece), made when first asked for; the half not used lately is forgotten."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.make(word)
        self[word] = ids
        return ids

    def trim(self) -> None:
        if len(self) > self.most:
            self.older = dict(self)
            self.clear()


class Encoder:
    """``encode(texts)`` gives each text's ids as little-endian uint32 bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        # a text that holds the string of an added token goes to the library whole, which finds the token in it
        self.added = tuple(t.content for t in self.tok.get_added_tokens_decoder().values())
        self.model = self.tok.model
        self.by_word = (type(self.tok.pre_tokenizer).__name__ == "ByteLevel" and type(self.model).__name__ == "BPE"
                        and self.tok.normalizer is None and self.tok.post_processor is None)
        self.split, self.letters = piece_pattern().findall, byte_letters()
        self.pieces = Memory(self._piece, CACHE_PIECES)
        self.first = Memory(self._word, CACHE_PIECES)  # words at the start of a line
        self.later = Memory(lambda w: self._word(" " + w), CACHE_WORDS)  # words behind a space
        self.newline = self._piece("\n") if self.by_word else b""

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes()
                for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _piece(self, piece: str) -> bytes:
        found = self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))
        ids = array("I", [t.id for t in found])
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _word(self, word: str) -> bytes:
        cut = self.split(word)
        return self.pieces[cut[0]] if len(cut) == 1 else b"".join([self.pieces[p] for p in cut])

    def _lines(self, text: str) -> bytes:
        out, first, later = [], self.first, self.later.__getitem__
        for line in text.split("\n"):
            words = iter(line.split(" "))
            out.append(first[next(words)] + b"".join(map(later, words)))
        return self.newline.join(out)

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return self._whole(texts)
        for memory in (self.first, self.later, self.pieces):
            memory.trim()
        out = [self._lines(t) if simple(t) and not any(x in t for x in self.added) else None for t in texts]
        if None in out:
            direct = iter(self._whole([t for t, x in zip(texts, out) if x is None]))
            out = [next(direct) if x is None else x for x in out]
        return out


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    held = worker_cache().setdefault("encoders", {})
    if path not in held:
        held[path] = Encoder(path)
    return held[path]
