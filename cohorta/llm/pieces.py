"""Pieces of texts that a tokenizer merges each on their own.

Texts of plain characters are cut by a fast pattern that does the same there; the others, few in
most corpora, by the tokenizer's pattern itself. Equal pieces of a batch become one entry of a dictionary.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from cohorta.llm.bpe import Bpe, ragged
from cohorta.llm.common import travels

travels(__name__)

# The patterns of the two tokenizers.
WORD_PATTERN = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+""")
BYTE_PATTERN = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")

MARK = "\x00 "  # starts what stands for a special string; no piece starts so
CHUNK_BYTES = 4_000_000  # texts cut together

# The same on plain texts, for the faster module: letters and numbers of the first 256 characters.
_L, _N = "a-zA-Zªµº\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9²³¹¼-¾"
_PLAIN_WORDS = re.compile(rf"[{_L}]+|[{_N}]|[^\s{_L}{_N}]+")
_PLAIN_BYTES = re.compile(rf" ?(?:[{_L}]+|[{_N}]+|[^\s{_L}{_N}]+)|\s")

# What makes a text need the pattern itself: contractions, special strings, characters beyond the
# first 256 and white space on which the two modules may not agree.
_ODD = r"['\x00\x0b\x1c-\x1f\x{85}\x{a0}]|<\||[^\x00-\x{ff}]"


@dataclass
class Pieces:
    """``rows``: which texts; ``numbers``: the entry of each piece, text by text; ``counts`` per text."""

    rows: np.ndarray
    entries: pa.StringArray
    numbers: np.ndarray
    counts: np.ndarray
    plain: bool  # pieces and white space make the text again, letter by letter, but for the case


def lowered(text: str) -> str:
    """NFC and lower case letter by letter."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


@dataclass
class Cutter:
    """How one kind of tokenizer cuts a text."""

    pattern: regex.Pattern
    plain: re.Pattern
    odd: str
    change: Callable = str  # what happens to a text first

    def pieces(self, text: str, special: re.Pattern | None) -> list[str]:
        if special is None or "<|" not in text:
            return self.pattern.findall(self.change(text))
        found, at = [], 0
        for m in special.finditer(text):
            found += self.pattern.findall(self.change(text[at:m.start()]))
            found.append(MARK + m[0])
            at = m.end()
        return found + self.pattern.findall(self.change(text[at:]))

    def batch(self, texts: pa.Array, special: re.Pattern | None) -> Iterator[Pieces]:
        """All texts, in one or two groups per ``CHUNK_BYTES``."""
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) // CHUNK_BYTES
        for part in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(sizes)) + 1) if len(texts) else []:
            some = texts.slice(part[0], len(part))
            odd = pc.match_substring_regex(some, self.odd).to_numpy(zero_copy_only=False)
            if not odd.all():
                lists = [self.plain.findall(self.change(t)) for t in some.filter(pa.array(~odd)).to_pylist()]
                yield _group(part[~odd], lists, True)
            if odd.any():
                lists = [self.pieces(t, special) for t in some.filter(pa.array(odd)).to_pylist()]
                yield _group(part[odd], lists, False)


def _group(rows: np.ndarray, lists: list[list[str]], plain: bool) -> Pieces:
    found = pa.array(chain.from_iterable(lists), pa.string()).dictionary_encode()
    return Pieces(rows, found.dictionary, found.indices.to_numpy(zero_copy_only=False).astype(np.int64),
                  np.fromiter(map(len, lists), np.int64, len(lists)), plain)


WORDS = Cutter(WORD_PATTERN, _PLAIN_WORDS, _ODD, lowered)
BYTES = Cutter(BYTE_PATTERN, _PLAIN_BYTES, _ODD + r"|\s\s|\s\z")


def special_pattern(bpe: Bpe) -> re.Pattern | None:
    return re.compile("|".join(map(re.escape, sorted(bpe.special, key=len, reverse=True)))) if bpe.special else None


def utf8_of(entries: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all entries in one array, and their lengths."""
    if not len(entries):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    _, offsets, data = entries.buffers()
    offsets = np.frombuffer(offsets, np.int32)[entries.offset:entries.offset + len(entries) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, np.diff(offsets)


def marks_of(entries: pa.StringArray, bpe: Bpe) -> dict[int, int]:
    """Which entries stand for special strings, and their ids."""
    at = np.flatnonzero(pc.starts_with(entries, MARK).to_numpy(zero_copy_only=False))
    return {int(i): bpe.special[entries[int(i)].as_py()[len(MARK):]] for i in at}


@dataclass
class Rows:
    """Short arrays kept in one: row i is flat[starts[i] : starts[i] + lengths[i]]."""

    flat: np.ndarray
    lengths: np.ndarray

    def __post_init__(self):
        self.starts = np.cumsum(self.lengths) - self.lengths

    def take(self, numbers: np.ndarray) -> np.ndarray:
        return ragged(self.flat, self.starts[numbers], self.lengths[numbers])


def ids_of(entries: pa.StringArray, bpe: Bpe, encode: Callable) -> Rows:
    """The ids of each entry. ``encode(flat bytes, lengths)`` gives ids and their numbers per piece."""
    flat, lengths = utf8_of(entries)
    marks = marks_of(entries, bpe)
    ordinary = lengths > 0
    ordinary[list(marks)] = False
    at = np.flatnonzero(ordinary)
    starts = np.cumsum(lengths) - lengths
    ids, counts = encode(ragged(flat, starts[at], lengths[at]), lengths[at])
    if len(at) == len(lengths):
        return Rows(ids, counts)
    every = np.zeros(len(lengths), np.int64)
    every[at] = counts
    every[list(marks)] = 1
    out = np.zeros(int(every.sum()), np.int32)
    owner = np.repeat(np.arange(len(lengths)), every)
    out[ordinary[owner]] = ids
    for i, number in marks.items():
        out[np.flatnonzero(owner == i)] = number
    return Rows(out, every)
