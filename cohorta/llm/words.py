"""Words of many texts at once, cut on their UTF-8 bytes in flat arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from cohorta.llm.common import travels

travels(__name__)

BLOCK_BYTES = 1_000_000  # texts cut together; a longer text is a block of its own


@dataclass
class Words:
    """``data`` holds the bytes of all words, word i has ``lengths[i]``; ``counts``: words per text."""

    data: np.ndarray
    lengths: np.ndarray
    counts: np.ndarray

    def coded(self) -> tuple[np.ndarray, pa.BinaryArray]:
        """A number for each word, equal for equal words, and the word of each number."""
        offsets = np.zeros(len(self.lengths) + 1, np.int32)
        np.cumsum(self.lengths, out=offsets[1:])
        found = pa.Array.from_buffers(pa.binary(), len(self.lengths), [
            None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(self.data))]).dictionary_encode()
        return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary


def blocks(texts: pa.BinaryArray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """First and last row (exclusive) of parts of about ``size`` bytes."""
    lengths = np.diff(np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1])
    start = total = 0
    for i, n in enumerate(lengths.tolist()):
        if total and total + n > size:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(texts):
        yield start, len(texts)


def cut_words(texts: pa.BinaryArray, inside: np.ndarray, letters: np.ndarray | None = None) -> Words:
    """The maximal stretches of bytes that are ``inside`` (256 truth values), never across texts.

    ``letters`` (256 bytes) says what each byte becomes first. No text is null.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets -= offsets[0]
    word = inside[flat]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    first = offsets[:-1][offsets[:-1] < len(flat)]  # empty texts start where the next one does
    begins[first] = word[first]
    starts = np.flatnonzero(begins)
    number = np.cumsum(begins)[word]  # of the word that a byte belongs to, from 1
    lengths = np.bincount(number, minlength=len(starts) + 1)[1:]
    counts = np.diff(np.searchsorted(starts, offsets))
    chosen = flat[word]
    return Words(chosen if letters is None else letters[chosen], lengths, counts)
