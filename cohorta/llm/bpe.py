"""Byte-pair merges of a public tokenizer file, for many words at once.

Words are merged side by side in flat arrays: each round merges every word's best pair, so the
work per round is a few array operations over all words that still change.
"""

from __future__ import annotations

import heapq
import json

import numpy as np

from cohorta.llm.common import travels

travels(__name__)

NONE = np.int32(2**31 - 1)
LONG_WORD = 256  # longer words are merged one by one with a heap


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {b: chr(b) for b in plain}, 0
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + extra)
            extra += 1
    return [letters[b] for b in range(256)]


class PairTable:
    """Open-addressing table from pairs of ids below 65,536 to numbers, looked up by arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, values: np.ndarray, room: int = 8):
        self.bits = max(int(np.ceil(np.log2(max(len(left), 1) * room))), 4)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        keys = left.astype(np.int64) << 16 | right
        slots = self._slots(keys)
        open_ = np.arange(len(keys))
        while len(open_):
            free = self.keys[slots[open_]] < 0
            _, first = np.unique(slots[open_], return_index=True)
            chosen = np.zeros(len(open_), bool)
            chosen[first] = True
            chosen &= free
            put = open_[chosen]
            self.keys[slots[put]], self.values[slots[put]] = keys[put], values[put]
            open_ = open_[~chosen]
            slots[open_] = (slots[open_] + 1) & (len(self.keys) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 16 | right
        slots = self._slots(keys)
        there = self.keys[slots]
        out = self.values[slots]
        wrong = np.flatnonzero(there != keys)
        out[wrong] = NONE
        wrong = wrong[there[wrong] >= 0]
        while len(wrong):
            slots[wrong] = (slots[wrong] + 1) & (len(self.keys) - 1)
            there = self.keys[slots[wrong]]
            same = there == keys[wrong]
            out[wrong[same]] = self.values[slots[wrong[same]]]
            wrong = wrong[~same & (there >= 0)]
        return out


def ragged(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[starts[0] : starts[0] + lengths[0]], then the next piece, and so on, as one array."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    return flat[np.arange(ends[-1]) + np.repeat(starts - ends + lengths, lengths)]


class Bpe:
    """``config`` is the text of a tokenizers file whose model is byte-level BPE."""

    def __init__(self, config: str | bytes):
        loaded = json.loads(config)
        model = loaded["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.special: dict[str, int] = {t["content"]: t["id"] for t in loaded["added_tokens"] if t["special"]}
        letters = byte_letters()
        self.letter_of = letters
        self.byte_ids = np.array([self.vocab[c] for c in letters], np.int32)
        self.end_ids = np.array([self.vocab[c + self.suffix] for c in letters], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.left = np.array([self.vocab[a] for a, _ in pairs], np.int32)
        self.right = np.array([self.vocab[b] for _, b in pairs], np.int32)
        self.made = np.array([self.vocab[a + b] for a, b in pairs], np.int32)
        self.ranks = PairTable(self.left, self.right, np.arange(len(pairs), dtype=np.int32))
        self._rank_of: dict[tuple[int, int], int] | None = None

    def symbols(self, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        ids = self.byte_ids[flat]
        if self.suffix and len(lengths):
            last = np.cumsum(lengths) - 1
            ids[last] = self.end_ids[flat[last]]
        return ids

    def encode(self, flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words given as bytes in one array, and how many each word has. No word is empty."""
        return self.merge(self.symbols(flat, lengths), lengths)

    def merge(self, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(lengths):
            return ids, lengths
        long_words = np.flatnonzero(lengths > LONG_WORD)
        starts = np.cumsum(lengths) - lengths
        done: list[tuple[np.ndarray, np.ndarray]] = []
        for w in long_words:
            merged = self._merge_long(ids[starts[w]:starts[w] + lengths[w]].tolist())
            done.append((np.full(len(merged), w, np.int64), np.array(merged, np.int32)))
        short = np.flatnonzero(lengths <= LONG_WORD)
        step = 100_000  # words at a time, so that the arrays stay in the caches
        for i in range(0, len(short), step):
            part = short[i:i + step]
            word = np.repeat(part, lengths[part])
            flat = ids if len(part) == len(lengths) else ragged(ids, starts[part], lengths[part])
            self._merge_short(flat.copy(), word, done)
        words = np.concatenate([w for w, _ in done])
        flat = np.concatenate([f for _, f in done])
        return flat[np.argsort(words, kind="stable")], np.bincount(words, minlength=len(lengths))

    def _merge_short(self, ids: np.ndarray, word: np.ndarray, done: list) -> None:
        rank = np.full(len(ids), NONE, np.int32)
        inner = np.flatnonzero(word[:-1] == word[1:])
        rank[inner] = self.ranks.get(ids[inner], ids[inner + 1])
        while len(ids):
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            counts = np.diff(np.append(first, len(ids)))
            best = np.minimum.reduceat(rank, first)
            live = best != NONE
            if not live.all():
                stay = np.repeat(live, counts)
                done.append((word[~stay], ids[~stay]))
                ids, word, rank, best, counts = ids[stay], word[stay], rank[stay], best[live], counts[live]
                if not len(ids):
                    break
            at = np.flatnonzero(rank == np.repeat(best, counts))
            close = np.flatnonzero(np.diff(at) == 1)
            if len(close):  # the same letter several times in a row: every second pair
                run = np.maximum.accumulate(np.where(np.concatenate(([True], np.diff(at) != 1)), np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - run) % 2 == 0]
            ids[at] = self.made[rank[at]]
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            ids, word, rank = ids[stay], word[stay], rank[stay]
            at = at - np.arange(len(at))
            rank[at] = NONE
            inside = at[at + 1 < len(ids)]
            inside = inside[word[inside] == word[inside + 1]]
            rank[inside] = self.ranks.get(ids[inside], ids[inside + 1])
            before = at[at > 0] - 1
            before = before[word[before] == word[before + 1]]
            rank[before] = self.ranks.get(ids[before], ids[before + 1])

    def _merge_long(self, ids: list[int]) -> list[int]:
        if self._rank_of is None:
            self._rank_of = {p: r for r, p in enumerate(zip(self.left.tolist(), self.right.tolist()))}
        rank_of, made = self._rank_of, self.made
        after = list(range(1, len(ids))) + [-1]
        before = list(range(-1, len(ids) - 1))
        heap = [(rank_of[p], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in rank_of]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = int(made[rank]), -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for k, m in ((before[i], i), (i, after[i])):
                if k >= 0 and m >= 0 and (ids[k], ids[m]) in rank_of:
                    heapq.heappush(heap, (rank_of[ids[k], ids[m]], k, ids[k], ids[m]))
        return [x for x in ids if x >= 0]
