"""Periodic runs of words, found in a grammar of the texts instead of in the texts.

The word numbers of a block of texts are compressed by Re-Pair: rules replace repeated pairs until
none repeats, then neighbours are paired until each text is one symbol. The runs that cross the
boundary between a rule's two halves are computed once per rule, in one place where it stands, and
moved to all places where the rule is used. A text's run is found whole at the lowest rule that
contains it; what other rules see of it is a part, so the maximal intervals are the runs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohorta.llm.bpe import ragged
from cohorta.llm.common import SPACES, text_of, travels
from cohorta.llm.words import blocks, cut_words

travels(__name__)

LEAST_LENGTH = 12  # words of the shortest run

_WORD = ~np.isin(np.arange(256), [ord(c) for c in SPACES])


@dataclass
class Grammar:
    """Rule r stands first at word ``at[r]``, its halves have ``left[r]`` and ``size[r] - left[r]`` words.

    ``rules`` and ``places``: every use of a rule and the word where it begins.
    """

    at: np.ndarray
    left: np.ndarray
    size: np.ndarray
    rules: np.ndarray
    places: np.ndarray


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def re_pair(words: np.ndarray, text: np.ndarray, least: int = LEAST_LENGTH) -> Grammar:
    """The grammar of texts given as word numbers; ``text`` says whose word each is (ascending).

    In a round all pairs are replaced at once that are more frequent than the pairs they overlap
    with (the most frequent pair of all is one of them; of like frequent ones a hash decides), so a
    round shortens every stretch in which pairs repeat. Rules of less than ``least`` words are not
    listed, as no run fits into them.
    """
    symbols, place, size = words.astype(np.int64), np.arange(len(words)), np.ones(len(words), np.int64)
    next_symbol = int(words.max()) + 1 if len(words) else 0
    made: list[tuple[np.ndarray, ...]] = []
    uses: list[tuple[np.ndarray, np.ndarray]] = []
    rules, repeats = 0, True
    while len(symbols) and (text[1:] == text[:-1]).any():
        inner = np.flatnonzero(text[1:] == text[:-1])
        key = symbols[inner] * next_symbol + symbols[inner + 1]
        _, first, pair, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        if repeats:
            weight = np.zeros(len(symbols), np.uint64)  # of the pair that begins here; 0: occurs once
            weight[inner] = np.where(n > 1, (n.astype(np.uint64) << np.uint64(40))
                                     | (_mixed(np.arange(1, len(n) + 1).astype(np.uint64)) >> np.uint64(24)), 0)[pair]
            chosen = _chosen(weight)
            repeats = len(chosen) > 0
        if not repeats:  # nothing repeats: neighbours, two by two from the start of each text
            starts = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
            offset = np.arange(len(symbols)) - np.repeat(starts, np.diff(np.append(starts, len(symbols))))
            chosen = inner[offset[inner] % 2 == 0]
        number = np.full(len(symbols), -1)
        number[inner] = pair
        used, rule = np.unique(number[chosen], return_inverse=True)
        origin = inner[first[used]]  # one place of each pair, replaced there or not
        long = size[origin] + size[origin + 1] >= least
        listed = np.where(long, rules + np.cumsum(long) - 1, -1)
        made.append((place[origin[long]], size[origin[long]], (size[origin] + size[origin + 1])[long]))
        rules += int(long.sum())
        now = listed[rule]
        uses.append((now[now >= 0], place[chosen[now >= 0]]))
        symbols[chosen] = next_symbol + rule
        size[chosen] += size[chosen + 1]
        stay = np.ones(len(symbols), bool)
        stay[chosen + 1] = False
        symbols, place, size, text = symbols[stay], place[stay], size[stay], text[stay]
        next_symbol += len(used)
    if not made:
        return Grammar(*[np.zeros(0, np.int64)] * 5)
    return Grammar(*[np.concatenate(x) for x in zip(*made)], *[np.concatenate(x) for x in zip(*uses)])


def _chosen(weight: np.ndarray) -> np.ndarray:
    """Places of pairs heavier than both pairs they overlap with; in a row of equal ones every second."""
    before, after = np.concatenate(([0], weight[:-1])).astype(np.uint64), np.append(weight[1:], 0).astype(np.uint64)
    top = (weight > 0) & (weight >= before) & (weight >= after)
    same = top.copy()
    same[1:] &= top[:-1] & (weight[1:] == weight[:-1])
    same[0] = False
    head = np.maximum.accumulate(np.where(top & ~same, np.arange(len(weight)), 0))
    return np.flatnonzero(top & ((np.arange(len(weight)) - head) % 2 == 0))


class Extensions:
    """How far the words from two places on, or up to them, are the same."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        odd = 0x9E3779B97F4A7C15
        values = _mixed(words.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
        self.powers = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, odd, np.uint64))))
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * self.powers[:n])))

    def _same(self, i: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the ``length`` words from i on equal those from j on, j > i, by 64-bit hashes."""
        return ((self.sums[i + length] - self.sums[i]) * self.powers[j - i]) == self.sums[j + length] - self.sums[j]

    def forward(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        return self._search(lambda n: self._same(i, j, n), most)

    def backward(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words that end just before i and j."""
        return self._search(lambda n: self._same(i - n, j - n, n), most)

    @staticmethod
    def _search(same: Callable, most: np.ndarray) -> np.ndarray:
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            fits = same(middle)
            low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
        return low


def _candidates(words: np.ndarray, grammar: Grammar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rule, place, period): the word at ``place`` occurs again one period later.

    A run of period p across a boundary b that has p words to the right of it repeats word b - 1 at
    b - 1 + p; any other has p words to the left and repeats word b - p at b.
    """
    n = len(words)
    order = np.argsort(words, kind="stable")
    keys = words[order].astype(np.int64) * n + order  # ascending
    start, end = grammar.at, grammar.at + grammar.size
    bound, half = start + grammar.left, grammar.size // 2
    found = []
    for anchor, low, high in ((bound - 1, bound, np.minimum(end, bound + half)),
                              (bound, np.maximum(start, bound - half), bound)):
        base = words[anchor].astype(np.int64) * n
        first, last = np.searchsorted(keys, base + low), np.searchsorted(keys, base + high)
        other = ragged(order, first, last - first)
        rule = np.repeat(np.arange(len(bound)), last - first)
        i, j = np.minimum(anchor[rule], other), np.maximum(anchor[rule], other)
        # Six places or more in a row repeat a period later, so a neighbour does too.
        after = (j + 1 < end[rule]) & (words[np.minimum(i + 1, n - 1)] == words[np.minimum(j + 1, n - 1)])
        before = (i > start[rule]) & (words[np.maximum(i - 1, 0)] == words[np.maximum(j - 1, 0)])
        near = after | before
        found.append((rule[near], i[near], j[near] - i[near]))
    return tuple(np.concatenate(x) for x in zip(*found))


def crossing_runs(words: np.ndarray, grammar: Grammar, least: int = LEAST_LENGTH) -> tuple[np.ndarray, ...]:
    """(rule, start, end, period): for every rule the runs inside it that cross its boundary, as
    words of the rule. Each interval has its smallest period."""
    rule, i, period = _candidates(words, grammar)
    j = i + period
    start, end = grammar.at[rule], grammar.at[rule] + grammar.size[rule]
    same = Extensions(words)
    first = i - same.backward(i, j, i - start)
    last = j + same.forward(i, j, end - j)
    long = last - first >= np.maximum(least, 2 * period)
    found = _smallest(np.stack((rule, first, last, period), axis=1)[long])
    # Hashes can only say too much: intervals are compared word by word, and if one is wrong all of its rule are.
    bad = {r for r, a, b, p in found.tolist() if (words[a:b - p] != words[a + p:b]).any()}
    if bad:
        again = [_plain_run(words, grammar, r, p) for r, p in set(zip(rule.tolist(), period.tolist())) if r in bad]
        found = np.concatenate((found[~np.isin(found[:, 0], list(bad))], np.array(again, np.int64)))
        found = _smallest(found[found[:, 2] - found[:, 1] >= np.maximum(least, 2 * found[:, 3])])
    offset = grammar.at[found[:, 0]]
    return found[:, 0], found[:, 1] - offset, found[:, 2] - offset, found[:, 3]


def _smallest(found: np.ndarray) -> np.ndarray:
    """Of equal intervals of a rule (rows of rule, start, end, period) the one of the smallest period."""
    found = found[np.lexsort(found.T[::-1])]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, :3] != found[:-1, :3]).any(axis=1)
    return found[new]


def _plain_run(words: np.ndarray, grammar: Grammar, rule: int, p: int) -> tuple[int, int, int, int]:
    """The longest stretch of period p across the rule's boundary, by comparing words."""
    start, size, bound = int(grammar.at[rule]), int(grammar.size[rule]), int(grammar.at[rule] + grammar.left[rule])
    same = np.concatenate(([False], words[start:start + size - p] == words[start + p:start + size], [False]))
    edges = np.flatnonzero(same[1:] != same[:-1])
    a, b = start + edges[::2], start + edges[1::2] + p
    lengths = np.where((a < bound) & (b > bound), b - a, 0)
    best = int(np.argmax(lengths)) if len(a) else 0
    return (rule, int(a[best]), int(b[best]), p) if lengths.any() else (rule, start, start, p)


def _maximal(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Of different intervals the places of those inside no other of the same period, by start and period."""
    order = np.lexsort((-end, start, period))
    new = np.concatenate(([True], period[order][1:] != period[order][:-1])) if len(order) else np.zeros(0, bool)
    group = np.cumsum(new) * (int(end.max()) + 1 if len(end) else 1)
    reach = np.maximum.accumulate(group + end[order]) if len(order) else group
    inside = np.zeros(len(order), bool)
    inside[1:] = (reach[:-1] >= (group + end[order])[1:]) & ~new[1:]
    kept = order[~inside]
    return kept[np.lexsort((period[kept], start[kept]))]


def runs_of(words: np.ndarray, text: np.ndarray, least: int = LEAST_LENGTH) -> tuple[np.ndarray, ...]:
    """(start, end, period) of all runs of texts given as word numbers, by start and period."""
    grammar = re_pair(words, text, least)
    if not len(grammar.at):
        return (np.zeros(0, np.int64),) * 3
    rule, first, last, period = crossing_runs(words, grammar, least)
    by = np.argsort(grammar.rules, kind="stable")
    uses, places = grammar.rules[by], grammar.places[by]
    low, high = np.searchsorted(uses, rule), np.searchsorted(uses, rule, "right")
    offset, which = ragged(places, low, high - low), np.repeat(np.arange(len(rule)), high - low)
    start, end, period = offset + first[which], offset + last[which], period[which]
    kept = _maximal(start, end, period)
    return start[kept], end[kept], period[kept]


RUNS = ("doc_id {id}, n_words long, runs array<struct<start:long,length:long,period:long>>, n_kept long, "
        "collapsed string")


def word_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LENGTH,
              order: Callable[[int | None, int], np.ndarray | None] | None = None, with_text: bool = True) -> DataFrame:
    """One row per input row: doc_id, n_words, runs (start, length, period, by start and period),
    n_kept and collapsed, the words joined by one space without those that a run repeats.

    A run is a stretch of words of smallest period q and at least ``least`` and 2 q words that cannot
    be extended; of each run the first q words stay unless another run repeats them. ``order`` may
    give, for an id and a number of words, which words to read in which order. Null and empty texts
    have no words and no runs. Repeated rows are searched each; an empty table gives no rows. Texts
    are compressed in blocks of about 1 MB, a longer text by itself, in memory of some 20 times its size.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in blocks(batch.column(1)):
                ids = batch.column(0).slice(a, b - a)
                yield _block(ids, batch.column(1).slice(a, b - a), least, order, with_text)

    picked = docs.select(docs[id_col].alias("doc_id"), text_of(text_col).cast("binary").alias("text"))
    return picked.mapInArrow(run, RUNS.format(id=dict(docs.dtypes)[id_col]))


def _block(ids: pa.Array, texts: pa.BinaryArray, least: int, order: Callable | None, with_text: bool) -> pa.RecordBatch:
    cut = cut_words(texts, _WORD)
    codes, entries = cut.coded()
    counts = cut.counts
    if order is not None:
        parts, at = [], 0
        for doc_id, n in zip(ids.to_pylist(), counts.tolist()):
            places = order(doc_id, n) if n else None
            parts.append(codes[at:at + n] if places is None else codes[at:at + n][places])
            at += n
        codes = np.concatenate([np.zeros(0, np.int64), *parts])
        counts = np.array([len(p) for p in parts], np.int64)
    text = np.repeat(np.arange(len(counts)), counts)
    start, end, period = runs_of(codes, text, least)
    stops = np.cumsum(counts)
    owner = np.searchsorted(stops, start, "right")
    begins = stops - counts
    again = np.zeros(len(codes) + 1, np.int64)  # how many runs repeat each word
    np.add.at(again, start + period, 1)
    np.add.at(again, end, -1)
    kept = np.flatnonzero(np.cumsum(again[:-1]) == 0)
    n_kept = np.diff(np.searchsorted(kept, np.append(0, stops)))
    lists = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(owner, np.arange(len(counts) + 1)), pa.int32()),
        pa.StructArray.from_arrays([pa.array(start - begins[owner]), pa.array(end - start), pa.array(period)],
                                   ["start", "length", "period"]))
    texts = _joined(entries, codes[kept], n_kept) if with_text else pa.nulls(len(counts), pa.string())
    return pa.RecordBatch.from_arrays([ids, pa.array(counts), lists, pa.array(n_kept), texts],
                                      names=["doc_id", "n_words", "runs", "n_kept", "collapsed"])


def _joined(entries: pa.BinaryArray, codes: np.ndarray, counts: np.ndarray) -> pa.StringArray:
    """Words joined by one space, text by text."""
    if not len(codes):
        return pa.array([""] * len(counts), pa.string())
    ends = np.frombuffer(entries.buffers()[1], np.int32)[entries.offset:entries.offset + len(entries) + 1].astype(np.int64)
    lengths = np.diff(ends)[codes]
    last = np.cumsum(lengths + 1)  # a space after each word
    out = np.full(int(last[-1]), 0x20, np.uint8)
    letters = np.ones(len(out), bool)
    letters[last - 1] = False
    out[letters] = ragged(np.frombuffer(entries.buffers()[2], np.uint8), ends[codes], lengths)
    stops = np.append(0, last)[np.cumsum(counts)]
    data = out.tobytes()
    return pa.array([data[a:max(b - 1, a)] for a, b in zip([0, *stops[:-1].tolist()], stops.tolist())],
                    pa.binary()).cast(pa.string())
