"""Exact token counts at every prefix of a text, by dynamic programming over its pieces.

The last token of a prefix decides the rest: the ids of ``p`` are those of a shorter prefix and one
token more, if the two facing tokens would not have merged otherwise. One pass over the prefixes of
a piece therefore gives the counts of all of them, and budgets or truncations need no re-encoding.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from cohorta.llm.bpe import NONE, Bpe, PairTable, ragged
from cohorta.llm.common import text_of, travels
from cohorta.llm.pieces import WORDS, Pieces, Rows, lowered, marks_of, special_pattern, utf8_of

travels(__name__)

LATEST = np.int64(2**40)
BLOCK_BYTES = 400_000  # pieces whose tokens are held at once
LONG_PIECE, KNOWN_PAIRS = 2048, 1_000_000  # bytes of a piece worked on by itself; pairs remembered for it
LONG_RUN, CONTEXT = 64, 8  # letters of a piece whose prefixes are not cut one by one, and of its end that are

_LONG_CONTRACTIONS = {"'re", "'ve", "'ll"}
_KEPT: dict = {}  # made once per task

# White space as the tokenizer's pattern sees it.
_WORD = re.compile("[^\t\n\x0b\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


class PrefixCounter:
    """Counts of a byte-level vocabulary with a suffix at word ends (or none: the suffix is empty)."""

    def __init__(self, bpe: Bpe):
        self.bpe = bpe
        made_by = np.full(max(bpe.vocab.values()) + 1, -1, np.int64)  # the merge that makes a token
        made_by[bpe.made[::-1]] = np.arange(len(bpe.made))[::-1]
        self.made_by = made_by
        self.longest = max(map(len, bpe.vocab))  # letters of a token, at least
        self._build_trie()
        self._recent: tuple = (None, None)  # the long piece seen last and its states
        self._known_pairs: dict[int, bool] = {}

    def _build_trie(self) -> None:
        bpe, suffix = self.bpe, self.bpe.suffix
        byte_of = {c: b for b, c in enumerate(bpe.letter_of)}
        reachable = self._reachable()
        children: dict[tuple[int, int], int] = {}
        plain, final = [-1], [-1]
        for token, number in bpe.vocab.items():
            if not reachable[number]:
                continue
            ends = bool(suffix) and token.endswith(suffix)
            node = 0
            for c in token[:-len(suffix)] if ends else token:
                key = (node, byte_of[c])
                if key not in children:
                    children[key] = len(plain)
                    plain.append(-1)
                    final.append(-1)
                node = children[key]
            if ends or not suffix:
                final[node] = number
            if not ends:
                plain[node] = number
        edges = np.array(list(children), np.int64).reshape(-1, 2)
        self.trie = PairTable(edges[:, 0], edges[:, 1], np.array(list(children.values()), np.int32))
        self.plain, self.final = np.array(plain, np.int64), np.array(final, np.int64)

    def _reachable(self) -> np.ndarray:
        """Tokens that are the encoding of their own letters; no other one ever comes out of merges."""
        bpe = self.bpe
        byte_of = {c: b for b, c in enumerate(bpe.letter_of)}
        words, numbers = [], []
        for token, number in bpe.vocab.items():
            ends = bool(bpe.suffix) and token.endswith(bpe.suffix)
            body = token[:-len(bpe.suffix)] if ends else token
            if token in bpe.special or not body or any(c not in byte_of for c in body):
                continue
            letters = [int(bpe.byte_ids[byte_of[c]]) for c in body]
            if ends:
                letters[-1] = int(bpe.end_ids[byte_of[body[-1]]])
            words.append(letters)
            numbers.append(number)
        lengths = np.array([len(w) for w in words], np.int64)
        ids, counts = bpe.merge(np.array([x for w in words for x in w], np.int32), lengths)
        first = np.cumsum(counts) - counts
        out = np.zeros(max(bpe.vocab.values()) + 1, bool)
        numbers = np.array(numbers)
        out[numbers[(counts == 1) & (ids[first] == numbers)]] = True
        return out

    def keep_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether two tokens stay as they are when they stand side by side.

        Merges are undone from the latest on, on the side where it is. Before each one the facing
        letters must not have a merge that comes earlier (on the left side: at the same rank too,
        as equal merges go from left to right).
        """
        left, right = left.astype(np.int64), right.astype(np.int64)
        out = np.ones(len(left), bool)
        limit = np.full(len(left), LATEST)
        open_ = np.arange(len(left))
        while len(open_):
            a, b = left[open_], right[open_]
            across = self.bpe.ranks.get(a, b).astype(np.int64)
            across[across == NONE] = LATEST
            broken = across < limit[open_]
            out[open_[broken]] = False
            by_a, by_b = self.made_by[a], self.made_by[b]
            over = broken | ((by_a < 0) & (by_b < 0))
            open_, a, b, by_a, by_b = open_[~over], a[~over], b[~over], by_a[~over], by_b[~over]
            undo_a = by_a > by_b
            left[open_[undo_a]] = self.bpe.right[by_a[undo_a]]
            limit[open_[undo_a]] = by_a[undo_a]
            undo_b = ~undo_a
            right[open_[undo_b]] = self.bpe.left[by_b[undo_b]]
            limit[open_[undo_b]] = by_b[undo_b] + 1
        return out

    def _distinct_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys, back = np.unique(left << 20 | right, return_inverse=True)
        return self.keep_apart(keys >> 20, keys & 0xFFFFF)[back]

    def counts(self, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """For each byte of each piece: the tokens of the piece up to and with that byte."""
        ends = np.cumsum(lengths)
        alone = lengths > LONG_PIECE
        parts = np.split(np.arange(len(lengths)),
                         np.flatnonzero(np.diff(ends // BLOCK_BYTES).astype(bool) | alone[1:] | alone[:-1]) + 1)
        return np.concatenate([self.states(flat[ends[p[0]] - lengths[p[0]]:ends[p[-1]]], lengths[p])[0]
                               for p in parts if len(p)] or [np.zeros(0, np.int64)])

    def _tokens_in(self, flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
        """All tokens that lie in the pieces: from, to (both flat; ``to`` is the last byte), trie node."""
        total = int(lengths.sum())
        left_in = np.repeat(np.cumsum(lengths), lengths) - np.arange(total)  # bytes from here to the piece's end
        froms, tos, nodes = [], [], []
        at, node, depth = np.arange(total), np.zeros(total, np.int64), 0
        while len(at):
            node = self.trie.get(node, flat[at + depth]).astype(np.int64)
            there = node != NONE
            at, node = at[there], node[there]
            token = (self.plain[node] >= 0) | (self.final[node] >= 0)
            froms.append(at[token])
            tos.append(at[token] + depth)
            nodes.append(node[token])
            depth += 1
            more = left_in[at] > depth
            at, node = at[more], node[more]
        return np.concatenate(froms), np.concatenate(tos), np.concatenate(nodes)

    def _long_states(self, flat: np.ndarray) -> tuple[np.ndarray, ...]:
        """``states`` of one long piece, token by token: side by side there is nothing to gain."""
        data = flat.tobytes()
        if self._recent[0] == data:
            return self._recent[1]
        froms, tos, nodes = self._tokens_in(flat, np.array([len(flat)]))
        order = np.argsort(tos, kind="stable")
        last, inner, counts = [-1] * len(flat), [0] * len(flat), [0] * len(flat)
        for f, t, plain, final in zip(froms[order].tolist(), tos[order].tolist(), self.plain[nodes[order]].tolist(),
                                      self.final[nodes[order]].tolist()):
            before, base = (-1, 0) if not f else (last[f - 1], inner[f - 1])
            if f and before < 0:
                continue
            if plain >= 0 and (not f or self._apart(before, plain)):
                last[t], inner[t] = plain, base + 1
            if final >= 0 and (not f or self._apart(before, final)):
                counts[t] = base + 1
        self._recent = data, tuple(np.array(x, np.int64) for x in (counts, last, inner))
        return self._recent[1]

    def _apart(self, left: int, right: int) -> bool:
        key = left << 20 | right
        if key not in self._known_pairs:
            if len(self._known_pairs) >= KNOWN_PAIRS:
                self._known_pairs.clear()
            self._known_pairs[key] = bool(self.keep_apart(np.array([left]), np.array([right]))[0])
        return self._known_pairs[key]

    def extended(self, piece: np.ndarray, states: tuple[np.ndarray, ...], at: np.ndarray, tails: list[bytes]) -> np.ndarray:
        """Tokens of piece[:at] + tail for many places and tails, from the states of the whole piece.

        No token reaches further back than the longest is, so the states before that are not needed.
        """
        low = np.maximum(at - self.longest - 1, 0)
        known, extra = at - low, np.array([len(t) for t in tails], np.int64)
        lengths = known + extra
        inside = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        seeded = inside < np.repeat(known, lengths)
        flat = np.zeros(len(inside), np.uint8)
        flat[seeded] = ragged(piece, low, known)
        flat[~seeded] = np.frombuffer(b"".join(tails), np.uint8)
        last, inner = np.full(len(flat), -1, np.int64), np.zeros(len(flat), np.int64)
        last[seeded], inner[seeded] = ragged(states[1], low, known), ragged(states[2], low, known)
        return self.states(flat, lengths, (seeded, last, inner, low == 0))[0][np.cumsum(lengths) - 1]

    def states(self, flat: np.ndarray, lengths: np.ndarray, seeds: tuple | None = None) -> tuple[np.ndarray, ...]:
        """For each byte: the tokens of the piece up to it, the last of them if the piece goes on, and
        how many there are then. ``seeds``: which bytes have states already, these, and which pieces
        begin where they are cut."""
        total = int(lengths.sum())
        if not total:
            return (np.zeros(0, np.int64),) * 3
        if seeds is None and len(lengths) == 1 and total > LONG_PIECE:
            return self._long_states(flat)
        starts = np.cumsum(lengths) - lengths
        word = np.repeat(np.arange(len(lengths)), lengths)
        froms, tos, nodes = self._tokens_in(flat, lengths)
        if seeds is not None:
            new = ~seeds[0][tos] & (seeds[3][word[tos]] | (froms > starts[word[tos]]))
            froms, tos, nodes = froms[new], tos[new], nodes[new]
        place = tos - starts[word[tos]]
        order = np.argsort(place, kind="stable")
        froms, tos, nodes, place = froms[order], tos[order], nodes[order], place[order]
        # The last token of the prefix as the start of a longer piece, and the tokens it then has.
        last, inner = (np.full(total, -1, np.int64), np.zeros(total, np.int64)) if seeds is None else seeds[1:3]
        counts = np.zeros(total, np.int64)
        cuts = np.flatnonzero(np.diff(place, prepend=-1, append=-1))
        for a, b in zip(cuts[:-1], cuts[1:]):
            f, t, n = froms[a:b], tos[a:b], nodes[a:b]
            whole = f == starts[word[f]]
            before = np.where(whole, -1, last[f - 1])
            base = np.where(whole, 0, inner[f - 1])
            usable = whole | (before >= 0)
            f, t, n, whole, before, base = f[usable], t[usable], n[usable], whole[usable], before[usable], base[usable]
            for tokens, is_final in ((self.plain[n], False), (self.final[n], True)):
                known = tokens >= 0
                good = known & whole
                ask = np.flatnonzero(known & ~whole)
                good[ask] = self._distinct_apart(before[ask], tokens[ask])
                if is_final:
                    counts[t[good]] = base[good] + 1
                else:
                    last[t[good]], inner[t[good]] = tokens[good], base[good] + 1
        return counts, last, inner


def _letter_ends(flat: np.ndarray) -> np.ndarray:
    """Which bytes end a code point."""
    return np.append((flat[1:] & 0xC0) != 0x80, True) if len(flat) else np.zeros(0, bool)


def piece_tables(counter: PrefixCounter, entries: pa.StringArray) -> tuple[Rows, np.ndarray]:
    """Counts at every code point of every entry, and the whole entry's count."""
    flat, lengths = utf8_of(entries)
    marks = marks_of(entries, counter.bpe)
    ordinary = lengths > 0
    ordinary[list(marks)] = False
    at = np.flatnonzero(ordinary)
    starts = np.cumsum(lengths) - lengths
    some = ragged(flat, starts[at], lengths[at])
    ends = _letter_ends(some)
    counts = counter.counts(some, lengths[at])
    owner = np.repeat(at, lengths[at])
    totals = np.zeros(len(lengths), np.int64)
    totals[at] = counts[np.cumsum(lengths[at]) - 1]
    for i in marks:
        totals[i] = 1
    return Rows(counts[ends], np.bincount(owner[ends], minlength=len(lengths))), totals


def _followers() -> set[str]:
    """Characters that may compose with what stands before them, apart from combining marks."""
    if "followers" not in _KEPT:
        found = {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))}
        for c in range(sys.maxunicode + 1):
            parts = unicodedata.decomposition(chr(c)).split()
            if len(parts) == 2 and parts[0][0] != "<":
                found.add(chr(int(parts[1], 16)))
        _KEPT["followers"] = found
    return _KEPT["followers"]


def _stands_alone(c: str) -> bool:
    """Whether NFC never joins or reorders a character with those before it."""
    if c.isascii():
        return True
    first = unicodedata.normalize("NFD", c)[0]
    return unicodedata.combining(first) == 0 and first not in _followers()


class _Cut:
    """A string without special strings, cut once. ``counts`` tells the tokens of all its prefixes.

    Pieces never change with what follows them, but for two cases: the letters of a contraction
    that is not whole yet, and letters that compose with the next ones. The latter are cut again
    from the last piece that does not touch them.
    """

    def __init__(self, text: str):
        self.known: list[tuple[int, int]] | None = None  # prefix, its length in lower case; none: the same
        # Prefix, pieces that stay, where the letters that compose begin (in lower case), what they are here.
        self.again: list[tuple[int, int, int, str]] = []
        if text.isascii() or unicodedata.is_normalized("NFC", text) and all(len(lowered(c)) == 1 for c in text):
            self._cut(lowered(text))
            return
        starts = [i for i, c in enumerate(text) if not i or _stands_alone(c)]
        clusters = [lowered(text[a:b]) for a, b in zip(starts, [*starts[1:], len(text)])]
        whole = "".join(clusters)
        self._cut(whole)
        self.known = []
        stops = [b for _, b in self.spans]
        at = 0
        for a, b, cluster in zip(starts, [*starts[1:], len(text)], clusters):
            for i in range(a + 1, b):
                part = lowered(text[a:i])
                if cluster.startswith(part):
                    self.known.append((i, at + len(part)))
                else:
                    k = bisect_right(stops, at - 2)  # a piece is settled two letters after its end
                    self.again.append((i, k, at, part))
            at += len(cluster)
            self.known.append((b, at))

    def _cut(self, whole: str) -> None:
        self.spans = [m.span() for m in WORDS.pattern.finditer(whole)]
        self.pieces = [whole[a:b] for a, b in self.spans]
        self.whole, self.length = whole, len(whole)

    def counts(self, entries: dict[str, int], rows: Rows, totals: np.ndarray, counter: PrefixCounter,
               budget: int | None) -> np.ndarray:
        """Tokens of the prefixes from the empty one on; above ``budget`` any number above it."""
        numbers = np.array([entries[p] for p in self.pieces], np.int64)
        upto = np.concatenate(([0], np.cumsum(totals[numbers])))
        table = upto[np.searchsorted([b for _, b in self.spans], np.arange(self.length + 1), "right")]
        for (a, b), piece, number, base in zip(self.spans, self.pieces, numbers.tolist(), upto.tolist()):
            table[a + 1:b + 1] = rows.flat[rows.starts[number]:rows.starts[number] + rows.lengths[number]] + base
            if piece in _LONG_CONTRACTIONS:
                table[a + 2] = base + totals[entries["'"]] + totals[entries[piece[1]]]
        if self.known is None:
            return table
        out = np.zeros(self.known[-1][0] + 1, np.int64)
        for i, n in self.known:
            out[i] = table[n]
        stops = [b for _, b in self.spans]
        waiting: list[tuple[int, int, list[str]]] = []  # prefix, tokens before, pieces
        long: dict[int, list[tuple[int, int, str]]] = {}
        for i, k, at, part in self.again:
            start = stops[k - 1] if k else 0
            # No token is longer than the longest of the vocabulary.
            if budget is not None and upto[k] + (at - start + len(part)) // counter.longest > budget:
                out[i] = budget + 1
            elif at - start > LONG_RUN:
                long.setdefault(k, []).append((i, at, part))
            else:
                waiting.append((i, int(upto[k]), WORDS.pattern.findall(self.whole[start:at] + part)))
        for k, ends in long.items():
            waiting += self._long(k, ends, int(upto[k]), counter)
        some = {p: j for j, p in enumerate(dict.fromkeys(p for *_, cut in waiting for p in cut))}
        sums = piece_tables(counter, pa.array(list(some), pa.string()))[1]
        for i, base, cut in waiting:
            out[i] = base + sum(int(sums[some[p]]) for p in cut)
        return out

    def _long(self, k: int, ends: list[tuple[int, int, str]], before: int, counter: PrefixCounter) -> list[tuple]:
        """The same for prefixes that end far inside or just behind piece k: its states are computed
        once, and each prefix goes on from them with the letters that differ."""
        start, stop = self.spans[k]
        piece = np.frombuffer(self.pieces[k].encode(), np.uint8)
        states = counter.states(piece, np.array([len(piece)]))
        byte = np.concatenate(([0], np.flatnonzero(_letter_ends(piece)) + 1))  # where each letter begins
        out, asked = [], []
        for i, at, part in ends:
            end = min(stop, at)
            # A piece of this length is a run of one kind of letters; some of them tell how it goes on.
            first, *others = WORDS.pattern.findall(self.whole[end - CONTEXT:at] + part)
            q = int(byte[end - start])
            if len(first) > CONTEXT:
                asked.append((len(out), q, first[CONTEXT:].encode()))
            out.append((i, before + int(states[0][q - 1]), others))
        for j in range(0, len(asked), 10_000):
            some = asked[j:j + 10_000]
            found = counter.extended(piece, states, np.array([q for _, q, _ in some]), [t for *_, t in some])
            for (n, _, _), tokens in zip(some, found.tolist()):
                out[n] = (out[n][0], before + tokens, out[n][2])
        return out


def _parts(word: str, special: re.Pattern | None) -> list[tuple[int, int | None, _Cut]]:
    """Where each part of a word begins and where its special string does (in the part), and its cut.

    The letters of a special string are ordinary ones as long as the last is missing.
    """
    out, at = [], 0
    for m in special.finditer(word) if special is not None else ():
        out.append((at, m.start() - at, _Cut(word[at:m.end() - 1])))
        at = m.end()
    if at < len(word):
        out.append((at, None, _Cut(word[at:])))
    return out


def text_prefixes(counter: PrefixCounter, text: str, budget: int | None = None) -> np.ndarray:
    """Tokens of text[:i] for every i from 0 to the length.

    A prefix that ends inside a piece is the pieces before, and the piece's own prefix; see ``_Cut``
    for the exceptions. With ``budget``, counts above it may be any number above it.
    """
    special = special_pattern(counter.bpe)
    spans = [m.span() for m in _WORD.finditer(text)]
    plans = {word: _parts(word, special) for word in dict.fromkeys(text[a:b] for a, b in spans)}
    entries = {p: i for i, p in enumerate(dict.fromkeys(
        [*"'rvle", *(p for parts in plans.values() for *_, cut in parts for p in cut.pieces)]))}
    rows, totals = piece_tables(counter, pa.array(list(entries), pa.string()))
    known: dict[str, np.ndarray] = {}
    for word, parts in plans.items():
        found, base = [], 0
        for _, mark, cut in parts:
            counts = cut.counts(entries, rows, totals, counter, budget)[1:] + base
            found.append(counts)
            if mark is not None:
                base = (int(counts[mark - 1]) if mark else base) + 1
                found.append(np.array([base]))
        known[word] = np.concatenate(found)
    out = np.zeros(len(text) + 1, np.int64)
    done = at = 0
    for a, b in spans:
        out[at + 1:a + 1] = done
        out[a + 1:b + 1] = known[text[a:b]] + done
        done, at = int(out[b]), b
    out[at + 1:] = done
    return out


def fits_plain(text: str, numbers: np.ndarray, rows: Rows, totals: np.ndarray, budget: int) -> int:
    """``longest_within`` for a plain text of more than ``budget`` tokens, from its pieces' tables.

    Every piece adds a token at least, so the longest prefix ends in, or just before, the first
    piece that goes beyond the budget.
    """
    upto = np.cumsum(totals[numbers])
    k = int(np.searchsorted(upto, budget, "right"))
    table = rows.take(numbers[k:k + 1]) + (upto[k - 1] if k else 0)
    inside = np.flatnonzero(table <= budget)
    start = next(islice(WORDS.plain.finditer(lowered(text)), k, None)).start()
    return start + (int(inside[-1]) + 1 if len(inside) else 0)


def longest_within(prefixes: np.ndarray, budget: int) -> int:
    """Code points of the longest prefix of at most ``budget`` tokens."""
    return int(np.flatnonzero(prefixes <= budget)[-1])


COUNTS = "doc_id {id}, n_bytes long, n_tokens long, n_fit long, prefixes binary"


def count_tokens(docs: DataFrame, tokenizer: str, budget: int | None = None, id_col: str = "doc_id",
                 text_col: str = "text", with_prefixes: bool = False) -> DataFrame:
    """One row per input row: bytes, tokens, and on request what fits a budget and the prefix table.

    ``n_fit``: code points of the longest prefix of at most ``budget`` tokens (null without one).
    ``prefixes``: the tokens of every prefix, from the empty one on, as little-endian unsigned
    32-bit numbers; it is four times the text, so it is made on request. Null and empty texts have
    no tokens and fit whole; repeated rows are counted each; an empty table gives no rows. Equal
    pieces of a batch share one table of prefix counts. Nothing is shuffled.
    """
    with open(tokenizer, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())  # a vocabulary: a few MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter(Bpe(shared.value))
        special = special_pattern(counter.bpe)
        for batch in batches:
            for pieces in WORDS.batch(batch.column(1), special):
                rows = pa.array(pieces.rows)
                texts = batch.column(1).take(rows)
                table, sums = piece_tables(counter, pieces.entries)
                ends = np.cumsum(pieces.counts)
                totals = document_totals(pieces, sums)
                fit, tables = pc.utf8_length(texts).to_pylist(), [None] * len(texts)
                for i in np.flatnonzero(totals > budget).tolist() if budget is not None else []:
                    numbers = pieces.numbers[ends[i] - pieces.counts[i]:ends[i]]
                    fit[i] = (fits_plain(texts[i].as_py(), numbers, table, sums, budget) if pieces.plain
                              else longest_within(text_prefixes(counter, texts[i].as_py(), budget), budget))
                if with_prefixes:
                    tables = [text_prefixes(counter, t).astype("<u4").tobytes() for t in texts.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), pc.binary_length(texts).cast(pa.int64()), pa.array(totals),
                     pa.array(fit if budget is not None else [None] * len(texts), pa.int64()),
                     pa.array(tables, pa.binary())],
                    names=["doc_id", "n_bytes", "n_tokens", "n_fit", "prefixes"])

    picked = docs.select(docs[id_col].alias("doc_id"), text_of(text_col).alias("text"))
    return picked.mapInArrow(run, COUNTS.format(id=dict(docs.dtypes)[id_col]))


def document_totals(pieces: Pieces, totals: np.ndarray) -> np.ndarray:
    upto = np.concatenate(([0], np.cumsum(totals[pieces.numbers])))
    ends = np.cumsum(pieces.counts)
    return upto[ends] - upto[ends - pieces.counts]
