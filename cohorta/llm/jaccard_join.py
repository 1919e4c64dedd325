"""Self-join of documents on the Jaccard similarity of their word n-grams, by set relations.

Candidates come from prefixes in one global order of the n-grams. Sets that may be similar meet in
groups, and there a set's overlaps with all others are derived from those of a similar set: only the
lists of the n-grams in which the two differ are read. Lists are sorted by set size, and a search in
them skips to the block of sets whose sizes can match.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohorta.llm.bpe import ragged
from cohorta.llm.common import release, text_of, travels
from cohorta.llm.components import components
from cohorta.session import materialise

travels(__name__)

PERCENT = 80  # least similarity
WORDS = 5
GROUP_MEMBERS = 4096  # sets that meet in one task
GROUP_GRAMS = 3_000_000  # n-grams that meet in one task, all sets together
FREQUENT = 2_000_000  # an n-gram with at least this share (1 / FREQUENT) of all occurrences is frequent
LEAST_FREQUENT = 32
CHUNK = 2048  # documents whose n-grams travel together
BUCKET_TOKENS = 2_000_000  # prefix n-grams that meet in one task

PARTS = 4  # a bucket's lists are sorted in so many parts, one after another
SHORT = 4  # documents of a list whose pairs are counted one by one; those of longer lists are tied to their first
MARK_BITS = 26  # documents whose texts are needed are marked in 2 ** 26 bits, whatever their number
BLOCK_BYTES = 1_000_000  # texts hashed together

_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
# Bytes as numbers above 0, A-Z as a-z.
_LOWERED = np.array([b + 33 if 65 <= b <= 90 else b + 1 for b in range(256)], np.uint64)
_KEPT: dict = {}  # made once per task
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                     0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _FACTORS[1]
    x = (x ^ (x >> np.uint64(29))) * _FACTORS[2]
    return x ^ (x >> np.uint64(32))


def _blocks(texts: list[bytes]) -> Iterator[list[bytes]]:
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > BLOCK_BYTES:
            yield texts[start:i]
            start, size = i, 0
        size += len(text)
    yield texts[start:]


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """For each UTF-8 text the sorted different 64-bit hashes of its n-grams.

    All words of a block are hashed at once: a word's hash is the sum of its bytes times powers of
    an odd number, moved to power 0 by the inverse, and mixed.
    """
    out: list[np.ndarray] = []
    for block in _blocks(texts):
        out += _block_sets(block, words)
    return out


def _block_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    inside = np.concatenate(([False], ~_SPACE[data]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, stops = edges[::2], edges[1::2]
    powers, inverses = _powers(len(data))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_LOWERED[data] * powers[:len(data)])))
    hashes = _mixed((sums[stops] - sums[starts]) * inverses[starts] + (stops - starts).astype(np.uint64))
    counts = np.diff(np.searchsorted(starts, ends), prepend=0)
    first = np.cumsum(counts) - counts
    # n-grams of all windows of words; those that would cross texts are left out below.
    windows = max(len(hashes) - words + 1, 0)
    grams = np.full(windows, words, np.uint64)
    for k in range(words):
        grams = (grams ^ (grams >> np.uint64(29))) * _FACTORS[k % len(_FACTORS)] + hashes[k:windows + k]
    grams = _mixed(grams)
    out = []
    for a, n in zip(first.tolist(), counts.tolist()):
        if n >= words:
            out.append(np.unique(grams[a:a + n - words + 1]))
        elif n:
            short = np.full(1, n, np.uint64)
            for k in range(n):
                short = (short ^ (short >> np.uint64(29))) * _FACTORS[k % len(_FACTORS)] + hashes[a + k:a + k + 1]
            out.append(_mixed(short))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2 ** 64, at least n of each."""
    if len(_KEPT.get("powers", ((), ()))[0]) < n:
        size = max(n, BLOCK_BYTES * 5 // 4)
        made = []
        for base in (int(_FACTORS[0]), pow(int(_FACTORS[0]), -1, 2**64)):
            powers = np.full(size, base, np.uint64)
            powers[0] = 1
            made.append(np.cumprod(powers))
        _KEPT["powers"] = tuple(made)
    return _KEPT["powers"]


def _least_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    """n-grams that a set of n must share with any similar one."""
    return -(-n * percent // 100)


def _extra(n: np.ndarray) -> np.ndarray:
    """How many n-grams of a prefix must be shared: prefixes are longer than needed by this less one."""
    return np.maximum(n * 15 // 100, 1)


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return np.minimum(n - _least_overlap(n, percent) + _extra(n), n)


def in_order(shingles: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The global order: frequent n-grams after all others, else by hash."""
    if not len(frequent):
        return shingles
    at = np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)
    often = frequent[at] == shingles
    return np.concatenate((shingles[~often], shingles[often]))


class Members:
    """Sets that may be similar, sorted by size, with an index of their n-grams.

    A list's entries are numbers ``list * members + member``, all lists in one sorted array: the
    entries of a list between two members are found by search, and what lies outside is not read.
    """

    def __init__(self, ids: np.ndarray, sets: list[np.ndarray], percent: int):
        sizes = np.array([len(s) for s in sets], np.int64)
        order = np.lexsort((ids, sizes))
        self.ids, self.sizes, self.percent = ids[order], sizes[order], percent
        flat = np.concatenate([sets[i] for i in order])
        by = np.argsort(flat, kind="stable")  # inside a list: by size
        flat = flat[by]
        new = np.ones(len(flat), bool)
        new[1:] = flat[1:] != flat[:-1]
        del flat
        lists = np.cumsum(new) - 1
        numbers = np.empty(len(by), np.int32)
        numbers[by] = lists
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))
        self.numbers = numbers  # the lists of member i: numbers[starts[i] : starts[i + 1]]
        self.entries = lists * len(order) + np.repeat(np.arange(len(order)), self.sizes)[by]
        self.read = 0  # entries read so far

    def window(self, i: int) -> tuple[int, int]:
        """Members whose size allows similarity with member i."""
        n = self.sizes[i]
        return (int(np.searchsorted(self.sizes, -(-n * self.percent // 100))),
                int(np.searchsorted(self.sizes, n * 100 // self.percent, "right")))

    def lists_of(self, i: int) -> np.ndarray:
        return self.numbers[self.starts[i]:self.starts[i + 1]].astype(np.int64)

    def count(self, lists: np.ndarray, low: int, high: int) -> np.ndarray:
        """In how many of the lists each member from ``low`` to ``high`` is."""
        if high <= low or not len(lists):
            return np.zeros(max(high - low, 0), np.int64)
        first = np.searchsorted(self.entries, lists * len(self.ids) + low)
        last = np.searchsorted(self.entries, lists * len(self.ids) + high)
        found = ragged(self.entries, first, last - first) - np.repeat(lists * len(self.ids) + low, last - first)
        self.read += len(found)
        return np.bincount(found, minlength=high - low)

    def overlaps(self, i: int) -> tuple[int, np.ndarray]:
        """The first member of i's window and the shared n-grams of i with the members of the window."""
        low, high = self.window(i)
        return low, self.count(self.lists_of(i), low, high)

    def derived(self, i: int, j: int, of_j: tuple[int, np.ndarray]) -> tuple[int, np.ndarray]:
        """The same from those of member j.

        Inside j's window only lists of n-grams in one of the two sets are read; what i's window has
        beyond it is counted over i's lists.
        """
        low, high = self.window(i)
        mine, its = self.lists_of(i), self.lists_of(j)
        start, stop = max(low, of_j[0]), min(high, of_j[0] + len(of_j[1]))
        if stop <= start:
            return low, self.count(mine, low, high)
        both = (of_j[1][start - of_j[0]:stop - of_j[0]]
                + self.count(np.setdiff1d(mine, its, assume_unique=True), start, stop)
                - self.count(np.setdiff1d(its, mine, assume_unique=True), start, stop))
        return low, np.concatenate((self.count(mine, low, start), both, self.count(mine, stop, high)))

    def similar(self, i: int, shared: tuple[int, np.ndarray]) -> np.ndarray:
        low, part = shared
        near = (100 + self.percent) * part >= self.percent * (self.sizes[i] + self.sizes[low:low + len(part)])
        near &= part > 0
        return low + np.flatnonzero(near)

    def _hopeless(self, i: int, j: int, of_j: tuple[int, np.ndarray], label: np.ndarray) -> bool:
        """No member without a class can be similar to i: its overlap with i is at most that with j and
        the n-grams that i has and j has not."""
        low, high = self.window(i)
        outside = low + np.flatnonzero(label[low:high] < 0)
        if not len(outside):
            return True
        start, shared = of_j
        new = int(self.sizes[i] - shared[i - start])
        bound = np.minimum(self.sizes[outside], self.sizes[i])
        known = (outside >= start) & (outside < start + len(shared))
        bound[known] = np.minimum(bound[known], shared[outside[known] - start] + new)
        return not ((100 + self.percent) * bound >= self.percent * (self.sizes[i] + self.sizes[outside])).any()

    def classes(self) -> np.ndarray:
        """The class of each member (its smallest member's place): links of all pairs are followed."""
        n = len(self.ids)
        label = np.full(n, -1)
        for leader in range(n):
            if label[leader] >= 0:
                continue
            label[leader] = leader
            of_leader = self.overlaps(leader)
            todo = [(int(x), leader, of_leader) for x in self.similar(leader, of_leader) if label[x] < 0]
            label[[x for x, _, _ in todo]] = leader
            while todo:
                i, j, of_j = todo.pop()
                if self._hopeless(i, j, of_j, label):
                    continue
                shared = self.derived(i, j, of_j)
                for x in self.similar(i, shared):
                    if label[x] < 0:
                        label[x] = leader
                        todo.append((int(x), i, shared))
        return label


def _sets_of(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(b, np.uint64) for b in _buffers(column)]


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(text_col).cast("binary").alias("text"))


def _first_pass(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """Two kinds of rows in one reading of the texts.

    With ``n_shingles``: doc_id, n_shingles and set_key (128 bits of a hash of the whole set; null
    for an empty one). Without: an n-gram (in doc_id) and in how many texts of a chunk it is, for
    those in two or more.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, CHUNK):
                part = batch.slice(i, CHUNK)
                sets = shingle_sets(part.column(1).to_pylist(), words)
                keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()),
                     pa.nulls(len(sets), pa.int64())], names=["doc_id", "n_shingles", "set_key", "n"])
                found, n = np.unique(np.concatenate(sets), return_counts=True)
                found, n = found[n > 1].view(np.int64), n[n > 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found), pa.nulls(len(n), pa.int64()), pa.nulls(len(n), pa.binary()), pa.array(n)],
                    names=["doc_id", "n_shingles", "set_key", "n"])

    return _texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_shingles long, set_key binary, n long")


def frequent_shingles(chunks: DataFrame, occurrences: int) -> np.ndarray:
    """Sorted n-grams found in so many texts that at most ``FREQUENT`` can be.

    Counted over all texts; what occurs once in a chunk of texts is not counted there. The order
    that follows from the list need only be the same for all texts.
    """
    least = max(LEAST_FREQUENT, -(-occurrences // FREQUENT))
    counted = chunks.groupBy("doc_id").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("doc_id")
    return np.sort(counted.toArrow().column(0).to_numpy().astype(np.int64).view(np.uint64))


def _is_frequent(tokens: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return np.zeros(len(tokens), bool)
    return frequent[np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)] == tokens


def _prefix_blobs(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int, frequent: np.ndarray,
                  buckets: int) -> DataFrame:
    """The prefixes of all texts, one row per chunk and bucket of n-grams.

    ``documents`` has the chunk's ids and set sizes once, ``owner`` points into it. A frequent
    n-gram's documents are dealt over all buckets. Of equal sets in a chunk only the one of the
    smallest id is sent.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, CHUNK):
                ids = batch.column(0).slice(i, CHUNK).to_pylist()
                sets = shingle_sets(batch.column(1).slice(i, CHUNK).to_pylist(), words)
                first: dict[bytes, tuple[int, np.ndarray]] = {}
                for doc_id, s in sorted(zip(ids, sets), key=lambda x: x[0]):
                    if len(s):
                        first.setdefault(s.tobytes(), (doc_id, s))
                chosen = list(first.values())
                if not chosen:
                    continue
                starts = [in_order(s, shared.value)[:prefix_length(np.int64(len(s)), percent)] for _, s in chosen]
                tokens = np.concatenate(starts)
                owner = np.repeat(np.arange(len(chosen), dtype=np.uint16), [len(s) for s in starts])
                documents = np.array([(d, len(s)) for d, s in chosen], np.int64)
                spread = _mixed(documents[:, 0].view(np.uint64))[owner] * _is_frequent(tokens, shared.value)
                bucket = (((tokens >> np.uint64(20)) + (spread >> np.uint64(20))) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                tokens, owner, bucket = tokens[order], owner[order], bucket[order]
                cuts = np.flatnonzero(np.diff(bucket)) + 1
                numbers = bucket[np.concatenate(([0], cuts))]
                rows = []
                for t, o in zip(np.split(tokens, cuts), np.split(owner, cuts)):
                    used, o = np.unique(o, return_inverse=True)
                    rows.append((t.tobytes(), o.astype("<u2").tobytes(),
                                 documents[used, 0].tobytes() + documents[used, 1].astype("<i4").tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers), *[pa.array(c, pa.binary()) for c in zip(*rows)]],
                    names=["bucket", "tokens", "owner", "documents"])

    return _texts(docs, id_col, text_col).mapInArrow(run, "bucket long, tokens binary, owner binary, documents binary")


def _buffers(column: pa.ChunkedArray) -> Iterator[memoryview]:
    """The values of a binary column without copies."""
    return (value.as_buffer() for chunk in column.chunks for value in chunk)


def _linked(tokens: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Of entries sorted by n-gram and set size: whether one may be similar to the one before it.

    Runs of such entries are the blocks of a list: members of different blocks differ too much in
    size, whatever lies between them.
    """
    out = np.zeros(len(tokens), bool)
    out[1:] = (tokens[1:] == tokens[:-1]) & (100 * sizes[:-1] >= percent * sizes[1:])
    return out


def _shared_lists(blobs: DataFrame, percent: int, frequent: np.ndarray) -> DataFrame:
    """token, doc_id, size for all prefix n-grams of two documents of like sizes, and frequent ones.

    ``long`` tells blocks of more than ``SHORT`` entries and frequent n-grams.
    """
    shared = blobs.sparkSession.sparkContext.broadcast(frequent)

    def run(table: pa.Table) -> pa.Table:
        parts = []
        for part in range(PARTS):  # by other bits than those of the bucket
            tokens, ids, sizes = [], [], []
            for t, o, d in zip(*[_buffers(table.column(c)) for c in ("tokens", "owner", "documents")]):
                n = len(d) // 12
                t, owner = np.frombuffer(t, np.uint64), np.frombuffer(o, "<u2")
                chosen = np.flatnonzero(t % np.uint64(PARTS) == part)
                tokens.append(t[chosen])
                ids.append(np.frombuffer(d, np.int64, n)[owner[chosen]])
                sizes.append(np.frombuffer(d, "<i4", n, 8 * n)[owner[chosen]])
            tokens, ids, sizes = np.concatenate(tokens), np.concatenate(ids), np.concatenate(sizes).astype(np.int64)
            order = np.lexsort((sizes, tokens))
            tokens, ids, sizes = tokens[order], ids[order], sizes[order]
            linked = _linked(tokens, sizes, percent)
            often = _is_frequent(tokens, shared.value)
            several = linked | np.append(linked[1:], False) | often
            block = np.cumsum(~linked) - 1
            long = often | (np.bincount(block)[block] > SHORT) if len(block) else often
            parts.append(pa.table({"token": pa.array(tokens[several].view(np.int64)), "doc_id": pa.array(ids[several]),
                                   "size": pa.array(sizes[several]), "long": pa.array(long[several])}))
        return pa.concat_tables(parts)

    return blobs.groupBy("bucket").applyInArrow(run, "token long, doc_id long, size long, long boolean")


def _pairs_of(tokens: np.ndarray, ids: np.ndarray, sizes: np.ndarray, rest: np.ndarray, percent: int) -> list[np.ndarray]:
    """Of entries sorted by n-gram and size all pairs of like sizes: the smaller id with its set's size, the other
    with its own, the lesser ``rest`` and the n-grams that they share."""
    found = []
    for step in range(1, len(tokens)):
        near = (tokens[step:] == tokens[:-step]) & (100 * sizes[:-step] >= percent * sizes[step:])
        if not near.any():
            break
        found.append(np.stack((np.flatnonzero(near), np.flatnonzero(near) + step)))
    x, y = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    x, y = np.where(ids[x] < ids[y], x, y), np.where(ids[x] < ids[y], y, x)
    x, y = x[ids[x] != ids[y]], y[ids[x] != ids[y]]
    columns = [ids[x], ids[y], sizes[x], sizes[y], np.minimum(rest[x], rest[y])]
    order = np.lexsort(columns[:4])
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns[:4]])
    first = np.flatnonzero(new)
    return [*[c[first] for c in columns], np.diff(np.append(first, len(order)))]


def _group_edges(lists: DataFrame, percent: int, frequent: np.ndarray, buckets: int) -> DataFrame:
    """Edges that tie all documents that may be similar together.

    Two sets may be similar if they share enough prefix n-grams: those shared in short blocks, which are
    counted, and at most those that the lesser of the two has in long ones (``rest``). If a pair shares
    none in short blocks, both have enough in long ones; the entries of such documents in a long
    block are tied together. The lists of frequent n-grams are dealt over all buckets; there each part's
    blocks are tied, then the blocks of all parts by their sizes.
    """
    shared = lists.sparkSession.sparkContext.broadcast(frequent)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = batch.column(0).to_numpy().view(np.uint64)
            often = _is_frequent(tokens, shared.value)
            spread = _mixed(batch.column(1).to_numpy().view(np.uint64)) * often
            bucket = (((tokens >> np.uint64(20)) + (spread >> np.uint64(20))) % np.uint64(buckets)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(often), pa.array(bucket)],
                                             names=[*batch.schema.names, "often", "bucket"])

    def tie(table: pa.Table) -> pa.Table:
        tokens, ids, sizes, long, rest, often = (
            table.column(c).to_numpy() for c in ("token", "doc_id", "size", "long", "rest", "often"))
        order = np.lexsort((ids, sizes, tokens))
        tokens, ids, sizes, long, rest, often = (x[order] for x in (tokens, ids, sizes, long, rest, often))
        counted = _pairs_of(*[x[~long] for x in (tokens, ids, sizes, rest)], percent)
        tokens, ids, sizes, often = (x[long] for x in (tokens, ids, sizes, often))
        first = np.flatnonzero(~_linked(tokens, sizes, percent))
        last = np.append(first[1:], len(tokens)) - 1
        centre = np.repeat(ids[first], np.diff(np.append(first, len(tokens))))
        pairs = np.unique(np.stack((ids, centre), axis=1)[ids != centre], axis=0)
        first, last = first[often[first]], last[often[first]]
        none = [None] * len(pairs)
        stars = pa.table({"a": pa.array(np.concatenate((pairs[:, 0], ids[first]))),
                          "b": pa.array(np.concatenate((pairs[:, 1], ids[first]))),
                          "token": pa.array(none + tokens[first].tolist(), pa.int64()),
                          "low": pa.array(none + sizes[first].tolist(), pa.int64()),
                          "high": pa.array(none + sizes[last].tolist(), pa.int64()),
                          "rest": pa.nulls(len(pairs) + len(first), pa.int64()),
                          "n": pa.nulls(len(pairs) + len(first), pa.int64())})
        a, b, low, high, rest, n = (pa.array(c.astype(np.int64)) for c in counted)
        return pa.concat_tables([stars, pa.table({"a": a, "b": b, "token": pa.nulls(len(a), pa.int64()), "low": low,
                                                  "high": high, "rest": rest, "n": n})])

    def tie_blocks(table: pa.Table) -> pa.Table:
        tokens, ids, low, high = (table.column(c).to_numpy() for c in ("token", "a", "low", "high"))
        order = np.lexsort((high, low, tokens))
        tokens, ids, low, high = tokens[order], ids[order], low[order], high[order]
        same = np.concatenate(([False], tokens[1:] == tokens[:-1]))
        run = np.cumsum(~same)
        reach = np.maximum.accumulate(run * (int(high.max()) + 1) + high) - run * (int(high.max()) + 1)
        near = same.copy()
        near[1:] &= 100 * reach[:-1] >= percent * low[1:]
        at = np.flatnonzero(near)
        pairs = np.unique(np.stack((ids[at], ids[at - 1]), axis=1), axis=0) if len(at) else np.zeros((0, 2), np.int64)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    placed = lists.mapInArrow(
        place, "token long, doc_id long, size long, long boolean, rest long, often boolean, bucket long")
    tied = materialise(placed.groupBy("bucket").applyInArrow(
        tie, "a long, b long, token long, low long, high long, rest long, n long"))
    counted = tied.filter("n is not null").groupBy("a", "b", "low", "high").agg(
        F.sum("n").alias("n"), F.max("rest").alias("rest"))
    near = counted.filter(F.col("n") + F.col("rest") >= _needed(F.least("low", "high"))).select("a", "b")
    blocks = tied.filter("token is not null").withColumn("bucket", F.pmod(F.xxhash64("token"), F.lit(buckets)))
    across = blocks.groupBy("bucket").applyInArrow(tie_blocks, "a long, b long")
    return tied.filter("token is null and n is null").select("a", "b").unionByName(across).unionByName(near)


def _needed(size: Column) -> Column:
    """How many prefix n-grams a similar pair shares whose smaller set has ``size``: what both prefixes are
    longer than needed by."""
    return F.greatest(F.floor(size * 15 / 100), F.lit(1))


def _marked(members: DataFrame) -> np.ndarray:
    """A bit for every hash of an id: most other texts need not be sent to be found without a member."""
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(1 << MARK_BITS))
    words = (members.select(bit.alias("b")).selectExpr("shiftright(b, 6) as w", "shiftleft(1L, cast(b & 63 as int)) as m")
             .groupBy("w").agg(F.bit_or("m").alias("m")).toArrow())
    marks = np.zeros(1 << MARK_BITS - 6, np.uint64)
    marks[words.column(0).to_numpy()] = words.column(1).to_numpy().view(np.uint64)
    return marks


def _by_mark(rows: DataFrame, shared: Broadcast, marked: bool) -> DataFrame:
    """The rows whose doc_id has, or has not, its mark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = batch.column(batch.num_columns - 1).to_numpy()
            found = shared.value[bit >> 6] >> (bit & 63).astype(np.uint64) & np.uint64(1)
            yield batch.select(range(batch.num_columns - 1)).filter(pa.array(found.astype(bool) == marked))

    bit = F.pmod(F.xxhash64("doc_id"), F.lit(1 << MARK_BITS))
    return rows.withColumn("_bit", bit).mapInArrow(run, rows.schema)


def _texts_of(members: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows of ``texts`` that may be members'; some others pass."""
    return _by_mark(texts, texts.sparkSession.sparkContext.broadcast(_marked(members)), True)


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` but those with a doc_id of ``ids``; only texts that may have one are shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(_marked(ids))
    return _by_mark(docs, shared, False).unionByName(_by_mark(docs, shared, True).join(ids, "doc_id", "left_anti"))


def _with_sets(rows: DataFrame, keep: list[str], words: int) -> DataFrame:
    """The named long columns and the set of each row's text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, CHUNK):
                part = batch.slice(i, CHUNK)
                sets = shingle_sets(part.column(len(keep)).to_pylist(), words)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(keep)], pa.array([s.tobytes() for s in sets], pa.binary())], names=[*keep, "s"])

    return rows.select(*keep, "text").mapInArrow(run, ", ".join(f"{c} long" for c in keep) + ", s binary")


def _forest(table: pa.Table, percent: int, part: str) -> pa.Table:
    """Edges of each member to its class, for every value of column ``part`` by itself."""
    parts = table.column(part).to_numpy()
    ids, sets = table.column("doc_id").to_numpy(), _sets_of(table.column("s"))
    a, b = [], []
    for value in np.unique(parts):
        at = np.flatnonzero(parts == value)
        members = Members(ids[at], [sets[i] for i in at], percent)
        label = members.classes()
        a.append(members.ids)
        b.append(members.ids[label])
    return pa.table({"a": pa.array(np.concatenate(a)), "b": pa.array(np.concatenate(b))})


def _block_forest(table: pa.Table, percent: int) -> pa.Table:
    """The forest of one block, and with the first member of the largest class its set."""
    found = _forest(table, percent, "part")
    roots, n = np.unique(found.column("b").to_numpy(), return_counts=True)
    leader = int(roots[np.argmax(n)])
    at = int(np.flatnonzero(table.column("doc_id").to_numpy() == leader)[0])
    first = np.flatnonzero(found.column("a").to_numpy() == leader)[0]
    sets = [None] * len(found)
    sets[first] = table.column("s")[at].as_py()
    names = {c: pa.array(np.full(len(found), table.column(c)[0].as_py())) for c in _BLOCK}
    return pa.table(names | {"a": found.column("a"), "b": found.column("b"), "s": pa.array(sets, pa.binary())})


def _cross_edges(table: pa.Table, percent: int) -> pa.Table:
    """Edges between two blocks of a group (column ``side``), but for those between insiders."""
    ids, sets = table.column("doc_id").to_numpy(), _sets_of(table.column("s"))
    outer, side = table.column("outer").to_numpy(), table.column("side").to_numpy()
    members = Members(ids, sets, percent)
    insiders = bool((~outer & (side == 0)).any())
    asks = set(ids[outer & ((side == 0) | insiders)].tolist())
    a, b = [], []
    for i in range(len(members.ids)):
        if int(members.ids[i]) in asks:
            near = members.similar(i, members.overlaps(i))  # skips to the block of i's sizes in each list
            a += [int(members.ids[i])] * len(near)
            b += members.ids[near].tolist()
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


_BLOCK = ["part", "class", "sub"]


def _placed(members: DataFrame, percent: int, most: int, grams: int) -> DataFrame:
    """The block of each set: doc_id, size, part, class, sub. A block has about ``most`` sets or
    ``grams`` n-grams, whichever is reached first.

    A group that is small enough is one block (class -1). Others are cut by size classes, so that
    only sets of the same class or of neighbouring ones can be similar, and a class by hashes.
    """
    def number(by: list[str], name: str) -> DataFrame:
        return members.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("grams")).select(
            *by, F.ceil(F.greatest(F.col("n") / most, F.col("grams") / grams)).cast("long").alias(name))

    step = math.log(100 / percent) * (1 + 1e-9)
    members = members.withColumn("class", F.floor(F.log("size") / F.lit(step)).cast("long"))
    sized = members.join(number(["part"], "blocks"), "part").join(number(["part", "class"], "subs"), ["part", "class"])
    large = F.col("blocks") > 1
    return sized.select("doc_id", "size", "part", F.when(large, F.col("class")).otherwise(-1).alias("class"),
                        F.when(large, F.pmod(F.xxhash64("doc_id"), "subs")).otherwise(0).alias("sub")).distinct()


def _large_groups(sets: DataFrame, percent: int) -> DataFrame:
    """All links' forest in groups of several blocks: part, class, sub, doc_id, s.

    Blocks are resolved side by side, then the first members of their largest classes with each
    other. Sets that are still outside their group's largest class meet the blocks of their own and of
    the neighbouring size classes.
    """
    inside = materialise(sets.groupBy(*_BLOCK).applyInArrow(
        lambda t: _block_forest(t, percent), "part long, class long, sub long, a long, b long, s binary"))
    leaders = inside.filter("s is not null").select("part", F.col("a").alias("doc_id"), "s")
    between = leaders.groupBy("part").applyInArrow(lambda t: _forest(t, percent, "part"), "a long, b long")
    first = materialise(inside.select("a", "b").unionByName(between))
    label = components(first).select(F.col("node").alias("doc_id"), F.col("component").alias("label"))
    labelled = inside.select(*_BLOCK, F.col("a").alias("doc_id")).distinct().join(label, "doc_id", "left").withColumn(
        "label", F.coalesce("label", "doc_id"))
    largest = (labelled.groupBy("part", "label").agg(F.countDistinct("doc_id").alias("n"))
               .groupBy("part").agg(F.max_by("label", F.struct("n", "label")).alias("main")))
    marked = materialise(labelled.join(largest, "part").select(*_BLOCK, "doc_id", (F.col("label") != F.col("main")).alias("outer")))
    blocks = materialise(marked.groupBy(*_BLOCK).agg(F.max("outer").alias("some")))
    # Pairs of blocks, the one of the smaller (class, sub) first; two blocks of insiders need not meet.
    x = blocks.select("part", F.explode(F.array("class", F.col("class") + 1)).alias("class"),
                      F.col("class").alias("x_class"), F.col("sub").alias("x_sub"), F.col("some").alias("x_some"))
    pairs = (x.join(blocks, ["part", "class"]).filter((F.col("some") | F.col("x_some")) & (
        (F.col("x_class") < F.col("class")) | (F.col("x_sub") < F.col("sub"))))
        .select("part", "x_class", "x_sub", F.col("class").alias("y_class"), F.col("sub").alias("y_sub")))
    sides = pairs.select("part", F.struct("x_class", "x_sub", "y_class", "y_sub").alias("pair"), F.explode(F.array(
        F.struct(F.col("x_class").alias("class"), F.col("x_sub").alias("sub"), F.lit(0).alias("side")),
        F.struct(F.col("y_class").alias("class"), F.col("y_sub").alias("sub"), F.lit(1).alias("side")))).alias("e")).select(
        "part", "pair", "e.*")
    routes = marked.join(sides, _BLOCK).groupBy(*_BLOCK, "doc_id").agg(
        F.collect_list(F.struct("pair", "side", "outer")).alias("routes"))
    across = (sets.join(routes, [*_BLOCK, "doc_id"]).select("part", "doc_id", "s", F.explode("routes").alias("r"))
              .select("part", "r.*", "doc_id", "s")
              .groupBy("part", "pair").applyInArrow(lambda t: _cross_edges(t, percent), "a long, b long"))
    return first.unionByName(across)


def similar_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    percent: int = PERCENT, most: int = GROUP_MEMBERS, grams: int = GROUP_GRAMS) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (the smallest id reachable by links).

    Two documents link when their sets' similarity is at least ``percent``; equal sets, empty ones
    apart, always do. Null and empty texts have an empty set and link with nothing, as do rows
    without an id (their component is null). Rows that repeat an id are one document: what any of
    them links with, it links with. An empty table gives no rows. No pair is left out: prefixes are
    long enough for every similar pair, and groups of any size are resolved in blocks of about ``most``
    sets or ``grams`` n-grams, whichever is less; a single longer set is a block of its own size.
    """
    known = docs.filter(docs[id_col].isNotNull())
    read = materialise(_first_pass(docs, id_col, text_col, words))
    table = read.filter("n_shingles is not null").drop("n")
    total = table.agg(F.sum("n_shingles")).first()[0] or 0
    frequent = frequent_shingles(read.filter("n is not null"), total)
    buckets = max(-(-total // (3 * BUCKET_TOKENS)), 16)
    members = _members(_prefix_blobs(known, id_col, text_col, words, percent, frequent, buckets), percent, frequent,
                       buckets)
    members = materialise(_placed(members, percent, most, grams))
    release(docs.sparkSession)
    texts = _texts_of(members, _texts(known, id_col, text_col))
    # An id with several texts meets the rows of each; the one of the row's size is meant.
    sets = materialise(_with_sets(texts.join(members, "doc_id"), ["doc_id", "size", *_BLOCK], words)
                       .filter(F.octet_length("s") == 8 * F.col("size")))
    release(docs.sparkSession)
    bins, several = members.agg(F.coalesce(F.floor(F.sum("size") / grams), F.lit(0)).cast("long") + 1,
                                F.max(F.col("class") >= 0)).first()
    edges = _edges(sets, percent, bins, bool(several))

    # Written first, so that the join by itself can be split where very many sets are equal.
    known_sets = table.filter("doc_id is not null and set_key is not null")
    reps = materialise(known_sets.groupBy("set_key").agg(F.min("doc_id").alias("rep")))
    # An id with several sets ties their classes.
    several = known_sets.groupBy("doc_id").agg(F.min("set_key").alias("k"), F.max("set_key").alias("m")).filter("k <> m")
    its_sets = known_sets.join(several.select("doc_id"), "doc_id").join(reps, "set_key").select("doc_id", "rep").distinct()
    centre = its_sets.groupBy("doc_id").agg(F.min("rep").alias("b"))
    edges = edges.unionByName(its_sets.join(centre, "doc_id").select(F.col("rep").alias("a"), "b"))
    classes = components(edges).select(F.col("node").alias("rep"), "component")
    del sets, edges  # the classes are written by now
    release(docs.sparkSession)
    found = (table.join(reps, "set_key", "left").join(classes, "rep", "left")
             .select("doc_id", "n_shingles", F.coalesce("component", "rep", "doc_id").alias("component_id")))
    return found


def _members(blobs: DataFrame, percent: int, frequent: np.ndarray, buckets: int) -> DataFrame:
    """doc_id, size and part: the sets that may be similar to another one, by groups.

    What a step has read is let go at its end, so that at most two of them take disk at a time.
    """
    spark = blobs.sparkSession
    lists = materialise(_shared_lists(blobs, percent, frequent))
    del blobs
    release(spark)
    # A similar pair shares as many prefix n-grams as the smaller of the two prefixes is longer than needed.
    needed = _needed(F.ceil(F.col("size") * percent / 100))
    counts = lists.groupBy("doc_id", "size").agg(F.count(F.lit(1)).alias("n"), F.count_if("long").alias("rest"))
    possible = materialise(counts.filter(F.col("n") >= needed).select("doc_id", "size", "rest"))
    left = materialise(lists.join(possible, ["doc_id", "size"]).filter(~F.col("long") | (F.col("rest") >= needed))
                       .select("token", "doc_id", "size", "long", "rest"))
    del lists, counts
    release(spark)
    edges = _group_edges(left, percent, frequent, buckets)
    groups = materialise(components(edges))
    del left, edges
    release(spark)
    return groups.select(F.col("node").alias("doc_id"), F.col("component").alias("part")).join(
        possible.select("doc_id", "size"), "doc_id")


def _edges(sets: DataFrame, percent: int, bins: int, several: bool) -> DataFrame:
    """Links' forest of all groups. Those of one block meet in bins, filled by their n-grams."""
    small = sets.filter("class < 0").withColumn("bin", F.pmod(F.xxhash64("part"), F.lit(bins)))
    edges = small.groupBy("bin").applyInArrow(lambda t: _forest(t, percent, "part"), "a long, b long")
    if several:
        edges = edges.unionByName(_large_groups(sets.filter("class >= 0"), percent))
    return edges
