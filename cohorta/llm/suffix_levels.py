"""Repeated byte strings by a logarithmic family of sampled suffix arrays.

Positions are sampled so that equal windows of ``LENGTH`` bytes sample the same place: the smallest
fingerprint of ``GRAM`` bytes in the window. A suffix entry stands for all windows that sample its
position; it has the fingerprint of the suffix's first bytes (the order of the arrays), the
fingerprint of the whole stretch that its windows cover, and where it is. Batches of documents
become sorted arrays, which are scanned against the levels before them; levels of like size merge.

A stretch that occurred before is repeated as a whole. Stretches that share only their first bytes
are fetched, and a suffix array of their bytes (prefix doubling up to ``LENGTH``) tells exactly which
of their windows are equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohorta.llm.bpe import ragged
from cohorta.llm.common import release, stored, text_of, travels

travels(__name__)

LENGTH = 100  # bytes of a match
GRAM = 24
SAMPLED = LENGTH - GRAM + 1  # fingerprints in a window
BATCHES = 8
CHUNK_BYTES = 6_000_000  # documents whose entries travel together
BLOCK_BYTES = 1_000_000  # documents that are sampled together; several numbers per byte are held
GROUP_BYTES = 8_000_000  # text of the documents that are put together in one task
COMPARED_BYTES = 2_000_000  # stretches, by whole keys, whose windows are ranked together
BUCKET_BYTES = 16_000_000  # text behind the entries of one bucket

_M = np.uint64(0x9E3779B97F4A7C15)
_ENTRY = np.dtype([("key", "<u8"), ("stretch", "<u8"), ("doc", "<i8"), ("text", "<u8"), ("at", "<u4"),
                   ("before", "u1"), ("more", "u1"), ("batch", "<u2")])
_SPAN = np.dtype([("doc", "<i8"), ("text", "<u8"), ("start", "<u4"), ("end", "<u4")])
_PLACE = ("doc", "at")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_key(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def entries_of(texts: list[bytes], docs: np.ndarray, keys: np.ndarray, batches: np.ndarray) -> np.ndarray:
    """All entries of some documents."""
    flat = np.frombuffer(b"".join(texts), np.uint8)
    n, sizes = len(flat), np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    if n < LENGTH:
        return np.zeros(0, _ENTRY)
    # Fingerprints of GRAM bytes by doubling: 1, 2, 4, 8, 16 bytes; 24 = 16 + 8.
    h, width, factor, kept = flat.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15, {}
    while width < GRAM:
        if GRAM & width:
            kept[width] = (h, factor)
        h = h[:len(h) - width] * np.uint64(factor) + h[width:]
        factor, width = factor * factor % 2**64, width * 2
        if width * 2 > GRAM:
            break
    rest = GRAM - width
    if rest:
        part, power = kept[rest]
        power = pow(0x9E3779B97F4A7C15, rest, 2**64)
        h = h[:n - GRAM + 1] * np.uint64(power) + part[width:width + n - GRAM + 1]
    gram = _mixed(h[:n - GRAM + 1])
    # The sampled place of every window: least fingerprint, leftmost among equals.
    bits = np.uint64(max(24, int(n).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    best, width = (gram & ~low) | np.arange(len(gram), dtype=np.uint64), 1
    while width * 2 <= SAMPLED:
        best = np.minimum(best[:len(best) - width], best[width:])
        width *= 2
    best = np.minimum(best[:n - LENGTH + 1], best[SAMPLED - width:SAMPLED - width + n - LENGTH + 1])
    place = (best & low).astype(np.int64)
    windows = np.maximum(sizes - LENGTH + 1, 0)
    start = ragged(np.arange(n), starts, windows)  # windows that lie in one document
    if not len(start):
        return np.zeros(0, _ENTRY)
    owner = np.repeat(np.arange(len(texts)), windows)
    place = place[start]
    first = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (owner[1:] != owner[:-1]))))
    last = np.append(first[1:], len(place)) - 1
    at, lo, hi, owner = place[first], start[first], start[last], owner[first]
    # Fingerprint of the stretch [lo, hi + LENGTH) from sums of byte * power, moved to power 0.
    inverse = pow(int(_M), -1, 2**64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * _powers(n, int(_M)))))
    stretch = (sums[hi + LENGTH] - sums[lo]) * _powers(n, inverse)[lo]
    stretch = _mixed(stretch + _mixed((hi - lo).astype(np.uint64) * np.uint64(131) + (at - lo).astype(np.uint64)))
    out = np.zeros(len(at), _ENTRY)
    out["key"], out["stretch"], out["doc"], out["text"] = gram[at], stretch, docs[owner], keys[owner]
    out["at"], out["before"], out["more"], out["batch"] = at - starts[owner], at - lo, hi - lo, batches[owner]
    return out


def _ordered(entries: np.ndarray) -> np.ndarray:
    return entries[np.lexsort((entries["at"], entries["doc"], entries["stretch"], entries["key"]))]


def _firsts(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of ordered entries: which is the first of its stretch, and the first one's place for each."""
    new = np.ones(len(entries), bool)
    new[1:] = (entries["key"][1:] != entries["key"][:-1]) | (entries["stretch"][1:] != entries["stretch"][:-1])
    return new, np.maximum.accumulate(np.where(new, np.arange(len(entries)), 0))


def spans_of(entries: np.ndarray) -> np.ndarray:
    """The bytes that the windows of entries cover."""
    out = np.zeros(len(entries), _SPAN)
    out["doc"], out["text"] = entries["doc"], entries["text"]
    out["start"] = entries["at"] - entries["before"]
    out["end"] = out["start"] + entries["more"] + np.uint32(LENGTH)
    return out


def split_repeats(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first entry of each stretch, in order, and all later ones."""
    entries = _ordered(entries)
    new, first = _firsts(entries)
    later = ~new & ((entries["doc"] != entries["doc"][first]) | (entries["at"] != entries["at"][first]))
    return entries[new], entries[later]


class Levels:
    """Sorted arrays of first entries. Sizes fall from level to level; like sizes merge."""

    def __init__(self, levels: list[np.ndarray] | None = None):
        self.levels = levels or []

    def add(self, batch: np.ndarray) -> np.ndarray:
        """Scan a batch against all levels, then make it a level. Entries of stretches found before.

        Entries that turn up with an earlier place than a known one take its place (batches need
        not come in order); then the known one is what is found.
        """
        fresh, repeated = split_repeats(batch)
        found = [repeated]
        for i, level in enumerate(self.levels):
            at = self._places(level, fresh)
            there = np.flatnonzero(at >= 0)
            old, new = level[at[there]], fresh[there]
            later = (new["doc"] > old["doc"]) | ((new["doc"] == old["doc"]) & (new["at"] > old["at"]))
            same = (new["doc"] == old["doc"]) & (new["at"] == old["at"])
            found += [new[later], old[~later & ~same]]
            gone = np.zeros(len(level), bool)
            gone[at[there[~later & ~same]]] = True
            self.levels[i] = level[~gone]
            keep = np.ones(len(fresh), bool)
            keep[there[later | same]] = False
            fresh = fresh[keep]
        self.levels.append(fresh)
        while len(self.levels) > 1 and len(self.levels[-1]) * 2 > len(self.levels[-2]):
            small, large = self.levels.pop(), self.levels.pop()
            self.levels.append(_ordered(np.concatenate((large, small))))
        return np.concatenate(found)

    @staticmethod
    def _places(level: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Where each wanted stretch is in a level, or -1: one merge of two sorted arrays."""
        both = np.concatenate((level[["key", "stretch"]], wanted[["key", "stretch"]]))
        order = np.lexsort((np.arange(len(both)), both["stretch"], both["key"]))
        both = both[order]
        same = np.zeros(len(both), bool)
        same[1:] = (both["key"][1:] == both["key"][:-1]) & (both["stretch"][1:] == both["stretch"][:-1])
        out = np.full(len(wanted), -1)
        hit = np.flatnonzero(same)
        out[order[hit] - len(level)] = order[hit - 1]
        return out

    def alike(self) -> np.ndarray:
        """Entries whose first bytes begin another stretch too: only their bytes tell what repeats."""
        every = _ordered(np.concatenate(self.levels)) if self.levels else np.zeros(0, _ENTRY)
        same = np.zeros(len(every) + 1, bool)  # at i: entries i - 1 and i have the same key
        same[1:-1] = every["key"][1:] == every["key"][:-1]
        return every[same[:-1] | same[1:]] if len(every) else every


def equal_windows(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A number for each start: equal numbers mean equal ``LENGTH`` bytes from there.

    ``data`` is the joined stretches; every start has ``LENGTH`` bytes of its stretch after it. The
    ranks of a suffix array are doubled from 4 bytes to 64, then two of 64 bytes cover the window.
    """
    n = len(data)
    wide = np.concatenate((data, np.zeros(LENGTH, np.uint8))).astype(np.uint64)
    rank = (wide[:n] << np.uint64(24)) | (wide[1:n + 1] << np.uint64(16)) | (wide[2:n + 2] << np.uint64(8)) | wide[3:n + 3]
    width = 4
    while width < 64:
        second = np.concatenate((rank[width:], np.zeros(width, np.uint64)))
        rank = np.unique(rank << np.uint64(32) | second, return_inverse=True)[1].astype(np.uint64)
        width *= 2
    pair = rank[starts] << np.uint64(32) | rank[starts + LENGTH - 64]
    return np.unique(pair, return_inverse=True)[1]


def repeated_windows(entries: np.ndarray, stretches: list[bytes]) -> np.ndarray:
    """Spans of windows that are equal to a window of an earlier place."""
    data = np.frombuffer(b"".join(stretches), np.uint8)
    sizes = np.array([len(s) for s in stretches], np.int64)
    first = np.cumsum(sizes) - sizes
    windows = entries["more"].astype(np.int64) + 1
    owner = np.repeat(np.arange(len(entries)), windows)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    number = equal_windows(data, first[owner] + inside)
    doc = entries["doc"][owner]
    start = entries["at"][owner].astype(np.int64) - entries["before"][owner] + inside
    order = np.lexsort((start, doc, number))
    number, doc, start, owner = number[order], doc[order], start[order], owner[order]
    new = np.ones(len(order), bool)
    new[1:] = number[1:] != number[:-1]
    at = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    later = (doc != doc[at]) | (start != start[at])
    out = np.zeros(int(later.sum()), _SPAN)
    out["doc"], out["text"], out["start"] = doc[later], entries["text"][owner[later]], start[later]
    out["end"] = out["start"] + np.uint32(LENGTH)
    return joined(out)


def joined(spans: np.ndarray) -> np.ndarray:
    """The same bytes in as few spans as possible."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans["start"], spans["text"], spans["doc"]))]
    other = np.ones(len(spans), bool)
    other[1:] = (spans["doc"][1:] != spans["doc"][:-1]) | (spans["text"][1:] != spans["text"][:-1])
    group = np.cumsum(other).astype(np.int64) << 33
    reach = np.maximum.accumulate(group + spans["end"])
    fresh = other.copy()
    fresh[1:] |= group[1:] + spans["start"][1:] > reach[:-1]
    first = np.flatnonzero(fresh)
    out = spans[first].copy()
    out["end"] = reach[np.append(first[1:], len(spans)) - 1] - group[first]
    return out


def _group_of(docs: np.ndarray, groups: int) -> np.ndarray:
    return (_mixed(docs.astype(np.int64).view(np.uint64)) % np.uint64(groups)).astype(np.int64)


_SENT = [("key", "<u8"), ("stretch", "<u8"), ("owner", "<u4"), ("at", "<u4"), ("before", "u1"), ("more", "u1"),
         ("batch", "<u2")]


def packed(records: np.ndarray) -> bytes:
    """Entries by column, each document's id and key once; other records as they are."""
    if records.dtype != _ENTRY:
        return records.tobytes()
    documents, owner = np.unique(records[["doc", "text"]], return_inverse=True)
    columns = [owner.astype("<u4") if name == "owner" else records[name].astype(kind) for name, kind in _SENT]
    head = np.array([len(records), len(documents)], "<u4").tobytes()
    return b"".join([head, documents["doc"].tobytes(), documents["text"].tobytes(), *[c.tobytes() for c in columns]])


def unpacked(data: bytes) -> np.ndarray:
    n, m = np.frombuffer(data, "<u4", 2).tolist()
    out, at = np.zeros(n, _ENTRY), 8 + 16 * m
    for name, kind in _SENT:
        column = np.frombuffer(data, kind, n, at)
        at += column.nbytes
        if name == "owner":
            out["doc"] = np.frombuffer(data, "<i8", m, 8)[column]
            out["text"] = np.frombuffer(data, "<u8", m, 8 + 8 * m)[column]
        else:
            out[name] = column
    return out


def _rows(kind: int, target: np.ndarray, records: np.ndarray, extra: list[bytes] | None = None) -> pa.RecordBatch:
    """One row per target with its records' bytes (and, joined, the extra bytes of each record)."""
    order = np.argsort(target, kind="stable")
    target, records = target[order], records[order]
    cuts = np.flatnonzero(np.diff(target)) + 1
    first = np.concatenate(([0], cuts)).astype(np.int64)[:len(target)]
    more = [None] * len(first)
    if extra is not None:
        extra = [extra[i] for i in order.tolist()]
        more = [b"".join(extra[a:b]) for a, b in zip(first.tolist(), [*cuts.tolist(), len(extra)])]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(first), kind, np.int32)), pa.array(target[first]),
         pa.array([packed(x) for x in np.split(records, cuts)][:len(first)], pa.binary()), pa.array(more, pa.binary())],
        names=["kind", "target", "data", "extra"])


_SHAPE = "kind int, target long, data binary, extra binary"
_SPANS, _ENTRIES, _LEVEL = 0, 1, 2


def _records(column: pa.ChunkedArray, kind: np.dtype) -> np.ndarray:
    if kind == _ENTRY:
        return np.concatenate([np.zeros(0, _ENTRY), *map(unpacked, column.to_pylist())])
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _texts(docs: DataFrame, id_col: str, text_col: str, groups: int) -> DataFrame:
    rows = docs.filter(docs[id_col].isNotNull()).select(
        docs[id_col].cast("long").alias("doc_id"), text_of(text_col).cast("binary").alias("data"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = _group_of(batch.column(0).to_numpy(), groups)
            yield pa.RecordBatch.from_arrays([pa.array(group), *batch.columns], names=["target", "doc_id", "data"])

    return rows.mapInArrow(run, "target long, doc_id long, data binary")


def _entry_rows(docs: DataFrame, id_col: str, text_col: str, bounds: list[int], buckets: int, groups: int) -> DataFrame:
    """Entries by bucket. What repeats inside a chunk is not sent: its spans are, to their group."""
    limits = np.array(bounds, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)) // CHUNK_BYTES
            for part in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(sizes)) + 1):
                texts = batch.column(1).take(pa.array(part)).to_pylist()
                ids = batch.column(0).to_numpy()[part]
                keys = np.array([text_key(t) for t in texts], np.uint64)
                batch_no = np.searchsorted(limits, ids, "right")
                blocks = np.cumsum([len(t) for t in texts]) // BLOCK_BYTES
                entries = np.concatenate([
                    entries_of(texts[b[0]:b[-1] + 1], ids[b], keys[b], batch_no[b])
                    for b in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(blocks)) + 1)])
                fresh, repeated = split_repeats(entries)
                if len(fresh):
                    yield _rows(_ENTRIES, ((fresh["key"] >> np.uint64(8)) % np.uint64(buckets)).astype(np.int64), fresh)
                if len(repeated):
                    spans = joined(spans_of(repeated))
                    yield _rows(_SPANS, -1 - _group_of(spans["doc"], groups), spans)

    rows = docs.filter(docs[id_col].isNotNull()).select(
        docs[id_col].cast("long").alias("doc_id"), text_of(text_col).cast("binary").alias("data"))
    return rows.mapInArrow(run, _SHAPE)


def scan_levels(table: pa.Table, groups: int, with_levels: bool) -> pa.Table:
    """One bucket: its batches in order against its levels. Spans that repeat, entries to look at."""
    target = table.column("target")[0].as_py()
    if target < 0:  # spans on the way to their group
        return table.set_column(1, "target", pa.array([-1 - target] * len(table), pa.int64()))
    kinds = np.array(table.column("kind").to_pylist())
    levels = Levels([unpacked(d.as_py()) for d, k in zip(table.column("data"), kinds) if k == _LEVEL])
    levels.levels.sort(key=lambda x: -len(x))
    entries = _records(table.column("data").filter(pa.array(kinds == _ENTRIES)), _ENTRY)
    found = [np.zeros(0, _SPAN)]
    for batch in np.unique(entries["batch"]):
        found.append(spans_of(levels.add(entries[entries["batch"] == batch])))
    spans, alike = joined(np.concatenate(found)), levels.alike()
    out = [_rows(_SPANS, _group_of(spans["doc"], groups), spans), _rows(_ENTRIES, _group_of(alike["doc"], groups), alike)]
    if with_levels:
        out += [_rows(_LEVEL, np.full(len(x), target), x) for x in levels.levels]
    return pa.Table.from_batches(out)


def _fetch(texts: pa.Table, asked: pa.Table, buckets: int) -> pa.Table:
    """The bytes of the asked stretches of one group of documents, by bucket of their first bytes."""
    entries = _records(asked.column("data"), _ENTRY) if len(asked) else np.zeros(0, _ENTRY)
    if not len(entries):
        return pa.Table.from_batches([_rows(_ENTRIES, np.zeros(0, np.int64), entries, [])])
    data = {(d, text_key(t)): t for d, t in zip(texts.column("doc_id").to_pylist(), texts.column("data").to_pylist())}
    lo = (entries["at"] - entries["before"]).tolist()
    size = (entries["more"].astype(np.int64) + LENGTH).tolist()
    stretches = [data[key][a:a + n] for key, a, n in zip(zip(entries["doc"].tolist(), entries["text"].tolist()), lo, size)]
    bucket = ((entries["key"] >> np.uint64(8)) % np.uint64(buckets)).astype(np.int64)
    return pa.Table.from_batches([_rows(_ENTRIES, bucket, entries, stretches)])


def _compare(table: pa.Table, groups: int) -> pa.Table:
    entries = _records(table.column("data"), _ENTRY)
    data = b"".join(table.column("extra").to_pylist())
    ends = np.cumsum(entries["more"].astype(np.int64) + LENGTH).tolist()
    # Parts of whole keys, so that the arrays of a part stay small.
    order = np.argsort(entries["key"], kind="stable")
    keys = entries["key"][order]
    sizes = np.cumsum(entries["more"][order].astype(np.int64) + LENGTH) // COMPARED_BYTES
    new_key = np.concatenate(([True], keys[1:] != keys[:-1]))
    step = np.maximum.accumulate(np.where(new_key, sizes, 0))
    out = [np.zeros(0, _SPAN)]
    for part in np.split(order, np.flatnonzero(np.diff(step)) + 1):
        stretches = [data[ends[i] - int(entries["more"][i]) - LENGTH:ends[i]] for i in part.tolist()]
        out.append(repeated_windows(entries[part], stretches))
    spans = joined(np.concatenate(out))
    return pa.Table.from_batches([_rows(_SPANS, _group_of(spans["doc"], groups), spans)])


KEPT = "doc_id long, n_bytes long, starts array<long>, ends array<long>, kept binary"


def _cut(texts: pa.Table, spans: pa.Table, with_bytes: bool, whole_characters: bool) -> pa.Table:
    marked = joined(_records(spans.column("data"), _SPAN)) if len(spans) else np.zeros(0, _SPAN)
    by: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for doc, key, a, b in marked.tolist():
        by.setdefault((doc, key), []).append((a, b))
    rows = []
    for doc, data in zip(texts.column("doc_id").to_pylist(), texts.column("data").to_pylist()):
        found = by.get((doc, text_key(data)), ()) if by else ()
        edges = [0, *[x for span in found for x in span], len(data)]
        kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
        if whole_characters and found:
            kept = kept.decode("utf-8", "ignore").encode()
        rows.append((doc, len(data), [a for a, _ in found], [b for _, b in found],
                     kept if with_bytes else hashlib.sha256(kept).digest()))
    columns = list(zip(*rows)) or [()] * 5
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
    return pa.table({name: pa.array(c, k) for name, c, k in zip(["doc_id", "n_bytes", "starts", "ends", "kept"], columns, kinds)})


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_bytes: bool = True,
                   batches: int = BATCHES, earlier: DataFrame | None = None, index: str | None = None,
                   index_out: str | None = None, whole_characters: bool = False) -> DataFrame:
    """One row per input row with an id: its bytes, the removed spans and the kept bytes.

    A byte goes if it is covered by ``LENGTH`` bytes that also start earlier: in a document of a
    smaller id, or earlier in the same one. Strings are judged on the input. ``kept`` is the kept
    bytes joined, or their SHA-256 without ``with_bytes``; with ``whole_characters`` what is left of a
    character of which some bytes were cut goes as well, so that they are a text again. Null and empty texts and those below
    ``LENGTH`` bytes stay whole. Rows that repeat an id do not count as earlier than one another.
    Rows without an id take no part and are not returned; an empty table gives no rows.

    Documents are dealt into ``batches`` by id. With ``index_out`` the levels are written there;
    with ``index`` they are read first, ``earlier`` being the documents behind them (new documents
    should then have larger ids; removed spans of earlier ones are not given again).
    """
    spark = docs.sparkSession
    sized = docs.filter(docs[id_col].isNotNull())
    total = sized.agg(F.sum(F.octet_length(text_of(text_col)))).first()[0] or 0
    bounds = sized.select(F.col(id_col).cast("double").alias("i")).approxQuantile(
        "i", [k / batches for k in range(1, batches)], 0.01) if total and batches > 1 else []
    bounds = [int(b) for b in bounds]
    groups, buckets = max(total // GROUP_BYTES, 16), max(total // BUCKET_BYTES, 16)
    rows = _entry_rows(docs, id_col, text_col, bounds, buckets, groups)
    if index:
        levels = spark.read.parquet(index)
        buckets = levels.first()["buckets"]
        rows = _entry_rows(docs, id_col, text_col, bounds, buckets, groups).unionByName(levels.drop("buckets"))
    keep_levels = index_out is not None
    scanned = stored(rows.groupBy("target").applyInArrow(lambda t: scan_levels(t, groups, keep_levels), _SHAPE), "levels")
    if keep_levels:
        scanned.filter(F.col("kind") == _LEVEL).withColumn("buckets", F.lit(buckets)).write.parquet(index_out)
    release(spark)
    new = _texts(docs, id_col, text_col, groups)
    every = new if earlier is None else new.unionByName(_texts(earlier, id_col, text_col, groups))
    asked = scanned.filter(F.col("kind") == _ENTRIES)
    fetched = every.groupBy("target").cogroup(asked.groupBy("target")).applyInArrow(
        lambda t, a: _fetch(t, a, buckets), _SHAPE)
    compared = stored(fetched.groupBy("target").applyInArrow(lambda t: _compare(t, groups), _SHAPE), "windows")
    release(spark)
    spans = scanned.filter(F.col("kind") == _SPANS).unionByName(compared)
    return new.groupBy("target").cogroup(spans.groupBy("target")).applyInArrow(
        lambda t, s: _cut(t, s, with_bytes, whole_characters), KEPT)
