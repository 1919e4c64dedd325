"""Ranked lexical search: item bundles travel from term owner to term owner.

Postings of the searched terms are written once, per slice of the documents. Terms belong to owners
by hash, one owner per stage. A bundle holds a block of items, their weighted terms and, for one
slice, the documents' integer sums so far; a cogroup at each stage adds what the owner's terms
contribute, and the last stage selects. All arithmetic is on 64-bit integers but for the weights.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohorta.llm.common import text_of, travels
from cohorta.llm.words import blocks, cut_words
from cohorta.session import materialise

travels(__name__)

OWNERS = 4  # stages
SLICE_DOCUMENTS = 16_384  # of one part of the documents; their places fit into two bytes
BUNDLE_ITEMS = 256
MARK_BITS = 23  # searched terms are marked in 2 ** 23 bits, whatever their number
SCALE, LENGTH_SHARE, SATURATION = 1_000_000_000, 75, 8  # of the score's formula

# The bytes of terms (numbers, letters, all beyond ASCII), A-Z as a-z.
_TERM = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)

_POSTINGS = "slice long, owner int, term binary, n long, total long, places binary, counts binary"
_BUNDLES = ("bundle long, slice long, items array<long>, asks_term array<binary>, asks_item array<int>, "
            "asks_weight array<long>, places binary, sums binary")


def owner_of(term: bytes, owners: int) -> int:
    return (zlib.crc32(term) >> 8) % owners


def _marked(term: bytes, marks: np.ndarray) -> bool:
    bit = zlib.crc32(term) & (1 << MARK_BITS) - 1
    return bool(marks[bit >> 6] >> np.uint64(bit & 63) & np.uint64(1))


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, term, n: the terms of each item. Rows that repeat an id are one item, rows without one are none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in blocks(batch.column(1)):
                cut = cut_words(batch.column(1).slice(a, b - a), _TERM, _LOWER)
                codes, entries = cut.coded()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a).take(pa.array(np.repeat(np.arange(b - a), cut.counts))),
                     entries.take(pa.array(codes))], names=["item_id", "term"])

    named = items.filter(items[id_col].isNotNull())
    picked = named.select(named[id_col].cast("long").alias("item_id"), text_of(text_col).cast("binary").alias("text"))
    return picked.mapInArrow(run, "item_id long, term binary").groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("n"))


def term_marks(terms: DataFrame) -> np.ndarray:
    """A bit for every hash of a term, 1 MB for any number of terms: others need no postings."""
    bit = F.crc32("term").bitwiseAND(F.lit((1 << MARK_BITS) - 1))
    words = (terms.select(bit.alias("b")).selectExpr("shiftright(b, 6) as w", "shiftleft(1L, cast(b & 63 as int)) as m")
             .groupBy("w").agg(F.bit_or("m").alias("m")).toArrow())
    marks = np.zeros(1 << MARK_BITS - 6, np.uint64)
    marks[words.column(0).to_numpy()] = words.column(1).to_numpy().astype(np.int64).view(np.uint64)
    return marks


class _Slice:
    """Documents of one slice while they are read."""

    def __init__(self):
        self.ids: list[pa.Array] = []
        self.lengths: list[np.ndarray] = []
        self.documents = 0
        self.numbers: dict[bytes, int] = {}
        self.found: list[np.ndarray] = []  # rows of term number, place, count

    def add(self, ids: pa.Array, texts: pa.BinaryArray, marks: np.ndarray) -> None:
        cut = cut_words(texts, _TERM, _LOWER)
        codes, entries = cut.coded()
        number = np.full(len(entries), -1)
        for i, term in enumerate(entries.to_pylist()):
            if _marked(term, marks):
                number[i] = self.numbers.setdefault(term, len(self.numbers))
        mine = number[codes]
        place = np.repeat(np.arange(self.documents, self.documents + len(ids)), cut.counts)
        key, n = np.unique((mine << 16 | place)[mine >= 0], return_counts=True)
        self.found.append(np.stack((key >> 16, key & 0xFFFF, n)))
        self.ids.append(ids)
        self.lengths.append(cut.counts)
        self.documents += len(ids)

    def rows(self, name: int, owners: int) -> Iterator[pa.RecordBatch]:
        ids, lengths = pa.concat_arrays(self.ids), np.concatenate(self.lengths)
        ids = ids.fill_null(np.iinfo(np.int64).max)
        number, place, n = np.concatenate(self.found, axis=1)
        order = np.argsort(number, kind="stable")
        number, place, n = number[order], place[order].astype("<u2"), n[order].astype("<u4")
        cuts = np.searchsorted(number, np.arange(len(self.numbers) + 1))
        terms = list(self.numbers)
        parts = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
        yield pa.RecordBatch.from_pydict({
            "slice": pa.array([name] * (1 + len(terms)), pa.int64()),
            "owner": pa.array([-1, *(owner_of(t, owners) for t in terms)], pa.int32()),
            "term": pa.array([None, *terms], pa.binary()),
            "n": pa.array([int((lengths > 0).sum()), *(b - a for a, b in parts)], pa.int64()),
            "total": pa.array([int(lengths.sum()), *([None] * len(terms))], pa.int64()),
            "places": pa.array([ids.to_numpy(zero_copy_only=False).tobytes(), *(place[a:b].tobytes() for a, b in parts)], pa.binary()),
            "counts": pa.array([lengths.astype(np.int64).tobytes(), *(n[a:b].tobytes() for a, b in parts)], pa.binary())})


def postings(docs: DataFrame, marks: np.ndarray, owners: int = OWNERS, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Rows of slices: one with the ids and lengths of its documents (owner -1), one per marked term
    with the places and counts of its occurrences. Written once, so a slice's rows belong together."""
    shared = docs.sparkSession.sparkContext.broadcast(marks)  # 1 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, slice_ = TaskContext.get().partitionId(), 0, _Slice()
        for batch in batches:
            for a, b in blocks(batch.column(1)):
                for c in range(a, b, SLICE_DOCUMENTS):
                    d = min(c + SLICE_DOCUMENTS, b)
                    if slice_.documents + d - c > SLICE_DOCUMENTS:
                        yield from slice_.rows(part << 32 | made, owners)
                        made, slice_ = made + 1, _Slice()
                    slice_.add(batch.column(0).slice(c, d - c), batch.column(1).slice(c, d - c), shared.value)
        if slice_.documents:
            yield from slice_.rows(part << 32 | made, owners)

    picked = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(text_col).cast("binary").alias("text"))
    return materialise(picked.mapInArrow(run, _POSTINGS))


def _bundles(weighted: DataFrame, slices: DataFrame, blocks_: int, salts: int) -> DataFrame:
    """Each block of items once per slice, without any sums yet."""
    ask = F.struct("item_id", "term", "weight")
    packed = (weighted.withColumn("bundle", F.pmod(F.xxhash64("item_id"), F.lit(blocks_)))
              .groupBy("bundle").agg(F.array_sort(F.collect_set("item_id")).alias("items"), F.collect_list(ask).alias("asks")))
    packed = packed.select(
        "bundle", "items", F.col("asks.term").alias("asks_term"),
        F.transform("asks.item_id", lambda i: (F.array_position("items", i) - 1).cast("int")).alias("asks_item"),
        F.col("asks.weight").alias("asks_weight"))
    # Slices meet the bundles by number and a salt, as there may be many slices and one bundle.
    left = slices.select("slice", F.pmod(F.xxhash64("slice"), F.lit(salts)).alias("salt"),
                         F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks_ - 1).cast("long"))).alias("bundle"))
    right = packed.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    empty = F.lit(b"")
    return left.join(right, ["bundle", "salt"]).select(
        "bundle", "slice", "items", "asks_term", "asks_item", "asks_weight", empty.alias("places"), empty.alias("sums"))


class _Sums:
    """A bundle's sums for the documents of a slice, opened as a table of items and documents."""

    def __init__(self, bundle: pa.Table, owned: pa.Table, total: int, documents: int):
        head = owned.filter(pc.equal(owned.column("owner"), -1))
        self.ids = np.frombuffer(head.column("places")[0].as_py(), np.int64)
        self.lengths = np.frombuffer(head.column("counts")[0].as_py(), np.int64)
        self.owned = owned.filter(pc.not_equal(owned.column("owner"), -1))
        row = {name: bundle.column(name)[0] for name in bundle.column_names}
        self.row = row
        self.items = row["items"].values.to_numpy()
        self.terms, self.ask_item = row["asks_term"].values, row["asks_item"].values.to_numpy()
        self.ask_weight = row["asks_weight"].values.to_numpy()
        self.sums = np.zeros((len(self.items), len(self.ids)), np.int64)
        self.sums.reshape(-1)[np.frombuffer(row["places"].as_py(), "<u4")] = np.frombuffer(row["sums"].as_py(), np.int64)
        # A document's share of its length, in hundredths of the average.
        self.norm = 100 - LENGTH_SHARE + LENGTH_SHARE * self.lengths * documents // max(total, 1)

    def add(self) -> None:
        """What the owner's terms contribute."""
        terms = self.owned.column("term").combine_chunks()
        which = pc.index_in(self.terms, value_set=terms)
        found = np.flatnonzero(~which.is_null().to_numpy(zero_copy_only=False))
        which = which.to_numpy(zero_copy_only=False)[found].astype(np.int64)
        order = np.argsort(which, kind="stable")
        found, which = found[order], which[order]
        places, counts = self.owned.column("places"), self.owned.column("counts")
        for part in np.split(np.arange(len(which)), np.flatnonzero(np.diff(which)) + 1) if len(which) else []:
            k, asks = int(which[part[0]]), found[part]
            place = np.frombuffer(places[k].as_buffer(), "<u2").astype(np.int64)
            n = np.frombuffer(counts[k].as_buffer(), "<u4").astype(np.int64)
            gain = SCALE * n // (1000 * n + SATURATION * self.norm[place])
            self.sums[np.ix_(self.ask_item[asks], place)] += self.ask_weight[asks][:, None] * gain[None, :]

    def ahead(self, owner: int, owners: int) -> np.ndarray:
        """Which asks are for terms of later owners."""
        return np.array([owner_of(t, owners) > owner for t in self.terms.to_pylist()], bool)

    def prune(self, later: np.ndarray, k: int) -> None:
        """Forget documents that k others of the slice are already beyond for good: sums only grow, and
        a term's occurrences bring at most its weight times SCALE / 1000."""
        rest = np.bincount(self.ask_item[later], weights=self.ask_weight[later].astype(float), minlength=len(self.items))
        rest = (rest.astype(np.int64) + 1) * (SCALE // 1000)
        if self.sums.shape[1] > k:
            least = -np.partition(-self.sums, k - 1, axis=1)[:, k - 1]
            self.sums[self.sums + rest[:, None] < least[:, None]] = 0

    def packed(self, later: np.ndarray) -> dict:
        at = np.flatnonzero(self.sums)
        chosen = np.flatnonzero(later)
        return {"bundle": self.row["bundle"].as_py(), "slice": self.row["slice"].as_py(), "items": self.items,
                "asks_term": self.terms.take(pa.array(chosen)), "asks_item": self.ask_item[chosen],
                "asks_weight": self.ask_weight[chosen], "places": at.astype("<u4").tobytes(),
                "sums": self.sums.reshape(-1)[at].tobytes()}

    def best(self, k: int) -> pa.Table:
        rows = []
        for i, sums in enumerate(self.sums):
            at = np.flatnonzero(sums > 0)
            if len(at) > k:
                at = at[sums[at] >= np.partition(sums[at], len(at) - k)[len(at) - k]]
            at = at[np.lexsort((self.ids[at], -sums[at]))][:k]
            rows.append((np.full(len(at), self.items[i]), self.ids[at], sums[at]))
        item, ids, score = (np.concatenate(x) for x in zip(*rows))
        return pa.table({"item_id": pa.array(item), "doc_id": pa.array(ids, mask=ids == np.iinfo(np.int64).max),
                         "score": pa.array(score)})


def _lists(values: list, kind: pa.DataType) -> pa.Array:
    return pa.array([v.to_pylist() if isinstance(v, pa.Array) else v.tolist() for v in values], pa.list_(kind))


def search(docs: DataFrame, items: DataFrame, k: int = 10, owners: int = OWNERS, doc_id: str = "doc_id",
           item_id: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k highest-scoring documents of each item, scores above 0.

    Equal scores go by ascending id, documents without an id last. Null and empty texts have no
    terms; such documents count nowhere, such items find nothing. Rows that repeat an item's id are
    one item with the terms of all, items without an id are left out; every document row is one
    document. Empty tables give no rows. Postings are kept for terms of items only.
    """
    asked = materialise(item_terms(items, item_id, text_col))
    written = postings(docs, term_marks(asked), owners, doc_id, text_col)
    slices = written.filter("owner = -1")
    documents, total, parts = slices.agg(F.sum("n"), F.sum("total"), F.count(F.lit(1))).first()
    documents, total = documents or 0, total or 0
    holding = written.filter("owner >= 0").groupBy("term").agg(F.sum("n").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * documents + 2) / (2 * F.col("df") + 1))).cast("long")
    weighted = asked.join(holding, "term").select("item_id", "term", (weight * F.col("n")).alias("weight"))
    number = asked.select("item_id").distinct().count()
    bundles = _bundles(weighted, slices, max(-(-number // BUNDLE_ITEMS), 1), max(parts // 64, 1))

    def stage(owner: int):
        def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows:
                return pa.table({name: pa.array([], kind) for name, kind in _ARROW.items()})
            sums = _Sums(left, right, total, documents)
            sums.add()
            if owner == owners - 1:
                return sums.best(k)
            later = sums.ahead(owner, owners)
            sums.prune(later, k)
            row = sums.packed(later)
            return pa.table({name: (_lists([row[name]], kind.value_type) if pa.types.is_list(kind) else pa.array([row[name]], kind))
                             for name, kind in _ARROW.items()})

        def last(key, left: pa.Table, right: pa.Table) -> pa.Table:
            return run(key, left, right) if left.num_rows else pa.table(
                {"item_id": pa.array([], pa.int64()), "doc_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})

        return last if owner == owners - 1 else run

    numbers = F.sequence(F.lit(0).cast("long"), F.lit(max(-(-number // BUNDLE_ITEMS), 1) - 1).cast("long"))
    for owner in range(owners):
        owned = (written.filter(F.col("owner").isin(owner, -1)).withColumn("bundle", F.explode(numbers))
                 .select(F.col("bundle").alias("b"), F.col("slice").alias("s"), "owner", "term", "places", "counts"))
        schema = _BUNDLES if owner < owners - 1 else "item_id long, doc_id long, score long"
        bundles = (bundles.groupBy("bundle", "slice").cogroup(owned.groupBy("b", "s"))
                   .applyInArrow(stage(owner), schema))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (bundles.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


_ARROW = {"bundle": pa.int64(), "slice": pa.int64(), "items": pa.list_(pa.int64()), "asks_term": pa.list_(pa.binary()),
          "asks_item": pa.list_(pa.int32()), "asks_weight": pa.list_(pa.int64()), "places": pa.binary(), "sums": pa.binary()}
