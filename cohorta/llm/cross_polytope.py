"""Approximate nearest neighbours by cross-polytope hashing with multiprobe tables.

Unit vectors are turned by fast pseudo-random rotations (signs and Hadamard transforms) and belong
to the nearest signed axis. Vectors are indexed by bands of like norm, so a long one does not change
where the others are found. A query looks into the buckets of its best axes in every band and table;
what it finds there is ranked by the exact inner product. Neighbouring buckets are searched together: a
query is sent once to a block of them, with the least sum of coordinates that a bucket must have to be
looked into. Queries that find too few rows go through all vectors.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohorta.llm.bpe import ragged
from cohorta.llm.common import travels
from cohorta.session import materialise

travels(__name__)

TABLES = 10
REACH, GROWTH = 0.6, 0.75  # a query meets about REACH * n ** GROWTH vectors per table
BUCKET_ROWS = 8192  # vectors, and queries, of which all meet in one task
BLOCK_BUCKETS = 8  # times as many vectors, and queries, where only those of the same bucket meet
BLOCK_VALUES = 4_000_000  # coordinates of the vectors, or of the queries, of a block of buckets
STEP_VALUES = 1_000_000  # sums or scores worked on at once
WHOLE_ROWS = 256  # smaller bands are searched whole, all together


@dataclass
class Hashing:
    """``functions`` hashes make a bucket; all vectors are first padded to ``width``, a power of two."""

    dim: int
    rows: int
    tables: int = TABLES

    def __post_init__(self):
        self.width = 1 << (self.dim).bit_length()  # one more place than dim, at least
        self.axes = 2 * self.width
        self.functions = 1
        while self.axes ** (self.functions + 1) <= self.rows:
            self.functions += 1
        self.buckets = self.axes ** self.functions
        self.probes = int(np.clip(np.ceil(REACH * self.buckets * max(self.rows, 1) ** (GROWTH - 1)), 1, self.buckets))

    def _signs(self, seed: int) -> np.ndarray:
        x = np.arange(1, self.width + 1, dtype=np.uint64) + np.uint64(seed * 0x10001)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 0x9E3779B97F4A7C15)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return np.where(x >> np.uint64(63), -1.0, 1.0)

    def rotate(self, vectors: np.ndarray, number: int) -> np.ndarray:
        """Three rounds of random signs and a Hadamard transform."""
        x, n = vectors, len(vectors)
        for turn in range(3):
            x = x * self._signs(number * 3 + turn + 1)
            half = 1
            while half < self.width:
                x = x.reshape(n, self.width // (2 * half), 2, half)
                x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2)
                half *= 2
            x = x.reshape(n, self.width) / np.sqrt(self.width)
        return x

    def _both_signs(self, vectors: np.ndarray, table: int, function: int) -> np.ndarray:
        turned = self.rotate(vectors, table * self.functions + function)
        return np.hstack((turned, -turned))

    def bucket(self, vectors: np.ndarray, table: int) -> np.ndarray:
        number = np.zeros(len(vectors), np.int64)
        for f in range(self.functions):
            number = number * self.axes + self._both_signs(vectors, table, f).argmax(axis=1)
        return number

    def sides(self, vectors: np.ndarray, table: int) -> list[np.ndarray]:
        """The coordinates along all signed axes, by function."""
        return [self._both_signs(vectors, table, f) for f in range(self.functions)]

    def least_probed(self, sides: list[np.ndarray]) -> np.ndarray:
        """The least sum of coordinates among the ``probes`` best buckets of each vector; all that tie are probed.

        In descending order the i-th prefix and the j-th axis are among the best P only if i * j <= P.
        """
        sums = np.zeros((len(sides[0]), 1))
        for values in sides:
            values = -np.sort(-values, axis=1)[:, :self.probes]
            most = np.minimum(self.probes // np.arange(1, sums.shape[1] + 1), values.shape[1])
            i, j = np.repeat(np.arange(len(most)), most), ragged(np.arange(values.shape[1]), np.zeros(len(most), np.int64), most)
            sums = sums[:, i] + values[:, j]
            if sums.shape[1] > self.probes:
                sums = -np.partition(-sums, self.probes - 1, axis=1)[:, :self.probes]
            sums = -np.sort(-sums, axis=1)
        return sums[:, -1]

    def edges(self, blocks: int) -> np.ndarray:
        """The first axes of the blocks that the buckets are cut into, and the end."""
        return np.arange(blocks + 1) * self.axes // blocks

    def block_of(self, buckets: np.ndarray, blocks: int) -> np.ndarray:
        return np.searchsorted(self.edges(blocks), buckets // self.axes ** (self.functions - 1), "right") - 1

    def reached(self, sides: list[np.ndarray], least: np.ndarray, first: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Vector and bucket for all buckets with a sum of at least ``least`` whose first axis is in the range.

        Prefixes that no further axes can lift to it are dropped; sums are added in the same order everywhere.
        """
        at, number, sums = np.arange(len(least)), np.zeros(len(least), np.int64), np.zeros(len(least))
        low, high = first, end
        for f, values in enumerate(sides):
            sums = sums[:, None] + values[at, low:high]
            best = sums
            for more in sides[f + 1:]:
                best = best + more.max(axis=1)[at][:, None]
            row, axis = np.nonzero(best >= least[at][:, None])
            sums, number, at = sums[row, axis], number[row] * self.axes + axis + low, at[row]
            low, high = 0, self.axes
        return at, number


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim).astype(np.float64)


def _directions(x: np.ndarray, hashing: Hashing) -> np.ndarray:
    """Unit vectors, padded. Scaled by the largest component first: squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    out = np.zeros((len(x), hashing.width))
    out[:, :hashing.dim] = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    return out


def exact_scores(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Inner products summed in one fixed order, so equal vectors score equally everywhere."""
    return (np.ascontiguousarray(one) * np.ascontiguousarray(many)).sum(axis=-1)


def _found(entry: np.ndarray, lengths: np.ndarray, found: np.ndarray, scores: np.ndarray) -> pa.Table:
    ends = pa.array(np.append(0, np.cumsum(lengths)), pa.int32())
    return pa.table({"entry": pa.array(entry, pa.int64()),
                     "found": pa.ListArray.from_arrays(ends, pa.array(found, pa.int64())),
                     "scores": pa.ListArray.from_arrays(ends, pa.array(scores, pa.float64()))})


class _Best:
    """The ``keep`` entries of the highest scores of each query, of all that were offered."""

    def __init__(self, queries: int, keep: int):
        self.keep, self.least = keep, np.full(queries, -np.inf)
        self.kept, self.size = [], 0

    def offer(self, rows: np.ndarray, q: np.ndarray, v: np.ndarray, start: int, end: int) -> None:
        step = max(STEP_VALUES // (end - start), 1)
        for i in range(0, len(rows), step):
            some = rows[i:i + step]
            scores = q[some] @ v[start:end].T
            row, entry = np.nonzero(scores >= self.least[some][:, None])
            self.kept.append((some[row], entry + start, scores[row, entry]))
            self.size += len(row)
            if self.size > STEP_VALUES:
                self.chosen()

    def chosen(self) -> tuple[np.ndarray, np.ndarray]:
        """Query and entry of what is best so far, by query; the rest is forgotten."""
        row, entry, score = (np.concatenate(x) for x in zip(*self.kept)) if self.kept else np.zeros((3, 0), np.int64)
        order = np.lexsort((entry, -score, row))
        row, entry, score = row[order], entry[order], score[order]
        first = np.searchsorted(row, row)
        rank = np.arange(len(row)) - first
        last = rank == self.keep - 1
        self.least[row[last]] = score[last]
        few = rank < self.keep
        self.kept, self.size = [(row[few], entry[few], score[few])], int(few.sum())
        return row[few], entry[few]


def nearest(vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id",
            vector_col: str = "embedding", tables: int = TABLES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: up to ``k`` rows per query row, nearest first.

    ``queries``, a condition on ``vec_id``, tells which rows ask; every other usable row answers. Unusable vectors (see
    ``usable``) and null ids take no part; vectors of different lengths never meet, each length has
    an index of its own. Equal vectors are one entry of the index with their k + 1 smallest ids, so
    large groups of copies cost one search; ties go to the smaller id. A repeated id counts once
    per different vector. A query whose buckets hold fewer than ``k`` others is answered from all
    vectors. An empty table gives no rows.
    """
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"),
                          vectors[vector_col].cast("array<double>").alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("v"))).withColumn(
        "v", F.transform("v", lambda x: x + 0.0))
    rows = rows.withColumn("asks", queries)
    sizes = [r[0] for r in rows.select(F.size("v").alias("d")).distinct().orderBy("d").collect()]
    found = None
    for dim in sizes:
        part = _nearest_of(rows.filter(F.size("v") == dim), dim, k, tables)
        found = part if found is None else found.unionByName(part)
    empty = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return empty if found is None else found


def _nearest_of(rows: DataFrame, dim: int, k: int, tables: int) -> DataFrame:
    smallest = Window.partitionBy("v").orderBy("vec_id")
    members = (rows.select("v", "vec_id").withColumn("n", F.row_number().over(smallest)).filter(F.col("n") <= k + 1)
               .groupBy("v").agg(F.array_sort(F.collect_set("vec_id")).alias("members")))
    asked = rows.filter("asks").select("v").distinct().withColumn("asked", F.lit(True))
    scaled = members.join(asked, "v", "left").withColumn("most", F.array_max(F.transform("v", lambda x: F.abs(x))))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x / F.col("most") * (x / F.col("most"))))
    entries = materialise(scaled.select(
        F.element_at("members", 1).alias("entry"), "v", "members", F.coalesce("asked", F.lit(False)).alias("asked"),
        F.round(F.log2("most") + F.log2(norm)).cast("int").alias("band")))
    # Octaves around the powers of two.
    rows_of = {r["band"]: r["n"] for r in entries.groupBy("band").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_asked, reachable = entries.agg(F.count_if("asked"), F.sum(F.size("members"))).first()
    hashings = {band: Hashing(dim, n, tables) for band, n in sorted(rows_of.items()) if n > WHOLE_ROWS}
    others = sum(rows_of.values()) - sum(h.rows for h in hashings.values())
    together = max(min(BLOCK_BUCKETS * BUCKET_ROWS, BLOCK_VALUES // dim), 1)
    blocks_of = {band: min(-(-h.rows // together), h.axes) for band, h in hashings.items()}
    plain = Hashing(dim, 1)
    keep = k + 1

    def placed(band: int, t: int, block: np.ndarray, rows: pa.RecordBatch, name: str, values: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(block), band, np.int32)), pa.array(np.full(len(block), t, np.int32)),
             pa.array(block.astype(np.int32)), rows.column(0), rows.column(1), pa.array(values)],
            names=["band", "t", "block", "entry", "v", name])

    def index(batches):
        for batch in batches:
            bands = batch.column(2).to_numpy()
            for band in np.unique(bands).tolist():
                some = batch.take(pa.array(np.flatnonzero(bands == band)))
                x, hashing = _directions(_matrix(some.column(1), dim), plain), hashings[band]
                for t in range(tables):
                    bucket = hashing.bucket(x, t)
                    yield placed(band, t, hashing.block_of(bucket, blocks_of[band]), some, "bucket", bucket)

    def probe(batches):
        for whole in batches:
            for band, hashing in hashings.items():
                step = max(STEP_VALUES // int(hashing.probes * (1 + np.log(hashing.probes)) + hashing.axes), 1)
                for i in range(0, len(whole), step):
                    batch = whole.slice(i, step)
                    x = _directions(_matrix(batch.column(1), dim), plain)
                    for t in range(tables):
                        sides = hashing.sides(x, t)
                        least = hashing.least_probed(sides)
                        best = np.maximum.reduceat(sides[0], hashing.edges(blocks_of[band])[:-1], axis=1)
                        for more in sides[1:]:
                            best = best + more.max(axis=1)[:, None]
                        row, block = np.nonzero(best >= least[:, None])
                        yield placed(band, t, block, batch.take(pa.array(row)), "least", least[row])

    shape = "band int, t int, block int, entry long, v array<double>"
    place = ["band", "t", "block"]
    hashed = entries.filter(F.col("band").isin(list(hashings))).select("entry", "v", "band").mapInArrow(
        index, f"{shape}, bucket long")
    probed = entries.filter("asked").select("entry", "v").mapInArrow(probe, f"{shape}, least double")
    # Large blocks are searched in parts; a query goes to every part of its blocks. Vectors go to every slice of
    # queries. The blocks are few: one for ``together`` vectors, and for a band.
    parts = F.broadcast(hashed.groupBy(place).agg(F.ceil(F.count(F.lit(1)) / together).cast("int").alias("parts")))
    slices = F.lit(max(-(-n_asked // together), 1)).alias("slices")
    hashed, probed = (rows.join(parts, place).select("*", slices) for rows in (hashed, probed))

    def search_block(key: tuple, ask: pa.Table, there: pa.Table) -> pa.Table:
        if not len(ask) or not len(there):
            return _found(*[np.zeros(0, np.int64)] * 3, np.zeros(0))
        band, t, block = (x.as_py() for x in key[:3])
        hashing = hashings[band]
        first, end = hashing.edges(blocks_of[band])[block:block + 2].tolist()
        there = there.take(pa.array(np.argsort(there.column("bucket").to_numpy(), kind="stable")))
        v, ids = _matrix(there.column("v").combine_chunks(), dim), there.column("entry").to_numpy()
        buckets, starts = np.unique(there.column("bucket").to_numpy(), return_index=True)
        ends = np.append(starts[1:], len(ids))
        q, least = _matrix(ask.column("q").combine_chunks(), dim), ask.column("least").to_numpy()
        step = max(STEP_VALUES // ((end - first) * (hashing.axes if hashing.functions > 1 else 1)), 1)
        out = [[], [], []]
        for low in range(0, len(q), BUCKET_ROWS):
            some, pairs = q[low:low + BUCKET_ROWS], []
            for i in range(0, len(some), step):
                sides = hashing.sides(_directions(some[i:i + step], plain), t)
                at, number = hashing.reached(sides, least[low + i:low + i + step][:len(sides[0])], first, end)
                place = np.minimum(np.searchsorted(buckets, number), len(buckets) - 1)
                there_is = buckets[place] == number
                pairs.append((at[there_is] + i, place[there_is]))
            best = _Best(len(some), 2 * keep)
            at, place = (np.concatenate(x) for x in zip(*pairs))
            order = np.argsort(place, kind="stable")
            at, place = at[order], place[order]
            cuts = np.flatnonzero(np.diff(place, prepend=-1))
            for a, b, c in zip(cuts.tolist(), [*cuts[1:].tolist(), len(at)], place[cuts].tolist()):
                best.offer(at[a:b], some, v, int(starts[c]), int(ends[c]))
            row, entry = best.chosen()
            pieces = [slice(i, i + max(STEP_VALUES // dim, 1)) for i in range(0, len(row), max(STEP_VALUES // dim, 1))]
            scores = np.concatenate([np.zeros(0), *[exact_scores(some[row[x]], v[entry[x]]) for x in pieces]])
            order = np.lexsort((ids[entry], -scores, row))
            few = order[np.arange(len(row)) - np.searchsorted(row, row) < keep]
            for kept, values in zip(out, (row[few] + low, ids[entry[few]], scores[few])):
                kept.append(values)
        row, found, scores = (np.concatenate(x or [np.zeros(0, np.int64)]) for x in out)
        new = np.flatnonzero(np.diff(row, prepend=-1))
        return _found(ask.column("asking").to_numpy()[row[new]], np.diff(np.append(new, len(row))), found, scores)

    def search(ask: pa.Table, there: pa.Table) -> pa.Table:
        entry = ask.column("asking")
        if not len(ask) or not len(there):
            return pa.table({"entry": entry.slice(0, 0), "found": pa.array([], pa.list_(pa.int64())),
                             "scores": pa.array([], pa.list_(pa.float64()))})
        q, v = _matrix(ask.column("q").combine_chunks(), dim), _matrix(there.column("v").combine_chunks(), dim)
        ids = there.column("entry").to_numpy()
        most = min(keep, len(ids))
        out_ids, out_scores = [], []
        for i in range(0, len(q), 1024):
            block = q[i:i + 1024]
            best = np.argpartition(-(block @ v.T), most - 1, axis=1)[:, :most]
            out_ids.append(ids[best].ravel())
            out_scores.append(exact_scores(block[:, None, :], v[best]).ravel())
        ends = pa.array(np.arange(len(q) + 1) * most, pa.int32())
        return pa.table({"entry": entry, "found": pa.ListArray.from_arrays(ends, pa.array(np.concatenate(out_ids))),
                         "scores": pa.ListArray.from_arrays(ends, pa.array(np.concatenate(out_scores)))})

    def answers(ask: DataFrame, there: DataFrame, place: list[str], search, least: str, bucket: str) -> DataFrame:
        """Both have parts, slices, entry, v and the columns of ``place``; and each a column of its own."""
        part, piece = (F.pmod(F.xxhash64("entry", F.lit(i)), c).cast("int") for i, c in enumerate(("parts", "slices")))
        all_parts, all_slices = (F.explode(F.sequence(F.lit(0), F.col(c) - 1)) for c in ("parts", "slices"))
        ask = ask.withColumn("slice", piece).withColumn("part", all_parts)
        there = there.withColumn("part", part).withColumn("slice", all_slices)
        at = [*place, "part", "slice"]
        # The two sides may come from one table: other names keep their columns apart.
        ask = ask.select(*at, "entry", "v", least).toDF(*[f"at_{c}" for c in at], "asking", "q", "least")
        there = there.select(*at, "entry", "v", bucket)
        return ask.groupBy([f"at_{c}" for c in at]).cogroup(there.groupBy(at)).applyInArrow(
            search, "entry long, found array<long>, scores array<double>")

    def everywhere(rows: DataFrame, blocks: int, pieces: int) -> DataFrame:
        return rows.select("entry", "v", F.lit(blocks).alias("parts"), F.lit(pieces).alias("slices"), F.lit(0).alias("whole"),
                           F.lit(0).alias("extra"))

    def merge(found: pa.Table) -> pa.Table:
        ids = found.column("found").combine_chunks().flatten().to_numpy()
        scores = found.column("scores").combine_chunks().flatten().to_numpy()
        ids, first = np.unique(ids, return_index=True)
        scores = scores[first]
        best = np.lexsort((ids, -scores))[:keep]
        return pa.table({"entry": pa.array(np.full(len(best), found.column("entry")[0].as_py())),
                         "other": pa.array(ids[best]), "score": pa.array(scores[best])})

    best = Window.partitionBy("entry").orderBy(F.desc("score"), "vec_id")

    def ranked_lists(found: DataFrame) -> DataFrame:
        merged = found.groupBy("entry").applyInArrow(merge, "entry long, other long, score double")
        return (merged.join(entries.select(F.col("entry").alias("other"), "members"), "other")
                .select("entry", "score", F.explode("members").alias("vec_id"))
                .withColumn("n", F.row_number().over(best)).filter(F.col("n") <= keep)
                .groupBy("entry").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score"))).alias("best")))

    asked = entries.filter("asked")
    found = []
    if hashings:
        found.append(answers(probed, hashed, place, search_block, "least", "bucket"))
    if others:
        pieces = [max(-(-n // BUCKET_ROWS), 1) for n in (others, n_asked)]
        apart = entries.filter(~F.col("band").isin(list(hashings)))
        found.append(answers(everywhere(asked, *pieces), everywhere(apart, *pieces), ["whole"], search, "extra", "extra"))
    lists = materialise(ranked_lists(reduce(DataFrame.unionByName, found)))
    full = lists.filter(F.size("best") >= min(keep, reachable or 0))
    short = materialise(asked.select("entry", "v").join(full, "entry", "left_anti"))
    n_short = short.count()
    if n_short:
        # Too few rows in the buckets: all vectors, in blocks.
        pieces = [-(-n // BUCKET_ROWS) for n in (sum(rows_of.values()), n_short)]
        lists = full.unionByName(ranked_lists(answers(
            everywhere(short, *pieces), everywhere(entries, *pieces), ["whole"], search, "extra", "extra")))
    lists = asked.select("entry", "v").join(lists, "entry").select("v", "best")
    asking = rows.filter("asks").select(F.col("vec_id").alias("query_id"), "v").distinct()
    ranked = asking.join(lists, "v").select("query_id", F.posexplode(F.slice(F.filter(
        "best", lambda b: b["vec_id"] != F.col("query_id")), 1, k)).alias("rank", "b"))
    return ranked.select("query_id", (F.col("rank") + 1).alias("rank"), "b.vec_id", "b.score")
