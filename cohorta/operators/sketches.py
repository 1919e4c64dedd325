"""Quantile sketches that are stored per part of a table and merged later without rereading it.

A sketch is a stack of sorted levels (Munro and Paterson 1980; Karnin, Lang and Liberty 2016): a value
on level l stands for 2 ** l values. A full level is sorted and every second value moves up, from the
first or the second in turn. That moves a rank by at most 2 ** l, so a sketch knows a bound of its own
error: the sum over its compactions. It holds for every input; there is no chance in it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohorta.session import materialise

# Executors get the helpers below with the task; the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEVEL_VALUES = 4096  # values of a level before it is compacted
MERGED_TOGETHER = 64  # sketches that one task merges
SKETCHES = "column string, n long, rank_error long, lowest double, highest double, data binary"


class Sketch:
    """Of the values of one column."""

    def __init__(self, size: int = LEVEL_VALUES):
        self.size, self.levels, self.turns = size, [], []
        self.n = self.rank_error = 0
        self.lowest, self.highest = np.inf, -np.inf

    def add(self, values: np.ndarray) -> None:
        if len(values):
            self.n += len(values)
            self.lowest, self.highest = min(self.lowest, values.min()), max(self.highest, values.max())
            self._put(0, values)

    def _put(self, level: int, values: np.ndarray) -> None:
        while len(self.levels) <= level:
            self.levels.append(np.zeros(0))
            self.turns.append(0)
        held = np.concatenate((self.levels[level], values))
        if len(held) >= self.size:
            held.sort()
            odd = held[len(held) - len(held) % 2:]  # the largest of an odd number stays
            up = held[self.turns[level]:len(held) - len(odd):2]
            self.turns[level] ^= 1
            self.levels[level] = odd
            self.rank_error += 1 << level
            self._put(level + 1, up)
        else:
            self.levels[level] = held

    def merge(self, other: Sketch) -> None:
        self.n += other.n
        self.rank_error += other.rank_error
        self.lowest, self.highest = min(self.lowest, other.lowest), max(self.highest, other.highest)
        for level, values in enumerate(other.levels):
            if len(values):
                self._put(level, values)

    def quantile(self, p: float) -> float | None:
        """A value whose rank among all values is p n up to ``rank_error`` and one value's weight."""
        if not self.n:
            return None
        values = np.concatenate(self.levels)
        weight = np.repeat([1 << k for k in range(len(self.levels))], [len(x) for x in self.levels])
        order = np.argsort(values, kind="stable")
        upto = np.cumsum(weight[order])
        return float(values[order][min(int(np.searchsorted(upto, p * self.n)), len(order) - 1)])

    def to_bytes(self) -> bytes:
        head = np.array([self.size, len(self.levels), *[len(x) for x in self.levels], *self.turns], "<i8")
        return head.tobytes() + b"".join(np.sort(x).astype("<f8").tobytes() for x in self.levels)

    @classmethod
    def of(cls, n: int, rank_error: int, lowest: float, highest: float, data: bytes) -> Sketch:
        size, number = np.frombuffer(data, "<i8", 2).tolist()
        counts = np.frombuffer(data, "<i8", number, 16).tolist()
        out = cls(size)
        out.turns = np.frombuffer(data, "<i8", number, 16 + 8 * number).tolist()
        out.levels = np.split(np.frombuffer(data, "<f8", sum(counts), 16 + 16 * number), np.cumsum(counts)[:-1]) if number else []
        out.n, out.rank_error, out.lowest, out.highest = n, rank_error, lowest, highest
        return out

    def row(self, column: str) -> tuple:
        return (column, self.n, self.rank_error, float(self.lowest), float(self.highest), self.to_bytes())


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                      names=["column", "n", "rank_error", "lowest", "highest", "data"])


def sketch_columns(df: DataFrame, cols: list[str], size: int = LEVEL_VALUES) -> DataFrame:
    """One sketch per column and partition; NULL and NaN are skipped. A table to store: sketches of
    more rows are added to it, and ``merge_sketches`` reads it instead of the rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {c: Sketch(size) for c in cols}
        for batch in batches:
            for c, column in zip(cols, batch.columns):
                values = column.drop_null().to_numpy(zero_copy_only=False)
                found[c].add(values[~np.isnan(values)])
        yield _batch([s.row(c) for c, s in found.items() if s.n])

    return df.select(*[F.col(c).cast("double").alias(c) for c in cols]).mapInArrow(run, SKETCHES)


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """One sketch per column. In rounds, so that no task holds the sketches of all partitions."""
    def run(table: pa.Table) -> pa.Table:
        total: Sketch | None = None
        for r in table.sort_by("n").to_pylist():
            one = Sketch.of(*[r[c] for c in ("n", "rank_error", "lowest", "highest", "data")])
            if total is None:
                total = one
            else:
                total.merge(one)
        return pa.Table.from_batches([_batch([total.row(table.column("column")[0].as_py())])])

    rows = materialise(sketches.select("column", "n", "rank_error", "lowest", "highest", "data"))
    while True:
        most = rows.groupBy("column").agg(F.count(F.lit(1)).alias("k")).agg(F.max("k")).first()[0] or 0
        if most <= 1:
            return rows
        groups = -(-most // MERGED_TOGETHER)
        part = F.pmod(F.xxhash64("data", "n"), F.lit(groups))
        rows = materialise(rows.withColumn("part", part).groupBy("column", "part").applyInArrow(run, SKETCHES))


def sketch_quantiles(merged: DataFrame, probs: list[float]) -> DataFrame:
    """(column, prob, value, rank_error, n) of merged sketches: value's rank is prob n up to rank_error.

    The error counts the weight of one value on the highest level as well; quantiles 0 and 1 are exact.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                one = Sketch.of(*[r[c] for c in ("n", "rank_error", "lowest", "highest", "data")])
                for p in probs:
                    ends = {0.0: one.lowest, 1.0: one.highest}
                    error = 0 if p in ends else one.rank_error + (1 << max(len(one.levels) - 1, 0))
                    rows.append((r["column"], p, ends[p] if p in ends else one.quantile(p), error, one.n))
            kinds = [pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], k) for i, k in enumerate(kinds)],
                                             names=["column", "prob", "value", "rank_error", "n"])

    return merged.mapInArrow(run, "column string, prob double, value double, rank_error long, n long")


def sketch_brackets(merged: DataFrame, probs: list[float]) -> DataFrame:
    """(column, prob, low, high, n) of merged sketches: the values on both sides of the sorted position
    prob (n - 1) lie in [low, high], whatever the sketch's error; an end that it leaves open is infinite."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                one = Sketch.of(*[r[c] for c in ("n", "rank_error", "lowest", "highest", "data")])
                error = one.rank_error + 1
                for p in probs:
                    first, last = np.floor(p * (one.n - 1)) + 1 - error, np.ceil(p * (one.n - 1)) + 1 + error
                    rows.append((r["column"], p, one.quantile(first / one.n) if first > 0 else -np.inf,
                                 one.quantile(last / one.n) if last <= one.n else np.inf, one.n))
            kinds = [pa.string(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], k) for i, k in enumerate(kinds)],
                                             names=["column", "prob", "low", "high", "n"])

    return merged.mapInArrow(run, "column string, prob double, low double, high double, n long")
