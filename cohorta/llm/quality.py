"""Quality classifier: Bradley-Terry scores learned from pairs of a better and a worse document.

Features are computed per document in its own task. The fit works on all labelled rows, where they
are: the driver sees sums, the counts between cuts and the values at the cuts. Scoring is a dot product.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohorta.llm.bpe import ragged
from cohorta.llm.common import text_of, travels
from cohorta.operators.ranking import running_totals
from cohorta.session import materialise

travels(__name__)

PAIRS_PER_ROW = 4
DRAWN_TOGETHER = 65_536  # rows of a label whose partners come from one stream of random numbers
CUTS = np.linspace(0.001, 0.999, 999)  # quantiles of the scores among which the threshold is sought
CUT = 0.7  # the score at which the threshold lies

FEATURES = [
    "log_words", "few_words", "word_length", "symbols", "marked_words", "exclaimed", "upper", "digits", "commas",
    "stops", "same_as_previous", "different_words", "same_lines", "line_words",
]
_SYMBOLS = np.frombuffer(b"#*$%&|<>@^~\\_=+{}[]", np.uint8)
_UPPER = slice(ord("A"), ord("Z") + 1)
_LOWER = slice(ord("a"), ord("z") + 1)


def features_of(text: str) -> list[float]:
    """Rates in [0, 1] and a few logs; an empty text has zeros but for ``few_words``."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0, 1.0] + [0.0] * (len(FEATURES) - 2)
    chars = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    size = max(int(chars.sum()), 1)
    letters = int(chars[_UPPER].sum() + chars[_LOWER].sum()) or 1
    same = sum(map(eq, words, islice(words, 1, None))) / n
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    symbols = int(chars[_SYMBOLS].sum())
    return [
        np.log1p(n) / 10, 1 / (1 + n / 20), min(len(text) / n / 12, 3.0), min(symbols / size * 5, 2.0),
        min(symbols / n, 3.0), min(int(chars[ord("!")]) / n, 3.0), int(chars[_UPPER].sum()) / letters,
        min(int(chars[ord("0"):ord("9") + 1].sum()) / size * 5, 2.0), min(int(chars[ord(",")]) / n, 1.0),
        int(chars[ord(".")]) / n, same, len(set(words)) / n, 1 - len(set(lines)) / max(len(lines), 1),
        np.log1p(n / max(len(lines), 1)) / 5,
    ]


@dataclass
class PairwiseModel:
    """``score`` = logistic of (w.x - threshold) / width, moved so that the threshold gets ``CUT``."""

    mean: list[float]
    scale: list[float]
    weights: list[float]
    threshold: float = 0.0
    width: float = 1.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - np.array(self.mean)) / np.array(self.scale)) @ np.array(self.weights)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (self.raw(x) - self.threshold) / self.width + np.log(CUT / (1 - CUT))
        # Whole float steps keep the threshold itself on the accepted side.
        return np.clip(1 / (1 + np.exp(-np.clip(z, -35, 35))), 0.0, 1.0)


def _sums(rows: DataFrame, size: int, part: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """``part`` of every batch, added up: one job, one row per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += part(batch)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["total"])

    found = rows.mapInArrow(run, "total array<double>").toArrow().column(0)
    return np.array(found.to_pylist(), float).reshape(-1, size).sum(axis=0)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(FEATURES))


def drawn(label: int, block: int, sizes: list[int], seed: int) -> np.ndarray:
    """For the rows of a block of a label the places of their partners among the other label's rows,
    ``PAIRS_PER_ROW`` each. A block of both labels has a stream of its own."""
    draw = np.random.Generator(np.random.PCG64(seed).jumped(block) if block else np.random.PCG64(seed))
    here = [min(max(n - block * DRAWN_TOGETHER, 0), DRAWN_TOGETHER) * PAIRS_PER_ROW for n in sizes]
    found = draw.integers(0, sizes[1], here[0])
    return found if label == 0 else draw.integers(0, sizes[0], here[1])


def _differences(rows: DataFrame, sizes: list[int], scale: np.ndarray, seed: int) -> DataFrame:
    """The scaled differences of a better and a worse row of all pairs, many in one value, written once."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple = (None, None)
        for batch in batches:
            labels, place = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            block = place // DRAWN_TOGETHER
            for label, number in sorted(set(zip(labels.tolist(), block.tolist()))):
                if kept[0] != (label, number):
                    kept = (label, number), drawn(label, number, sizes, seed).reshape(-1, PAIRS_PER_ROW)
                at = np.flatnonzero((labels == label) & (block == number))
                partners = kept[1][place[at] - number * DRAWN_TOGETHER].ravel()
                own = batch.column(2).take(pa.array(np.repeat(at, PAIRS_PER_ROW)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(partners), 1 - label, np.int32)), pa.array(partners), own],
                    names=["label", "place", "own"])

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sign = np.where(batch.column(0).to_numpy() == 1, -1.0, 1.0)[:, None]  # of a better partner
                d = sign * (_matrix(batch.column(1)) - _matrix(batch.column(2))) / scale
                yield pa.RecordBatch.from_arrays([pa.array([d.tobytes()], pa.binary())], names=["d"])

    asked = rows.select("label", "place", "x").mapInArrow(ask, "label int, place long, own array<double>")
    pairs = asked.join(rows, ["label", "place"]).select("label", "own", "x")
    return materialise(pairs.mapInArrow(differ, "d binary"))


def fit_pairwise(differences: DataFrame, pairs: int, ridge: float = 1e-3, steps: int = 30) -> np.ndarray:
    """Newton steps on the logistic loss of the feature differences; one job per step."""
    k = len(FEATURES)
    w = np.zeros(k)
    for _ in range(steps):
        def part(batch: pa.RecordBatch, w: np.ndarray = w) -> np.ndarray:
            total = np.zeros(k + k * k)
            for value in batch.column(0):
                d = np.frombuffer(value.as_buffer()).reshape(-1, k)
                p = 1 / (1 + np.exp(-np.clip(d @ w, -35, 35)))
                total[:k] += d.T @ (p - 1)
                total[k:] += ((d * (p * (1 - p))[:, None]).T @ d).ravel()
            return total

        sums = _sums(differences, k + k * k, part) / pairs
        step = np.linalg.solve(sums[k:].reshape(k, k) + ridge * np.eye(k), sums[:k] + ridge * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _quantiles(scores: DataFrame, rows: int) -> np.ndarray:
    """The quantiles ``CUTS`` of column ``raw``, exact and interpolated."""
    at = CUTS * (rows - 1)
    wanted = np.unique(np.concatenate((np.floor(at), np.ceil(at)))).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, n, upto = (batch.column(i).to_numpy() for i in range(3))
            first, last = np.searchsorted(wanted, upto - n), np.searchsorted(wanted, upto)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ragged(wanted, first, last - first)), pa.array(np.repeat(raw, last - first))], names=["k", "raw"])

    counted = scores.groupBy("raw").agg(F.count(F.lit(1)).alias("n"))
    placed = running_totals(counted, "raw", {"n": "upto"}).select("raw", "n", "upto")
    found = placed.mapInArrow(run, "k long, raw double").toArrow()
    values = found.column(1).to_numpy()[np.argsort(found.column(0).to_numpy())]
    low, high = (values[np.searchsorted(wanted, e(at).astype(np.int64))] for e in (np.floor, np.ceil))
    return low + (high - low) * (at - np.floor(at))


def fit(rows: DataFrame, seed: int = 7) -> PairwiseModel:
    """Learn from rows of label, doc_id and x (a doc_id once per label): pairs, weights, then the threshold.

    Each row is paired with ``PAIRS_PER_ROW`` drawn rows of the other label. The threshold is the
    quantile of the training scores that tells the labels apart best (balanced accuracy). Without
    rows of both labels no pair exists; every document then gets the neutral score ``CUT``.
    """
    k = len(FEATURES)
    placed = running_totals(rows.withColumn("one", F.lit(1)), "doc_id", {"one": "place"}, groups=["label"])
    placed = materialise(placed.select("label", (F.col("place") - 1).alias("place"), "x"))
    counts = {r["label"]: r["n"] for r in placed.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = [counts.get(0, 0), counts.get(1, 0)]
    if not all(sizes):
        return PairwiseModel([0.0] * k, [1.0] * k, [0.0] * k)
    features, n = placed.select("x"), sum(sizes)
    mean = _sums(features, k, lambda batch: _matrix(batch.column(0)).sum(axis=0)) / n
    scale = np.sqrt(_sums(features, k, lambda batch: ((_matrix(batch.column(0)) - mean) ** 2).sum(axis=0)) / n)
    scale[scale < 1e-9] = 1.0
    weights = fit_pairwise(_differences(placed, sizes, scale, seed), n * PAIRS_PER_ROW)
    model = PairwiseModel(mean.tolist(), scale.tolist(), weights.tolist())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.raw(_matrix(batch.column(1))))],
                                             names=["label", "raw"])

    scores = materialise(placed.select("label", "x").mapInArrow(score, "label int, raw double"))
    cuts = _quantiles(scores, n)

    def below(batch: pa.RecordBatch) -> np.ndarray:
        first = np.searchsorted(cuts, batch.column(1).to_numpy(), "right")  # the first cut above
        return np.bincount(batch.column(0).to_numpy() * (len(cuts) + 1) + first, minlength=2 * (len(cuts) + 1))

    down, up = np.cumsum(_sums(scores, 2 * (len(cuts) + 1), below).reshape(2, -1), axis=1)[:, :-1]
    right = (1 - up / sizes[1]) + down / sizes[0]
    best = np.flatnonzero(right == right.max())
    centre = _sums(scores, 1, lambda batch: batch.column(1).to_numpy().sum(keepdims=True)) / n
    spread = _sums(scores, 1, lambda batch: ((batch.column(1).to_numpy() - centre) ** 2).sum(keepdims=True)) / n
    model.threshold = float(cuts[best[len(best) // 2]])
    model.width = float(max(np.sqrt(spread[0]) / 2, 1e-6))
    return model


def with_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``x``, the features of the whole text; null texts count as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features_of(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "x"])

    id_type = dict(docs.dtypes)[id_col]
    picked = docs.select(docs[id_col].alias("doc_id"), text_of(text_col).alias("text"))
    return picked.mapInArrow(run, f"doc_id {id_type}, x array<double>")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % 4 == 2


def training_rows(features: DataFrame, labels: DataFrame, label_col: str = "quality") -> DataFrame:
    """label, doc_id and x of all labelled documents outside the held-out part.

    Null labels and ids are no labels, nor are those of documents that are not there; a document
    labelled both ways counts for each. Of rows that repeat an id the least features count.
    """
    known = (labels.select(F.col("doc_id"), F.col(label_col).cast("int").alias("label"))
             .filter(F.col("label").isin(0, 1) & ~held_out()).distinct())
    least = features.filter("doc_id is not null").filter(~held_out()).groupBy("doc_id").agg(F.min("x").alias("x"))
    return least.join(known, "doc_id").select("label", "doc_id", "x")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              label_col: str = "quality") -> DataFrame:
    """The rows of ``docs``, all columns, whose score is at least ``CUT``.

    The model is that of ``score_documents``; no text is shuffled for it, and the filter works in
    place. Rows without an id are judged like all others. Without labels of both kinds every row stays.
    """
    learned = docs.filter(docs[id_col].isNotNull() & ~held_out(id_col))
    model = fit(training_rows(with_features(learned, id_col, text_col), labels, label_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            x = np.array([features_of(t or "") for t in texts], float).reshape(len(texts), len(FEATURES))
            yield batch.filter(pa.array(model.score(x) >= CUT))

    return docs.mapInArrow(run, docs.schema)


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "quality") -> DataFrame:
    """One row per input row: doc_id, held_out, score in [0, 1] and predicted (score >= CUT).

    Only the text makes the score. Null and empty texts are scored like a text without words;
    repeated rows get the same score; an empty table gives no rows, and without labels of both
    kinds every score is ``CUT``. Features are checkpointed, so the texts are read once.
    """
    features = materialise(with_features(docs, id_col, text_col))
    model = fit(training_rows(features, labels, label_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(FEATURES))
            score = model.score(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array((score >= CUT).astype("int32"))],
                names=["doc_id", "score", "predicted"])

    scored = features.mapInArrow(run, f"doc_id {dict(features.dtypes)['doc_id']}, score double, predicted int")
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
