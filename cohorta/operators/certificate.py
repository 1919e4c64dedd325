"""A bound on how far a linear support vector fit is from the optimum.

Any dual point bounds the optimum from below. Many feasible ones are read off the margins of the
given weights in one pass, and the best combination of them is found on the driver: combinations of
feasible points are feasible. The bound holds for whatever solver made the weights. It is tight where margins
are spread out; where many rows share a few margins, weights that are a little off the optimum can
leave it far below.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Executors get the helpers below with the task; the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The candidates: a row's multiplier falls from C to 0 while its margin crosses a band around 1 that is
# so wide to each side and moved by so much, for the two labels alike or against each other.
WIDTHS = np.geomspace(1e-4, 1.0, 14)
MOVED = np.array([-0.5, -0.2, -0.1, -0.05, -0.02, -0.01, 0.0, 0.01, 0.02, 0.05, 0.1, 0.2, 0.5])
APART = np.array([-0.1, -0.02, 0.0, 0.02, 0.1])


class Gap(NamedTuple):
    """The optimum lies between ``dual`` and ``primal``."""
    primal: float
    dual: float

    @property
    def share(self) -> float:
        return (self.primal - self.dual) / self.primal if self.primal else 0.0


def _candidates() -> np.ndarray:
    return np.stack([a.reshape(-1) for a in np.meshgrid(WIDTHS, MOVED, APART, indexing="ij")], axis=1)


def _sums_of(x: np.ndarray, sign: np.ndarray, n: np.ndarray, weights: np.ndarray, intercept: float, c: float) -> np.ndarray:
    """Hinge loss, then per candidate and label the sum of multipliers and of multipliers times x."""
    margin = sign * (x @ weights + intercept)
    rules = _candidates()
    out = [np.array([c * (n * np.maximum(1 - margin, 0)).sum()])]
    for label in (1.0, -1.0):
        own = sign == label
        # Margins of one label against all bands at once, some rows at a time.
        total = np.zeros((len(rules), 1 + x.shape[1]))
        full = np.concatenate((np.ones((int(own.sum()), 1)), x[own]), axis=1)
        for i in range(0, len(full), 2048):
            m = margin[own][i:i + 2048, None] - 1 - rules[None, :, 1] - label * rules[None, :, 2]
            share = np.clip((rules[None, :, 0] - m) / (2 * rules[None, :, 0]), 0.0, 1.0)
            total += (c * share * n[own][i:i + 2048, None]).T @ full[i:i + 2048]
        out.append(total.reshape(-1))
    return np.concatenate(out)


def linear_gap(rows: DataFrame, weights: np.ndarray, intercept: float, c: float = 1.0, steps: int = 20_000) -> Gap:
    """The gap of a fit on collapsed rows (``newton.collapse``: x, y, n) that minimises half the squared
    weights and c times the summed hinge loss; the intercept is free. One job."""
    weights = np.asarray(weights, float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
                y, n = batch.column(1).to_numpy(), batch.column(2).to_numpy().astype(float)
                part = _sums_of(x, np.where(y == 1, 1.0, -1.0), n, weights, intercept, c)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["at", "value"])

    parts = rows.select("x", "y", "n").mapInArrow(run, "at long, value double")
    found = parts.groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    d, k = len(weights), len(_candidates())
    sums = np.zeros(1 + 2 * k * (1 + d))
    sums[found.column(0).to_numpy()] = found.column(1).to_numpy()
    up, down = sums[1:].reshape(2, k, 1 + d)
    # Multipliers of both labels must add up to the same: the larger side is scaled down.
    with np.errstate(all="ignore"):
        scale_up, scale_down = (np.nan_to_num(np.minimum(1.0, b / a)) for a, b in ((up[:, 0], down[:, 0]), (down[:, 0], up[:, 0])))
    height = up[:, 0] * scale_up + down[:, 0] * scale_down
    vector = up[:, 1:] * scale_up[:, None] - down[:, 1:] * scale_down[:, None]
    return Gap(float(0.5 * weights @ weights + sums[0]), _best_dual(height, vector, steps))


def _best_dual(height: np.ndarray, vector: np.ndarray, steps: int) -> float:
    """The highest dual value of a combination of candidates, by conditional gradients. All zeros is one too."""
    share, best = np.zeros(len(height)), 0.0
    for _ in range(steps):
        at = share @ vector
        best = max(best, float(share @ height - 0.5 * at @ at))
        slope = height - vector @ at
        toward = np.zeros(len(height))
        if slope.max() > 0:
            toward[int(np.argmax(slope))] = 1.0
        change = toward - share
        gain, moved = slope @ change, change @ vector
        if gain <= 1e-7 * max(best, 1e-12):
            break
        share += min(1.0, gain / (moved @ moved) if moved @ moved > 0 else 1.0) * change
    return best
