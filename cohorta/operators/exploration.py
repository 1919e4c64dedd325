"""The tables behind the plots: histograms, densities, box plots and pair plots."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohorta.operators.profiling import column_profile, without_nan
from cohorta.operators.ranking import exact_quantiles


# A finer rule than this is coarsened: neighbouring bins are merged, by powers of two.
MOST_BINS, MOST_PAIR_BINS = 1024, 128


def _long(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value) rows of doubles without NULL and NaN."""
    return (df.select(*[F.col(c).cast("double").alias(c) for c in cols])
            .unpivot([], cols, "column", "value")
            .filter(F.col("value").isNotNull() & ~F.isnan("value")))


def _ranges(df: DataFrame, cols: list[str]) -> dict[str, dict]:
    """Per column with values: n, mean, std, min, max over the values that are not NaN."""
    clean = df.select(*[without_nan(c).alias(c) for c in cols])
    return {r["column"]: r.asDict() for r in column_profile(clean, cols).collect() if r["n"]}


@dataclass(frozen=True)
class Summary:
    """What the plot tables need to know about each column; computed once for all of them."""

    ranges: dict[str, dict]
    quartiles: dict[str, list[float | None]]

    def bins(self, c: str, most: int = MOST_BINS) -> tuple[float, float, int]:
        """(low, width, bins): the narrower of the Sturges and Freedman-Diaconis widths.

        Outliers and many rows make the rule finer without end. Above ``most`` bins 2, 4, 8 ...
        neighbours become one, so every row is still counted; the last bin may reach beyond the range.
        """
        r = self.ranges[c]
        span, n = r["max"] - r["min"], r["n"]
        if span == 0:
            return r["min"] - 0.5, 1.0, 1
        sturges = span / (math.log2(n) + 1)
        fd = 2 * (self.quartiles[c][2] - self.quartiles[c][0]) / n ** (1 / 3)
        bins = math.ceil(span / (min(sturges, fd) if fd > 0 else sturges))
        merged = 2 ** math.ceil(math.log2(bins / most)) if bins > most else 1
        return r["min"], span / bins * merged, -(-bins // merged)


def summarise(df: DataFrame, cols: list[str]) -> Summary:
    """Range, moments and exact quartiles of the columns that have values."""
    ranges = _ranges(df, cols)
    return Summary(ranges, exact_quantiles(df, list(ranges), [0.25, 0.5, 0.75]) if ranges else {})


def _bin(value: Column, rule: tuple[float, float, int]) -> Column:
    low, width, bins = rule
    return F.least(F.floor((value - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, cols: list[str], summary: Summary | None = None) -> DataFrame:
    """(column, bin, low, high, n): counts of the non-empty bins; the last bin is closed."""
    summary = summary or summarise(df, cols)
    rule = {c: summary.bins(c) for c in cols if c in summary.ranges}
    placed, low, high = F.lit(None).cast("int"), F.lit(None).cast("double"), F.lit(None).cast("double")
    for c, r in rule.items():
        here = F.col("column") == c
        placed = F.when(here, _bin(F.col("value"), r)).otherwise(placed)
        low = F.when(here, F.lit(r[0]) + F.col("bin") * F.lit(r[1])).otherwise(low)
        high = F.when(here, F.lit(r[0]) + (F.col("bin") + 1) * F.lit(r[1])).otherwise(high)
    return (_long(df, list(rule)).groupBy("column", placed.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select("column", "bin", low.alias("low"), high.alias("high"), "n"))


def density(df: DataFrame, cols: list[str], points: int = 200, summary: Summary | None = None) -> DataFrame:
    """(column, point, x, density): Gaussian kernel estimate on an even grid over [min, max]
    with Scott's bandwidth, every value against every point. Equal values are counted once, then
    spread over the grid with a partial sum in each task.
    """
    known = summary.ranges if summary else _ranges(df, cols)
    ranges = {c: known[c] for c in cols if c in known and known[c]["n"] > 1 and known[c]["std"] > 0}
    counted = _long(df, list(ranges)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("w"))
    rules = {c: (r["min"], (r["max"] - r["min"]) / (points - 1), r["std"] * r["n"] ** -0.2, float(r["n"]))
             for c, r in ranges.items()}
    grid = counted.withColumns({name: _per_column(rules, i) for i, name in enumerate(("low", "step", "h", "n"))}).withColumn(
        "point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    x = F.col("low") + F.col("point") * F.col("step")
    z = (F.col("value") - x) / F.col("h")
    kernel = F.col("w") * F.exp(F.lit(-0.5) * z * z) / (F.col("n") * F.col("h") * F.lit(math.sqrt(2 * math.pi)))
    return grid.groupBy("column", "point").agg(F.max(x).alias("x"), F.sum(kernel).alias("density"))


def _per_column(rules: dict[str, tuple[float, ...]], i: int) -> Column:
    out = F.lit(None).cast("double")
    for c, rule in rules.items():
        out = F.when(F.col("column") == c, rule[i]).otherwise(out)
    return out


def boxplot_stats(df: DataFrame, cols: list[str], summary: Summary | None = None) -> DataFrame:
    """(column, q1, median, q3, low_whisker, high_whisker, outliers): whiskers end at the
    outermost values inside 1.5 IQR, values beyond are outliers."""
    known = summary.quartiles if summary else exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    quartiles = {c: known[c] for c in cols if known.get(c, [None])[0] is not None}
    lo, hi = F.lit(None).cast("double"), F.lit(None).cast("double")
    for c, (q1, _, q3) in quartiles.items():
        here = F.col("column") == c
        lo = F.when(here, q1 - 1.5 * (q3 - q1)).otherwise(lo)
        hi = F.when(here, q3 + 1.5 * (q3 - q1)).otherwise(hi)
    inside = (F.col("value") >= lo) & (F.col("value") <= hi)
    stats = _long(df, list(quartiles)).groupBy("column").agg(
        F.min(F.when(inside, F.col("value"))).alias("low_whisker"),
        F.max(F.when(inside, F.col("value"))).alias("high_whisker"),
        F.count_if(~inside).alias("outliers"))
    rows = [(c, *q) for c, q in quartiles.items()]
    return F.broadcast(df.sparkSession.createDataFrame(
        rows, "column string, q1 double, median double, q3 double")).join(stats, "column")


def pair_density(df: DataFrame, cols: list[str], summary: Summary | None = None) -> DataFrame:
    """(x, y, x_bin, y_bin, n): joint counts of every column pair on the histogram bins."""
    summary = summary or summarise(df, cols)
    rule = {c: summary.bins(c, MOST_PAIR_BINS) for c in cols if c in summary.ranges}
    names = [c for c in cols if c in rule]

    def usable(c: str) -> Column:
        return F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))

    cells = [F.when(usable(x) & usable(y), F.struct(
        F.lit(x).alias("x"), F.lit(y).alias("y"), _bin(F.col(x).cast("double"), rule[x]).alias("x_bin"),
        _bin(F.col(y).cast("double"), rule[y]).alias("y_bin")))
        for i, x in enumerate(names) for y in names[i + 1:]]
    return (df.select(F.explode(F.array(*cells)).alias("c")).filter(F.col("c").isNotNull())
            .groupBy("c.x", "c.y", "c.x_bin", "c.y_bin").agg(F.count(F.lit(1)).alias("n")))
