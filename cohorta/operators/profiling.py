"""Column profiles: every call is one job over all columns, not one job per column."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegralType, NumericType, StringType

from cohorta.config import STAY_KEYS
from cohorta.functions.scalar import vector_has_nan
from cohorta.operators.gram import correlations, pair_sums
from cohorta.operators.sketches import LEVEL_VALUES, merge_sketches, sketch_columns, sketch_quantiles

COUNTABLE_TYPES = ("double", "float", "int", "bigint")


def _is_fraction(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (DoubleType, FloatType))


def without_nan(c: str) -> Column:
    """The column as double with NaN turned into NULL."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def _one_pass(df: DataFrame, cols: list[str], measures: dict, key: str = "column") -> DataFrame:
    """One aggregate over all columns, turned into one row per column."""
    wide = df.agg(*[expr(c).alias(f"{name}_{i}") for i, c in enumerate(cols)
                    for name, expr in measures.items()])
    rows = [F.struct(F.lit(c).alias(key), *[F.col(f"{name}_{i}").alias(name) for name in measures])
            for i, c in enumerate(cols)]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, present, nulls, nans): rows with a value (NaN is one), NULLs and NaNs."""
    def nans(c: str) -> Column:
        if not _is_fraction(df, c):
            return F.count_if(F.lit(False))
        return F.count_if(F.isnan(c))

    return _one_pass(df, cols or df.columns,
                     {"present": lambda c: F.count(c), "nulls": lambda c: F.count_if(F.col(c).isNull()),
                      "nans": nans})


def column_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, n, mean, std, min, max) with the sample standard deviation."""
    return _one_pass(df, cols, {
        "n": lambda c: F.count(c), "mean": lambda c: F.avg(c), "std": lambda c: F.stddev_samp(c),
        "min": lambda c: F.min(F.col(c).cast("double")), "max": lambda c: F.max(F.col(c).cast("double"))})


def skewness_population(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, skew): moment ratio g1; NULL for a constant column."""
    return _one_pass(df, cols, {"skew": lambda c: F.skewness(c)})


def skewness_sample(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, skew): bias-corrected G1; NULL below three values or for a constant column."""
    def corrected(c: str) -> Column:
        n = F.count(c).cast("double")
        return F.when(n >= 3, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))

    return _one_pass(df, cols, {"skew": corrected})


def approx_quantiles(df: DataFrame, cols: list[str], probs: list[float], size: int = LEVEL_VALUES) -> DataFrame:
    """(column, prob, value, rank_error, n) from one pass: value's rank is prob n up to rank_error."""
    return sketch_quantiles(merge_sketches(sketch_columns(df, cols, size)), probs)


def _as_text(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value) rows; -0.0 and 0.0 become one value."""
    return (df.select(*[((F.col(c) + F.lit(0.0)) if _is_fraction(df, c) else F.col(c))
                        .cast("string").alias(c) for c in cols])
            .unpivot([], cols, "column", "value"))


def column_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value, n): the counts of every value. Hot values collapse before the shuffle."""
    return _as_text(df, cols).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def distinct_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, distinct_values): exact, NULL counted as one value."""
    return column_values(df, cols).groupBy("column").agg(F.count(F.lit(1)).alias("distinct_values"))


def distinct_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value): the non-null values, as a table because they may be many."""
    return _as_text(df, cols).filter(F.col("value").isNotNull()).distinct()


def column_mode(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value, n): most frequent value that is neither NULL nor NaN, the smallest on a tie.

    Counts are reduced per value first, so no task holds all values of a column. Numbers
    are ordered as numbers, everything else as text.
    """
    parts = []
    kinds = {c: "bigint" if isinstance(df.schema[c].dataType, IntegralType)
             else "double" if isinstance(df.schema[c].dataType, NumericType) else "string" for c in cols}
    for kind in ("bigint", "double", "string"):
        names = [c for c in cols if kinds[c] == kind]
        if not names:
            continue
        counts = (df.select(*[without_nan(c).alias(c) if kind == "double" else F.col(c).cast(kind).alias(c) for c in names])
                  .unpivot([], names, "column", "value")
                  .filter(F.col("value").isNotNull())
                  .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
        best = counts.groupBy("column").agg(
            F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value"),
            F.max("n").alias("n"))
        parts.append(best.withColumn("value", F.col("value").cast("string")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def column_kinds(df: DataFrame, ids: list[str] = STAY_KEYS, doubles_only: bool = False) -> dict[str, str]:
    """Kind by type: ``numeric`` or ``categorical``; ids and other types are left out.

    ``doubles_only`` takes only double columns as numeric, so counts stay outside.
    """
    kinds = {}
    for f in df.schema.fields:
        numeric = isinstance(f.dataType, DoubleType if doubles_only else NumericType)
        if numeric and f.name not in ids:
            kinds[f.name] = "numeric"
        elif isinstance(f.dataType, StringType):
            kinds[f.name] = "categorical"
    return kinds


def cardinality_classes(df: DataFrame, ids: list[str] = STAY_KEYS, categorical: list[str] = (),
                        threshold: int = 10) -> DataFrame:
    """(column, kind) of the numeric columns by number of values, NULL being one of them.

    Two values: binary; up to ``threshold``: categorical_numeric; more: continuous. Listed
    text columns pass through as categorical. Sketches settle the wide columns; only
    columns near the threshold are counted exactly.
    """
    numeric = [c for c, t in df.dtypes if t in COUNTABLE_TYPES and c not in ids]
    spark = df.sparkSession
    kinds = []
    if numeric:
        sizes = df.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in numeric]).first()
        narrow = [c for c in numeric if sizes[c] <= 2 * threshold + 10]
        exact = df.agg(*[(F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(c)
                         for c in narrow]).first() if narrow else {}
        for c in numeric:
            n = (exact[c] or 0) if c in narrow else math.inf
            kinds.append((c, "binary" if n == 2 else "categorical_numeric" if n <= threshold else "continuous"))
    kinds += [(c, "categorical") for c in categorical if c in df.columns]
    return spark.createDataFrame(kinds, "column string, kind string")


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """(x, y, r): Pearson correlation of every pair, each on the rows where both are present.

    NULL where a column is constant, NaN where one of the values is. Any number of columns in one
    pass over the rows (``gram.pair_sums``).
    """
    sums = pair_sums(df, cols)
    r, nan = correlations(sums), sums["nan"] > 0
    cells = [(x, y, math.nan if nan[i, j] else None if math.isnan(r[i, j]) else float(r[i, j]))
             for i, x in enumerate(cols) for j, y in enumerate(cols)]
    return df.sparkSession.createDataFrame(cells, "x string, y string, r double")


def complete_correlation(df: DataFrame, cols: list[str]) -> np.ndarray:
    """Pearson matrix over the rows that are complete in all columns; NaN beside the
    diagonal for a constant column."""
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).na.drop()
    r = correlations(pair_sums(rows, cols))
    np.fill_diagonal(r, 1.0)
    return r


def vif(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, r2, vif): variance inflation from the correlation matrix of complete rows.

    r2 of a feature on the others follows from their k x k correlations alone, so one
    job replaces k regressions; vif is infinite for an exact linear combination.
    """
    r = complete_correlation(df, cols)
    rows = []
    for i, c in enumerate(cols):
        rest = [j for j in range(len(cols)) if j != i]
        r2 = float(r[i, rest] @ np.linalg.pinv(r[np.ix_(rest, rest)], hermitian=True) @ r[rest, i]) \
            if np.isfinite(r).all() else math.nan
        rows.append((c, r2, math.inf if r2 >= 1 - 1e-12 else 1 / (1 - r2)))
    return df.sparkSession.createDataFrame(rows, "feature string, r2 double, vif double")


def nan_vector_count(df: DataFrame, vector: str) -> int:
    return df.filter(vector_has_nan(vector)).count()
