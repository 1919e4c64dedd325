"""Scalar expressions of the inventory."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def age_years(admitted: Column | str, born: Column | str) -> Column:
    """Age at admission in years, two digits, half up."""
    return F.round(F.months_between(_col(admitted), _col(born)) / 12, 2)


def log1p_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Add ``log_<c>`` = log(1+c) for each column that has none yet; NULL for c <= -1."""
    new = {f"log_{c}": F.log1p(F.col(c)) for c in cols if f"log_{c}" not in df.columns}
    return df.withColumns(new) if new else df


def threshold_score(score: Column | str, cut: float = 0.5) -> Column:
    """Class 1 from ``cut`` upwards, else 0; a missing score counts as class 0."""
    return F.when(_col(score) >= F.lit(cut), 1).otherwise(0)


def positive_probability(col: Column | str = "probability") -> Column:
    """Element 1 of a probability vector."""
    return vector_to_array(_col(col))[1]


def vector_has_nan(col: Column | str) -> Column:
    return F.exists(vector_to_array(_col(col)), F.isnan)
