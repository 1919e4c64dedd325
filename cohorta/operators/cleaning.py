"""Imputation, capping, logs, assembly and scaling.

Fitted steps are Spark ML transformers that carry their constants, so a whole chain is
saved as one ``PipelineModel`` and scoring data never refits a step.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import Imputer, SQLTransformer, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohorta.operators.profiling import approx_quantiles, column_mode
from cohorta.operators.ranking import exact_quantiles
from cohorta.functions.scalar import vector_has_nan


class QualityGateError(ValueError):
    """The data of a step cannot be used: no rows, or NaN in the features."""


def _number(value: float) -> str:
    return f"double('{float(value)!r}')"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def replace_columns(exprs: dict[str, str]) -> SQLTransformer:
    """Transformer that replaces columns by SQL expressions over the old ones."""
    if not exprs:
        return SQLTransformer(statement="SELECT * FROM __THIS__")
    old = ", ".join(f"`{c}`" for c in exprs)
    new = ", ".join(f"{e} AS `{c}`" for c, e in exprs.items())
    return SQLTransformer(statement=f"SELECT * EXCEPT ({old}), {new} FROM __THIS__")


def mean_imputer(df: DataFrame, cols: list[str]) -> Transformer:
    """NULL becomes the column mean; NaN stays. A column without values is left alone."""
    if not cols:
        return replace_columns({})
    means = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    return replace_columns({c: f"coalesce(cast(`{c}` as double), {_number(means[c])})"
                            for c in cols if means[c] is not None})


def mean_imputer_nan(df: DataFrame, cols: list[str]) -> Transformer:
    """NULL and NaN become the mean of the other values."""
    doubles = [F.col(c).cast("double").alias(c) for c in cols]
    return Imputer(strategy="mean", inputCols=cols, outputCols=cols).fit(df.select(*doubles))


def mode_imputer(df: DataFrame, cols: list[str], default: str = "Unknown") -> Transformer:
    """NULL, and NaN in a fraction, becomes the most frequent value; a text column without values
    gets ``default``, a number column without values is left alone."""
    if not cols:
        return replace_columns({})
    modes = {r["column"]: r["value"] for r in column_mode(df, cols).collect()}
    kinds = dict(df.dtypes)
    exprs = {}
    for c in cols:
        if c not in modes and kinds[c] != "string":
            continue
        old = f"nanvl(`{c}`, cast(null as {kinds[c]}))" if kinds[c] in ("double", "float") else f"`{c}`"
        exprs[c] = f"coalesce({old}, cast({_text(modes.get(c, default))} as {kinds[c]}))"
    return replace_columns(exprs)


def iqr_fences(df: DataFrame, cols: list[str], exact: bool = False,
               quartiles: dict[str, tuple] | None = None) -> dict[str, tuple[float, float]]:
    """(Q1 - 1.5 IQR, Q3 + 1.5 IQR) per column that has values; ``quartiles`` if already known, as from
    stored sketches. Without ``exact`` the quartiles are those of a sketch that knows its error."""
    if not cols:
        return {}
    if quartiles:
        quartiles = {c: quartiles[c] for c in cols}
    elif exact:
        quartiles = exact_quantiles(df, cols, [0.25, 0.75])
    else:
        found = {(r["column"], r["prob"]): r["value"] for r in approx_quantiles(df, cols, [0.25, 0.75]).collect()}
        quartiles = {c: (found.get((c, 0.25)), found.get((c, 0.75))) for c in cols}
    out = {}
    for c, (q1, q3) in quartiles.items():
        if q1 is not None:
            out[c] = (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    return out


def iqr_capper(df: DataFrame, cols: list[str], exact: bool = False,
               quartiles: dict[str, tuple] | None = None) -> Transformer:
    """Values outside the fences become the fence; NULL stays NULL."""
    fences = iqr_fences(df, cols, exact, quartiles)
    return replace_columns({
        c: f"case when `{c}` < {_number(lo)} then {_number(lo)} "
           f"when `{c}` > {_number(hi)} then {_number(hi)} else cast(`{c}` as double) end"
        for c, (lo, hi) in fences.items()})


def zero_filler(cols: list[str]) -> Transformer:
    """NULL becomes zero; NaN stays."""
    return replace_columns({c: f"coalesce(`{c}`, 0)" for c in cols})


def log_adder(cols: list[str]) -> Transformer:
    """Adds or refreshes ``log_<c>`` = log(1+c); NULL for c <= -1."""
    new = ", ".join(f"log1p(`{c}`) AS `log_{c}`" for c in cols)
    return SQLTransformer(statement=f"SELECT *, {new} FROM __THIS__")


def assembler(cols: list[str], output: str = "features", on_invalid: str = "error") -> VectorAssembler:
    """``on_invalid``: error, skip or keep (keep writes NaN for missing values)."""
    return VectorAssembler(inputCols=cols, outputCol=output, handleInvalid=on_invalid)


def scaler(input_col: str = "features", output: str = "scaled_features") -> StandardScaler:
    """(x - mean) / sample std per dimension; a constant dimension becomes 0."""
    return StandardScaler(inputCol=input_col, outputCol=output, withMean=True, withStd=True)


def fit_scaling(df: DataFrame, cols: list[str], output: str = "scaled_features",
                on_invalid: str = "error") -> PipelineModel:
    vector = f"{output}_raw"
    return Pipeline(stages=[assembler(cols, vector, on_invalid), scaler(vector, output)]).fit(df)


def check_vectors(df: DataFrame, vector: str) -> int:
    """Gate on a feature vector column: at least one vector, none with a NaN. One job."""
    row = df.agg(F.count(vector).alias("rows"),
                 F.count_if(F.col(vector).isNotNull() & vector_has_nan(vector)).alias("bad")).first()
    if row["rows"] == 0:
        raise QualityGateError(f"no rows with a {vector} vector")
    if row["bad"] > 0:
        raise QualityGateError(f"{row['bad']} {vector} vectors contain NaN")
    return row["rows"]
