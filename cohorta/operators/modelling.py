"""Fitting, tuning, storing and scoring of classifiers with Spark ML.

Every fitted model is a ``PipelineModel``; it adds ``prediction`` and, unless it is a
linear regression, ``probability``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohorta.config import SEED
from cohorta.functions.scalar import positive_probability, threshold_score
from cohorta.operators import hinge, newton
from cohorta.operators.kernel import FourierFeatures, FourierMargin, LinearMargin
from cohorta.operators.sampling import stratified_folds
from cohorta.session import materialise

# The grids that are searched and the stopping tolerances of their fits.
C_GRID = [0.01, 0.1, 1.0, 10.0]
PENALTIES = ["l1", "l2"]
GAMMAS = ["scale", "auto"]
GRID_TOL = 1e-4
SVM_TOL = 1e-3

KERNELS = ["linear", "rbf"]

ROWS_PER_TASK = 250_000
LEAST_ROWS_PER_TASK = 50_000
LEAST_COPIES = 4  # of a row on average, for a linear machine to be fitted on different rows with counts
LEAST_MAPPED_ROWS = 5_000  # of rows that every pass maps to Fourier features


def penalty_weight(c: float, rows: int) -> float:
    """C weighs the summed loss against the penalty, Spark weighs the mean loss: 1 / (C n)."""
    return 1.0 / (c * rows)


def _dealt(df: DataFrame, rows: int, least: int = LEAST_ROWS_PER_TASK) -> DataFrame:
    """Training rows in even partitions: one shuffle against hundreds of passes over them.
    Their number grows with the rows. Small tables get few partitions, as each pass starts one
    task per partition; middling ones as many as there are cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(rows // ROWS_PER_TASK + 1, min(rows // least + 1, cores)))


def fit_logistic(df: DataFrame, features: str, label: str, c: float = 1.0, penalty: str = "l2",
                 max_iter: int = 1000, tol: float = 1e-8) -> PipelineModel:
    """Penalised logistic regression with the penalty on the features as they are."""
    rows = df.count()
    lr = LogisticRegression(
        featuresCol=features, labelCol=label, maxIter=max_iter, tol=tol, standardization=False,
        regParam=penalty_weight(c, rows), elasticNetParam=1.0 if penalty == "l1" else 0.0)
    return Pipeline(stages=[lr]).fit(_dealt(df.select(features, label), rows))


def fit_plain_logistic(df: DataFrame, features: str, label: str) -> PipelineModel:
    """Logistic regression without a penalty."""
    lr = LogisticRegression(featuresCol=features, labelCol=label)
    return Pipeline(stages=[lr]).fit(_dealt(df.select(features, label), df.count()))


def fit_linear(df: DataFrame, features: str, label: str) -> PipelineModel:
    """Least squares on the 0/1 label; the fitted value is the score."""
    return Pipeline(stages=[LinearRegression(featuresCol=features, labelCol=label)]).fit(df)


def regression_summary(df: DataFrame, features: str, label: str) -> tuple[list[float], float, float]:
    """(coefficients, intercept, R2) of a least squares fit."""
    model = LinearRegression(featuresCol=features, labelCol=label).fit(df)
    return [float(c) for c in model.coefficients], float(model.intercept), float(model.summary.r2)


def kernel_width(df: DataFrame, features: str, gamma: str) -> tuple[float, int]:
    """(gamma, d): ``auto`` = 1/d, ``scale`` = 1/(d var) over all cells of the feature matrix."""
    x = vector_to_array(features)
    total = F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
    square = F.aggregate(x, F.lit(0.0), lambda s, v: s + v * v)
    row = df.agg(F.sum(F.size(x)).alias("n"), F.sum(total).alias("s"), F.sum(square).alias("q"),
                 F.max(F.size(x)).alias("d")).first()
    d = row["d"]
    variance = row["q"] / row["n"] - (row["s"] / row["n"]) ** 2
    return (1.0 / d if gamma == "auto" or variance <= 0 else 1.0 / (d * variance)), d


def fit_svm(df: DataFrame, features: str, label: str, c: float = 1.0, kernel: str = "rbf",
            gamma: str = "scale", size: int = 200, seed: int = SEED, max_iter: int = 100) -> PipelineModel:
    """Support vector classifier with a probability from Platt scaling of its margin.

    With the rbf kernel the fit makes the Fourier features anew in each pass: no row is stored with them.
    A linear fit reads equal rows as one with a count, unless few are equal; its steps are the same.
    """
    if kernel == "rbf":
        rows = df.count()
        fourier = _fourier(df, features, gamma, size, seed)
        placed = _placed(df, features, label, fourier.getOrDefault("inputs"), rows)
        weights, = hinge.fit_all(placed, [fourier.kernel()], [hinge.Fit(0, penalty_weight(c, rows))],
                                 fourier.getOrDefault("inputs"), tol=SVM_TOL, most=max_iter)
        machine = FourierMargin.of(fourier, weights, "margin")
        train = _vectors(placed, features, label)
    else:
        x = vector_to_array(features)
        first = df.select(F.size(x)).first()
        if first is None:
            raise ValueError("no rows to fit")
        inputs = first[0]
        few = hinge.collapse(hinge.training_rows(df, x, label, inputs))
        rows, different = few.agg(F.sum("n"), F.count("n")).first()
        train = _dealt(df.select(features, label), rows)
        if different * LEAST_COPIES <= rows:
            weights, = hinge.fit_all(materialise(_dealt(few, different)), [hinge.Kernel()],
                                     [hinge.Fit(0, penalty_weight(c, rows))], inputs, tol=SVM_TOL, most=max_iter)
            machine = LinearMargin.of(weights, features, "margin")
        else:
            machine = LinearSVC(featuresCol=features, labelCol=label, maxIter=max_iter, tol=SVM_TOL, standardization=False,
                                regParam=penalty_weight(c, rows), rawPredictionCol="margin")
    platt = LogisticRegression(featuresCol="margin_of_1", labelCol=label, predictionCol="platt_prediction",
                               rawPredictionCol="platt_raw", probabilityCol="probability")
    return Pipeline(stages=[machine, VectorSlicer(inputCol="margin", outputCol="margin_of_1", indices=[1]),
                            platt]).fit(train)


def _fourier(df: DataFrame, features: str, gamma: str, size: int, seed: int) -> FourierFeatures:
    width, d = kernel_width(df, features, gamma)
    return FourierFeatures(inputCol=features, outputCol=f"{features}_{gamma}", gamma=width, inputs=d, size=size, seed=seed)


def _placed(df: DataFrame, features: str, label: str, inputs: int, rows: int, fold: str | None = None) -> DataFrame:
    """Training rows of ``hinge``, written once as the fits read them many times."""
    return materialise(_dealt(hinge.training_rows(df, vector_to_array(features), label, inputs, fold), rows,
                              LEAST_MAPPED_ROWS))


def _vectors(placed: DataFrame, features: str, label: str) -> DataFrame:
    return placed.select(array_to_vector("x").alias(features), F.col("y").alias(label))


def score_rows(model: PipelineModel, df: DataFrame, label: str, keep: list[str] | None = None) -> DataFrame:
    """(keep, actual, prediction, probability). A linear score is cut at one half."""
    out = model.transform(df)
    if "probability" in out.columns:
        prediction, score = F.col("prediction").cast("int"), positive_probability()
    else:
        prediction, score = threshold_score("prediction"), F.col("prediction")
    return out.select(*(keep or []), F.col(label).cast("int").alias("actual"),
                      prediction.alias("prediction"), score.alias("probability"))


def score_models(models: dict[str, PipelineModel], df: DataFrame, label: str,
                 keep: list[str] | None = None) -> DataFrame:
    """Rows of ``score_rows`` for every model, with its name in ``model``."""
    parts = [score_rows(m, df, label, keep).withColumn("model", F.lit(name)) for name, m in models.items()]
    return reduce(DataFrame.unionByName, parts)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_models(models: dict[str, PipelineModel], folder: str) -> None:
    for name, model in models.items():
        save_model(model, f"{folder}/{name}")


def load_models(folder: str, names: list[str]) -> dict[str, PipelineModel]:
    return {name: load_model(f"{folder}/{name}") for name in names}


def evaluator_auc(scored: DataFrame, label: str) -> float:
    """Area under ROC by the Spark evaluator, without down-sampled curve points."""
    return BinaryClassificationEvaluator(labelCol=label, numBins=0).evaluate(scored)


def tune_logistic(df: DataFrame, features: str, label: str, keys: list[str], folds: int = 5,
                  seed: int = SEED, max_iter: int = 1000):
    """Grid over C and penalty by cross-validated accuracy.

    All cells and folds take their Newton steps together: one job per step. Returns (cells with C,
    penalty, accuracy and whether best, model refitted on all rows).
    """
    placed = stratified_folds(df.select(*keys, features, label), folds, label, keys, seed)
    rows = newton.collapse(placed, vector_to_array(features), label, "fold")
    cells = [(c, p) for c in C_GRID for p in PENALTIES]
    fits = [newton.Fit(c, p, fold) for c, p in cells for fold in range(folds)]
    weights = newton.fit_all(rows, fits, rows.select(F.size("x")).first()[0], tol=GRID_TOL)
    right = newton.held_out_accuracy(rows, fits, weights)
    parts = [[a for a in right[i * folds:(i + 1) * folds] if a is not None] for i in range(len(cells))]
    scores = [sum(p) / len(p) for p in parts]
    best = max(range(len(cells)), key=lambda i: scores[i])
    model = fit_logistic(df, features, label, *cells[best], max_iter=max_iter)
    listed = [(c, p, s, i == best) for i, ((c, p), s) in enumerate(zip(cells, scores))]
    return df.sparkSession.createDataFrame(
        listed, "c double, penalty string, accuracy double, best boolean"), model


def tune_svm(df: DataFrame, features: str, label: str, keys: list[str], folds: int = 5,
             seed: int = SEED, size: int = 200, max_iter: int = 100):
    """Grid over C, gamma and kernel by cross-validated accuracy.

    A linear kernel has no gamma, so its cells are fitted once and listed for both gammas. All cells
    and folds take their steps together: one job per step.
    """
    kernels, at, inputs = [hinge.Kernel()], {("linear", g): 0 for g in GAMMAS}, 0
    for g in GAMMAS:
        fourier = _fourier(df, features, g, size, seed)
        inputs, at["rbf", g] = fourier.getOrDefault("inputs"), len(kernels)
        kernels.append(fourier.kernel())
    rows = df.count()
    train_rows = rows * (folds - 1) // folds
    placed = _placed(stratified_folds(df.select(*keys, features, label), folds, label, keys, seed), features, label,
                     inputs, rows, "fold")
    fitted = [(c, k) for c in C_GRID for k in range(len(kernels))]
    fits = [hinge.Fit(k, penalty_weight(c, train_rows), fold) for c, k in fitted for fold in range(folds)]
    weights = hinge.fit_all(placed, kernels, fits, inputs, folds, SVM_TOL, max_iter)
    right = hinge.held_out_accuracy(placed, kernels, fits, weights)
    scores = {cell: sum(right[i * folds:(i + 1) * folds]) / folds for i, cell in enumerate(fitted)}
    cells = [(c, g, kernel) for c in C_GRID for g in GAMMAS for kernel in KERNELS]
    accuracy = [scores[c, at[kernel, g]] for c, g, kernel in cells]
    best = max(range(len(cells)), key=lambda i: accuracy[i])
    c, g, kernel = cells[best]
    model = fit_svm(_vectors(placed, features, label), features, label, c, kernel, g, size, seed, max_iter)
    rows = [(*cell, s, i == best) for i, (cell, s) in enumerate(zip(cells, accuracy))]
    return df.sparkSession.createDataFrame(
        rows, "c double, gamma string, kernel string, accuracy double, best boolean"), model


def fit_baselines(train: DataFrame, features: str, label: str, seed: int = SEED) -> dict[str, PipelineModel]:
    """The three models of the baseline comparison."""
    return {"linear": fit_linear(train, features, label),
            "logistic": fit_logistic(train, features, label),
            "svm": fit_svm(train, features, label, seed=seed)}
