"""Feature table to trained, tuned and compared models.

Each job reads one stage, writes the next and returns its report tables, lazily.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohorta.config import (
    LABEL, LOG_ENGINEERED, LOG_SCALED, MODEL_FEATURES, NUMERIC, SCALED_FEATURES, SEED, STAY_KEYS,
    VIF_FEATURES,
)
from cohorta.functions import log1p_columns
from cohorta.operators import cleaning, evaluation as ev, exploration as ex, modelling as ml
from cohorta.operators import profiling as prof, sampling
from cohorta.plans.stages import Stages
from cohorta.sources.tables import load_predictions, write_csv

ROW = "row_id"


def clean(stages: Stages, rows: int | None = None, seed: int = SEED,
          exact: bool = True, reports: bool = True) -> dict[str, DataFrame]:
    """Up-sample to ``rows`` (None keeps the table; fewer rows than it has are refused), impute,
    profile, cap outliers. A row's id is a hash of its keys and its copy."""
    df = stages.read("features")
    if rows is not None:
        df = sampling.upsample_rows(df, rows, STAY_KEYS, seed)
    else:
        df = df.withColumn("copy_no", F.lit(0))
    keys = [*STAY_KEYS, "copy_no"]
    stages.write(df.withColumn(ROW, F.xxhash64(*keys)), "drawn")
    df = stages.read("drawn")
    kinds = prof.column_kinds(df, ids=[*keys, ROW, LABEL])
    numeric = [c for c, k in kinds.items() if k == "numeric"]
    text = [c for c, k in kinds.items() if k == "categorical"]
    steps = [cleaning.mean_imputer(df, numeric), cleaning.mode_imputer(df, text)]
    for step in steps:
        df = step.transform(df)
    stages.write(df, "imputed")
    imputed = stages.read("imputed")
    summary = ex.summarise(imputed, numeric)
    quartiles = {c: (q[0], q[2]) for c, q in summary.quartiles.items()} if exact else None
    capped = cleaning.iqr_capper(imputed, [c for c in numeric if c in summary.ranges],
                                 quartiles=quartiles).transform(imputed)
    stages.write(capped, "capped")
    if not reports:
        return {}
    varying = [c for c in numeric if c in summary.ranges and summary.ranges[c]["std"]]
    return {
        "histogram": ex.histogram(imputed, numeric, summary),
        "density": ex.density(imputed, numeric, summary=summary),
        "boxplots": ex.boxplot_stats(imputed, numeric, summary),
        "correlation": prof.correlation_matrix(imputed, numeric),
        "pairs": ex.pair_density(imputed, numeric, summary), "vif": prof.vif(imputed, varying),
        "skewness": prof.skewness_population(imputed, numeric)}


def engineer(stages: Stages, reports: bool = True) -> dict[str, DataFrame]:
    """Log twins of the skewed columns; correlation, skewness and VIF of the result."""
    df = log1p_columns(stages.read("capped"), LOG_ENGINEERED)
    stages.write(df, "engineered")
    if not reports:
        return {}
    df = stages.read("engineered")
    complete = df.select(*VIF_FEATURES).na.drop()
    varying = [r["column"] for r in prof.column_profile(complete, VIF_FEATURES).collect() if r["std"]]
    summary = ex.summarise(df, NUMERIC)
    return {
        "histogram": ex.histogram(df, NUMERIC, summary),
        "density": ex.density(df, NUMERIC, summary=summary),
        "boxplots": ex.boxplot_stats(df, NUMERIC, summary),
        "correlation": prof.correlation_matrix(df, NUMERIC),
        "pairs": ex.pair_density(df, ["log_max_vitals", "max_labs", "mean_labs"]),
        "skewness": prof.skewness_sample(df, NUMERIC), "vif": prof.vif(df, varying)}


def scale(stages: Stages, target: str = "log_los") -> float:
    """Logs, zero fill, assembly and scaling; returns R2 of ``target`` on the other features."""
    df = log1p_columns(stages.read("engineered"), LOG_SCALED)
    df = cleaning.zero_filler(SCALED_FEATURES).transform(df)
    model = cleaning.fit_scaling(df, SCALED_FEATURES)
    ml.save_model(model, stages.path("scaling_model"))
    stages.write(model.transform(df), "scaled")
    scaled = stages.read("scaled")
    cleaning.check_vectors(scaled, "scaled_features")
    rest = [c for c in SCALED_FEATURES if c != target]
    fit = cleaning.fit_scaling(scaled, rest, "rest_scaled").transform(scaled)
    return ml.regression_summary(fit, "rest_scaled", target)[2]


def train(stages: Stages, test_share: float = 0.3, seed: int = SEED, resample_first: bool = False,
          features: list[str] = MODEL_FEATURES) -> DataFrame:
    """Split, SMOTE, fit, store, score; returns the classification report of the test part.

    Only the train part is resampled, so no synthetic row is related to a test row.
    ``resample_first`` resamples the whole table before the split instead.
    """
    rows = (stages.read("scaled").filter(F.col(LABEL).isNotNull())
            .select(ROW, *[F.col(c).cast("double").alias(c) for c in features], LABEL))
    if resample_first:
        balanced = sampling.smote(rows, features, LABEL, ROW, seed=seed)
        stages.write(balanced.withColumn("_n", F.coalesce(ROW, -1 - F.xxhash64(*features))), "balanced")
        train_part, test_part = sampling.split_train_test(stages.read("balanced"), test_share, ["_n"], seed)
    else:
        train_part, test_part = sampling.split_train_test(rows, test_share, [ROW], seed)
        stages.write(sampling.smote(train_part, features, LABEL, ROW, seed=seed), "balanced")
        train_part = stages.read("balanced")
    fit_rows = cleaning.assembler(features).transform(train_part).select("features", LABEL)
    model = ml.fit_logistic(fit_rows, "features", LABEL)
    full = Pipeline(stages=[cleaning.assembler(features), *model.stages]).fit(train_part)
    ml.save_model(full, stages.path("logistic_model"))
    stages.write(test_part, "held_out")
    write_csv(ml.score_rows(full, stages.read("held_out"), LABEL), stages.path("predictions"))
    return ev.classification_report(load_predictions(stages.spark, stages.path("predictions")))


def _parts(stages: Stages, test_share: float, seed: int, features: list[str]) -> tuple[DataFrame, DataFrame]:
    rows = cleaning.assembler(features).transform(
        stages.read("scaled").filter(F.col(LABEL).isNotNull())
        .select(ROW, *[F.col(c).cast("double").alias(c) for c in features], LABEL))
    return sampling.split_train_test(rows.select(ROW, LABEL, "features"), test_share, [ROW], seed)


def report(stages: Stages, test_share: float = 0.2, seed: int = SEED,
           features: list[str] = MODEL_FEATURES) -> dict[str, DataFrame]:
    """Metrics of the stored predictions and the comparison of three baseline models."""
    predictions = load_predictions(stages.spark, stages.path("predictions"))
    train_part, test_part = _parts(stages, test_share, seed, features)
    models = ml.fit_baselines(train_part, "features", LABEL, seed)
    stages.write(ml.score_models(models, test_part, LABEL, [ROW]), "baseline_scores")
    scored = stages.read("baseline_scores")
    return {
        "metrics": ev.binary_metrics(predictions), "report": ev.classification_report(predictions),
        "baselines": ev.compare_models(scored, score="probability"),
        "roc": ev.roc_curve(scored, groups=["model"], drop_intermediate=True)}


def tune(stages: Stages, test_share: float = 0.3, seed: int = SEED,
         features: list[str] = MODEL_FEATURES) -> dict[str, DataFrame]:
    """Grid searches, stored best models, and their metrics and ROC on the test part."""
    train_part, test_part = _parts(stages, test_share, seed, features)
    logistic_cells, logistic = ml.tune_logistic(train_part, "features", LABEL, [ROW], seed=seed)
    svm_cells, svm = ml.tune_svm(train_part, "features", LABEL, [ROW], seed=seed)
    models = {"logistic": logistic, "svm": svm, "linear": ml.fit_linear(train_part, "features", LABEL)}
    ml.save_models(models, stages.path("tuned"))
    stages.write(test_part, "tuning_test")
    stages.write(ml.score_models(models, stages.read("tuning_test"), LABEL, [ROW]), "tuned_scores")
    scored = stages.read("tuned_scores")
    return {
        "logistic_grid": logistic_cells, "svm_grid": svm_cells,
        "report": ev.classification_report(scored, groups=["model"]),
        "roc": ev.roc_curve(scored, groups=["model"], drop_intermediate=True),
        "auc": ev.auc(scored, groups=["model"])}


def compare(stages: Stages, names: tuple[str, ...] = ("logistic", "svm", "linear")) -> DataFrame:
    """Load the tuned models, score the held-out rows, one line of metrics per model."""
    models = ml.load_models(stages.path("tuned"), list(names))
    scored = ml.score_models(models, stages.read("tuning_test"), LABEL, [ROW])
    stages.write(scored, "compared_scores")
    return ev.compare_models(stages.read("compared_scores"), score="probability")
