"""Profiles, samples, preparation, fitting and scoring of new rows."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohorta.config import (
    CATEGORICAL, CONTINUOUS, COUNTS, LABEL, NUMERIC, SAMPLED_ROWS, SEED, STAY_KEYS,
)
from cohorta.operators import cleaning, evaluation as ev, exploration as ex, modelling as ml
from cohorta.operators import profiling as prof, relational as rel, sampling
from cohorta.plans.stages import Stages
from cohorta.sources.tables import read_roc, write_roc


def _continuous(classes: DataFrame) -> list[str]:
    return sorted(r["column"] for r in classes.filter(F.col("kind") == "continuous").collect())


def profile(stages: Stages, rows: int = SAMPLED_ROWS, seed: int = SEED,
            categorical: list[str] = CATEGORICAL) -> dict[str, DataFrame]:
    """Profile the feature table and write a table of synthetic rows like it."""
    df = stages.read("features")
    classes = prof.cardinality_classes(df, STAY_KEYS, categorical)
    columns = _continuous(classes)
    summary = ex.summarise(df, columns)
    stages.write(sampling.synthesise(df, rows, LABEL, seed), "synthetic")
    return {
        "nulls": prof.null_counts(df), "classes": classes,
        "histogram": ex.histogram(df, columns, summary),
        "density": ex.density(df, columns, summary=summary),
        "boxplots": ex.boxplot_stats(df, columns, summary), "counts": rel.value_counts(df, categorical),
        "correlation": prof.correlation_matrix(df, columns), "kpis": rel.kpi_by_label(df)}


def sample(stages: Stages, rows: int = SAMPLED_ROWS, seed: int = SEED,
           categorical: list[str] = CATEGORICAL) -> dict[str, DataFrame]:
    """Draw ``rows`` rows of the feature table, store and profile them."""
    df = stages.read("features")
    classes = prof.cardinality_classes(df, STAY_KEYS, categorical)
    stages.write(sampling.sample_rows(df, rows, STAY_KEYS, seed), "sampled")
    drawn = stages.read("sampled")
    columns = _continuous(classes)
    summary = ex.summarise(drawn, columns)
    return {"classes": classes, "histogram": ex.histogram(drawn, columns, summary),
            "density": ex.density(drawn, columns, summary=summary), "counts": rel.value_counts(drawn, categorical)}


def prepare(stages: Stages, source: str = "sampled", fit: bool = True, fit_on: str = "features") -> int:
    """Impute, assemble and scale ``source``; ``fit=False`` applies the stored steps.

    Means, modes and scaling are fitted on the whole of ``fit_on``, not on the sample.
    """
    df = stages.read(source)
    path = stages.path("preparation_model")
    if fit:
        whole = stages.read(fit_on)
        means = cleaning.mean_imputer_nan(whole, CONTINUOUS)
        modes = cleaning.mode_imputer(whole, COUNTS)
        filled = modes.transform(means.transform(whole))
        scaling = cleaning.fit_scaling(filled, NUMERIC, on_invalid="keep")
        ml.save_model(PipelineModel([means, modes, *scaling.stages]), path)
    return stages.write(ml.load_model(path).transform(df), f"{source}_prepared")


def fit(stages: Stages, source: str = "sampled_prepared") -> dict[str, DataFrame]:
    """Check, fit, store the model and the training ROC; returns class sizes and AUC."""
    df = stages.read(source)
    cleaning.check_vectors(df, "scaled_features")
    model = ml.fit_plain_logistic(df, "scaled_features", LABEL)
    ml.save_model(model, stages.path("inference_model"))
    stages.write(ml.score_rows(model, df, LABEL, STAY_KEYS), "training_scores")
    scored = stages.read("training_scores")
    write_roc(ev.roc_curve(scored.withColumn("run", F.lit("training")), groups=["run"], drop_intermediate=True),
              stages.path("training_roc"))
    return {"classes": rel.category_counts(df, LABEL), "auc": ev.auc(scored)}


def infer(stages: Stages, source: str = "features") -> dict[str, DataFrame]:
    """Score rows with the stored steps and model; metrics and ROC next to the training ROC."""
    prepare(stages, source, fit=False)
    model = ml.load_model(stages.path("inference_model"))
    stages.write(ml.score_rows(model, stages.read(f"{source}_prepared"), LABEL, STAY_KEYS), "inference_scores")
    scored = stages.read("inference_scores")
    curves = read_roc(stages.spark, stages.path("training_roc")).unionByName(
        ev.roc_curve(scored.withColumn("run", F.lit("inference")), groups=["run"], drop_intermediate=True))
    both = scored.withColumn("run", F.lit("inference")).unionByName(
        stages.read("training_scores").withColumn("run", F.lit("training")))
    compared = ev.compare_roc(both, "run")
    return {
        "metrics": ev.weighted_metrics(scored), "roc": curves, "auc": ev.auc(both, groups=["run"]),
        "compared": compared, "gap": ev.roc_gap(compared, "run", "training", "inference")}
