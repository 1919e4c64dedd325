"""Joins and grouped aggregates from raw tables to the feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohorta.config import ADMISSION_KEYS, LABEL, STAY_KEYS, TOP_LAB_ITEMS, VITAL_ITEMS
from cohorta.functions.scalar import age_years


def filter_isin(df: DataFrame, col: str, values: list) -> DataFrame:
    return df.filter(F.col(col).isin(*values))


def filter_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull())


def cast_double(df: DataFrame, cols: list[str], lenient: bool = False) -> DataFrame:
    """Cast columns to double; bad text raises, or becomes NULL if ``lenient``."""
    return df.withColumns({
        c: F.col(c).try_cast("double") if lenient else F.col(c).cast("double") for c in cols})


def drop_incomplete(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows with a NULL or NaN in any of the columns."""
    return df.na.drop(subset=cols)


def merge_core(admissions: DataFrame, patients: DataFrame, icustays: DataFrame) -> DataFrame:
    """Admissions with their patient and ICU stays, plus the age at admission.

    Plain joins: a patient or an admission with very many rows is split by adaptive execution.
    """
    admissions, patients, icustays = (t.drop("row_id") for t in (admissions, patients, icustays))
    visits = admissions.join(patients, "subject_id")
    core = icustays.join(visits, ADMISSION_KEYS)
    stay_columns = [c for c in icustays.columns if c not in ADMISSION_KEYS]
    rest = [c for c in visits.columns if c not in ADMISSION_KEYS]
    return (core.select(*ADMISSION_KEYS, *rest, *stay_columns)
            .withColumn("age", age_years("admittime", "dob")))


def _mean_min_max(suffix: str, value: str = "valuenum") -> list[Column]:
    return [F.mean(value).alias(f"mean_{suffix}"), F.min(value).alias(f"min_{suffix}"),
            F.max(value).alias(f"max_{suffix}")]


def vitals_by_stay(chartevents: DataFrame, items: list[int] = VITAL_ITEMS) -> DataFrame:
    return (filter_isin(chartevents, "itemid", items)
            .groupBy(*STAY_KEYS).agg(*_mean_min_max("vitals")))


def top_items(events: DataFrame, k: int = TOP_LAB_ITEMS, item: str = "itemid") -> DataFrame:
    """The k most frequent items; equal counts go to the smaller item."""
    return (events.groupBy(item).count()
            .orderBy(F.desc("count"), F.asc(item)).limit(k))


def keep_top_items(events: DataFrame, k: int = TOP_LAB_ITEMS, item: str = "itemid") -> DataFrame:
    """Rows of the k most frequent items. The broadcast side has at most k rows."""
    return events.join(F.broadcast(top_items(events, k, item).select(item)), item, "left_semi")


def labs_by_admission(labevents: DataFrame, k: int = TOP_LAB_ITEMS) -> DataFrame:
    return (keep_top_items(labevents, k)
            .groupBy(*ADMISSION_KEYS).agg(*_mean_min_max("labs")))


def code_lookup(diagnoses: DataFrame, codes: DataFrame) -> DataFrame:
    return diagnoses.join(codes, "icd9_code", "left")


def comorbidity_count(diagnoses: DataFrame) -> DataFrame:
    """Distinct codes per admission, NULL codes left out. A dictionary join adds no code."""
    return (diagnoses.groupBy(*ADMISSION_KEYS)
            .agg(F.count_distinct("icd9_code").alias("num_comorbidities")))


def merge_features(core: DataFrame, vitals: DataFrame, labs: DataFrame, comorbidities: DataFrame) -> DataFrame:
    """Left-join the aggregates to the core rows.

    Labs and comorbidities are put together first, one small row per admission, so the
    core rows are joined twice, not three times.
    """
    per_admission = labs.join(comorbidities, ADMISSION_KEYS, "full")
    joined = core.join(per_admission, ADMISSION_KEYS, "left").join(vitals, STAY_KEYS, "left")
    added = [c for side in (vitals, labs, comorbidities) for c in side.columns
             if c not in STAY_KEYS]
    return joined.select(*core.columns, *added)


def feature_table(admissions: DataFrame, patients: DataFrame, icustays: DataFrame,
                  chartevents: DataFrame, labevents: DataFrame, diagnoses: DataFrame,
                  vital_items: list[int] = VITAL_ITEMS, top_labs: int = TOP_LAB_ITEMS) -> DataFrame:
    """Raw tables to one row per ICU stay, as a single lazy plan."""
    return merge_features(
        merge_core(admissions, patients, icustays),
        vitals_by_stay(chartevents, vital_items),
        labs_by_admission(labevents, top_labs),
        comorbidity_count(diagnoses))


def category_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).count()


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value, count) of several columns in one job, NULL values included."""
    named = [c for c in cols if c in df.columns]
    return (df.select(*[F.col(c).cast("string").alias(c) for c in named])
            .unpivot([], named, "column", "value")
            .groupBy("column", "value").count()
            .orderBy("column", F.desc("count"), F.asc_nulls_last("value")))


def kpi_by_label(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.groupBy(label).agg(
        F.mean("age").alias("avg_age"), F.mean("los").alias("avg_los"),
        F.mean("mean_vitals").alias("avg_vitals"),
        F.mean("num_comorbidities").alias("avg_comorbidities"))


def replicate_rows(df: DataFrame, copies: int, copy_col: str = "copy_no") -> DataFrame:
    """Bag union of ``copies`` copies from one scan; copies are numbered from 0."""
    return df.withColumn(copy_col, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
