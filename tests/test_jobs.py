"""The jobs run from raw tables to their reports and hand their tables on."""

import pytest
from pyspark.sql import functions as F

from cohorta.catalog.jobs import TEXT, built
from cohorta.catalog.registry import Tables
from cohorta.catalog.relational import VITALS, features
from cohorta.operators import modelling as ml, relational as rel
from cohorta.plans import inference, training
from cohorta.sources import tables


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    return built(Tables(spark, sf_dir))


def test_features_from_raw_csv_files(spark, sf_dir, tmp_path):
    """CSV files with upper-case headers and row ids give the same table as the views."""
    t = Tables(spark, sf_dir)
    files = {"ADMISSIONS": t.fx_admissions, "PATIENTS": t.fx_patients, "ICUSTAYS": t.fx_icustays,
             "CHARTEVENTS": t.fx_chartevents, "LABEVENTS": t.fx_labevents, "DIAGNOSES_ICD": t.fx_diagnoses,
             "D_ICD_DIAGNOSES": t.fx_codes, "D_ITEMS": t.fx_codes.select(F.lit(1).alias("itemid"))}
    for name, df in files.items():
        out = df.withColumn("row_id", F.monotonically_increasing_id())
        tables.write_csv(out.select([F.col(c).alias(c.upper()) for c in out.columns]), f"{tmp_path}/{name}.csv")
    raw = tables.load_core_tables(spark, str(tmp_path))
    events = tables.load_event_tables(spark, str(tmp_path))
    got = rel.feature_table(raw["admissions"], raw["patients"], raw["icustays"], events["chartevents"],
                            events["labevents"], events["diagnoses_icd"], VITALS)
    want = features(t)
    columns = ["subject_id", "hadm_id", "icustay_id", "age", "mean_vitals", "mean_labs", "num_comorbidities"]
    assert "row_id" not in got.columns
    assert got.select(columns).exceptAll(want.select(columns)).count() == 0
    assert got.count() == want.count()


def test_a_skewed_key_is_split(spark):
    """A patient with most of the admissions: the join's final plan splits that partition."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
                                          "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for key in list(old)[1:]:
        spark.conf.set(key, "64k")
    try:
        admissions = spark.range(60_000, numPartitions=8).select(
            F.when(F.col("id") % 5 > 0, 1).otherwise(F.col("id")).alias("subject_id"), F.col("id").alias("hadm_id"),
            F.lit("2020-01-01").cast("timestamp").alias("admittime"), F.md5(F.col("id").cast("string")).alias("diagnosis"))
        patients = spark.range(60_000).select(F.col("id").alias("subject_id"), F.lit("1950-01-01").cast("timestamp").alias("dob"))
        stays = admissions.select("subject_id", "hadm_id", F.col("hadm_id").alias("icustay_id"), F.lit(1.0).alias("los"))
        core = rel.merge_core(admissions, patients, stays)
        assert core.groupBy("subject_id").count().filter("subject_id = 1").first()["count"] == 48_000
        core.write.format("noop").mode("overwrite").save()
        visits = admissions.join(patients, "subject_id")
        visits.collect()
        assert "skew=true" in visits._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


def test_upsampling_never_cuts(stages):
    with pytest.raises(ValueError, match="fewer"):
        training.clean(stages, rows=100)


def test_training_chain(stages, monkeypatch):
    monkeypatch.setattr(ml, "C_GRID", [1.0])
    reports = training.clean(stages, rows=5000)
    assert stages.read("drawn").count() == 5000
    assert {f for f, _ in stages.read("capped").dtypes} >= {"row_id", "los", "age"}
    assert stages.read("imputed").filter(F.col("mean_vitals").isNull()).count() == 0
    for name, table in reports.items():
        assert table.count() > 0, name
    for name, table in training.engineer(stages).items():
        assert table.count() > 0, name
    assert 0 <= training.scale(stages) <= 1
    report = {r["row"]: r["support"] for r in training.train(stages).collect()}
    assert {"0", "1", "accuracy", "macro avg", "weighted avg"} == set(report)
    balanced = {r["hospital_expire_flag"]: r["count"]
                for r in stages.read("balanced").groupBy("hospital_expire_flag").count().collect()}
    assert len(set(balanced.values())) == 1
    tables = training.report(stages)
    assert tables["baselines"].count() == 3 and tables["roc"].count() > 3
    tuned = training.tune(stages)
    assert tuned["logistic_grid"].count() == 2 and tuned["svm_grid"].count() == 4
    assert tuned["auc"].count() == 3
    assert {r["model"] for r in training.compare(stages).collect()} == {"logistic", "svm", "linear"}
    training.train(stages, resample_first=True).collect()
    assert stages.read("held_out").filter("synthetic = 1").count() > 0


def test_inference_chain(stages):
    reports = inference.profile(stages, rows=500, categorical=TEXT)
    for name, table in reports.items():
        assert table.count() > 0, name
    synthetic = stages.read("synthetic")
    assert synthetic.count() == 500
    assert synthetic.agg(F.sum("hospital_expire_flag")).first()[0] == 250
    assert inference.sample(stages, categorical=TEXT)["counts"].count() > 0
    assert stages.read("sampled").count() == 2500
    assert inference.prepare(stages) == 2500
    found = inference.fit(stages)
    assert 0 < found["auc"].first()["auc"] < 1
    out = inference.infer(stages)
    assert out["metrics"].count() == 1 and out["gap"].count() == 1
    assert {r["run"] for r in out["roc"].select("run").distinct().collect()} == {"training", "inference"}
    assert {r["run"] for r in out["auc"].collect()} == {"training", "inference"}
