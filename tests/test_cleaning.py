"""NULL, NaN and edge rules of profiles and cleaning steps."""

import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohorta.functions import age_years, log1p_columns, threshold_score
from cohorta.operators import cleaning, profiling as prof, relational as rel
from cohorta.operators.ranking import exact_quantiles

NAN = float("nan")


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def holes(spark):
    return frame(spark, [(1.0, 1), (NAN, 2), (None, None)], "x double, y long")


def values(df, col):
    return [r[col] for r in df.select(col).collect()]


def test_mean_imputer_keeps_nan_and_fills_null(spark):
    df = frame(spark, [(1.0,), (3.0,), (None,)], "x double")
    assert sorted(values(cleaning.mean_imputer(df, ["x"]).transform(df), "x")) == [1.0, 2.0, 3.0]


def test_mean_imputer_of_nan_column_spreads_nan(holes):
    filled = values(cleaning.mean_imputer(holes, ["x"]).transform(holes), "x")
    assert sum(math.isnan(v) for v in filled) == 2


def test_nan_imputer_replaces_both(holes):
    assert values(cleaning.mean_imputer_nan(holes, ["x"]).transform(holes), "x") == [1.0, 1.0, 1.0]


def test_zero_filler_keeps_nan(holes):
    filled = values(cleaning.zero_filler(["x"]).transform(holes), "x")
    assert filled[0] == 1.0 and math.isnan(filled[1]) and filled[2] == 0.0


def test_all_null_columns(spark):
    df = frame(spark, [(None, None), (None, None)], "x double, s string")
    assert values(cleaning.mean_imputer(df, ["x"]).transform(df), "x") == [None, None]
    assert values(cleaning.mode_imputer(df, ["s"]).transform(df), "s") == ["Unknown", "Unknown"]
    assert exact_quantiles(df, ["x"], [0.5]) == {"x": [None]}
    assert values(cleaning.iqr_capper(df, ["x"], exact=True).transform(df), "x") == [None, None]
    assert values(cleaning.iqr_capper(df, ["x"]).transform(df), "x") == [None, None]


def test_mode_ignores_null_and_breaks_ties_downwards(spark):
    df = frame(spark, [("a",), ("b",), (None,), (None,), (None,)], "s string")
    assert prof.column_mode(df, ["s"]).first()["value"] == "a"
    numbers = frame(spark, [(10,), (9,), (None,)], "k long")
    assert prof.column_mode(numbers, ["k"]).first()["value"] == "9"
    assert sorted(values(cleaning.mode_imputer(numbers, ["k"]).transform(numbers), "k")) == [9, 9, 10]


def test_mode_with_quotes(spark):
    df = frame(spark, [("it's \\ it",), ("it's \\ it",), (None,)], "s string")
    assert set(values(cleaning.mode_imputer(df, ["s"]).transform(df), "s")) == {"it's \\ it"}


def test_distinct_counts_null_as_a_value(holes):
    assert {r["column"]: r["distinct_values"] for r in prof.distinct_profile(holes, ["y"]).collect()} == {"y": 3}


def test_null_counts_tell_nan_from_null(holes):
    got = {r["column"]: (r["present"], r["nulls"], r["nans"]) for r in prof.null_counts(holes).collect()}
    assert got == {"x": (2, 1, 1), "y": (2, 1, 0)}


def test_skewness_values(spark):
    df = frame(spark, [(1.0, 5.0), (2.0, 5.0), (10.0, 5.0)], "x double, k double")
    g1 = {r["column"]: r["skew"] for r in prof.skewness_population(df, ["x", "k"]).collect()}
    big = {r["column"]: r["skew"] for r in prof.skewness_sample(df, ["x", "k"]).collect()}
    assert g1["x"] == pytest.approx(0.6745554845) and g1["k"] is None
    assert big["x"] == pytest.approx(1.6523167403) and big["k"] is None
    two = df.limit(2)
    assert prof.skewness_sample(two, ["x"]).first()["skew"] is None


def test_log_edges_and_idempotence(spark):
    df = frame(spark, [(-2.0,), (-1.0,), (0.0,), (NAN,)], "x double")
    once = log1p_columns(df, ["x"])
    got = values(once, "log_x")
    assert got[:3] == [None, None, 0.0] and math.isnan(got[3])
    assert log1p_columns(once, ["x"]).columns == once.columns
    piped = values(cleaning.log_adder(["x"]).transform(df), "log_x")
    assert piped[:3] == [None, None, 0.0]


def test_age_of_shifted_dates(spark):
    df = spark.sql("select timestamp '2101-10-20 19:08:00' a, timestamp '2025-04-11 00:00:00' b")
    assert df.select(age_years("a", "b")).first()[0] == 76.53


def test_drop_removes_all_columns_of_a_name(spark):
    a = frame(spark, [(1, 1, 7, "2020-01-01")], "row_id long, subject_id long, hadm_id long, t string")
    a = a.withColumn("admittime", F.to_timestamp("t")).drop("t")
    p = frame(spark, [(2, 1, "1990-01-01")], "row_id long, subject_id long, t string")
    p = p.withColumn("dob", F.to_timestamp("t")).drop("t")
    i = frame(spark, [(3, 1, 7, 5, 2.0)], "row_id long, subject_id long, hadm_id long, icustay_id long, los double")
    assert rel.merge_core(a, p, i).columns == [
        "subject_id", "hadm_id", "admittime", "dob", "icustay_id", "los", "age"]


def test_isin_never_matches_null(spark):
    df = frame(spark, [(1,), (None,)], "k long")
    assert rel.filter_isin(df, "k", [1, None]).count() == 1


def test_cast_double_strict_and_lenient(spark):
    df = frame(spark, [("1.5",), ("bad",)], "x string")
    assert values(rel.cast_double(df, ["x"], lenient=True), "x") == [1.5, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        rel.cast_double(df, ["x"]).collect()


def test_scaling_of_constant_dimension_and_saved_steps(spark, tmp_path):
    df = frame(spark, [(1.0, 5.0), (2.0, 5.0), (6.0, 5.0)], "x double, k double")
    model = cleaning.fit_scaling(df, ["x", "k"], "z")
    z = [r[0] for r in model.transform(df).select(vector_to_array("z")).collect()]
    assert [v[1] for v in z] == [0.0, 0.0, 0.0]
    assert sum(v[0] for v in z) == pytest.approx(0.0)
    assert sum(v[0] ** 2 for v in z) / 2 == pytest.approx(1.0)
    from pyspark.ml import PipelineModel
    capper = cleaning.iqr_capper(df, ["x"], exact=True)
    chain = PipelineModel([cleaning.mean_imputer(df, ["x"]), capper, model])
    chain.write().overwrite().save(str(tmp_path / "chain"))
    loaded = PipelineModel.load(str(tmp_path / "chain"))
    new = frame(spark, [(None, 5.0), (1000.0, 5.0)], "x double, k double")
    assert loaded.transform(new).collect() == chain.transform(new).collect()


def test_assembler_rules_and_gates(holes, spark):
    with pytest.raises(Exception):
        cleaning.assembler(["x"], "v").transform(holes).collect()
    kept = cleaning.assembler(["x"], "v", "keep").transform(holes)
    assert prof.nan_vector_count(kept, "v") == 2
    with pytest.raises(cleaning.QualityGateError, match="NaN"):
        cleaning.check_vectors(kept, "v")
    with pytest.raises(cleaning.QualityGateError, match="no rows"):
        cleaning.check_vectors(kept.limit(0), "v")


def test_capping_keeps_null_and_is_idempotent_under_fixed_fences(spark):
    df = frame(spark, [(float(i),) for i in range(20)] + [(500.0,), (-500.0,), (None,)], "x double")
    step = cleaning.iqr_capper(df, ["x"], exact=True)
    once = step.transform(df)
    assert values(step.transform(once), "x") == values(once, "x")
    assert values(once, "x")[-1] is None and max(v for v in values(once, "x") if v is not None) < 500


@pytest.mark.parametrize("n", [1, 2, 7, 10, 11, 100])
def test_exact_quantiles_against_numpy(spark, n):
    import numpy as np
    data = np.random.default_rng(n).normal(size=n).round(1)
    df = frame(spark, [(float(v),) for v in data] + [(None,), (NAN,)], "x double").repartition(3)
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.9, 1.0]
    assert exact_quantiles(df, ["x"], probs)["x"] == pytest.approx(list(np.quantile(data, probs)))


@pytest.mark.parametrize("accuracy", [50, 1000])
def test_exact_quantiles_with_a_coarse_sketch_and_a_hot_value(spark, accuracy):
    import numpy as np
    data = np.concatenate([np.random.default_rng(3).normal(size=20000), np.full(10000, 0.25)])
    df = spark.createDataFrame([(float(v),) for v in data], "x double").repartition(6)
    probs = [0.01, 0.25, 0.5, 0.6, 0.99]
    assert exact_quantiles(df, ["x"], probs, accuracy)["x"] == pytest.approx(list(np.quantile(data, probs)))


@pytest.mark.parametrize("size,n", [(4, 3000), (64, 20_000), (64, 50), (8, 1)])
def test_brackets_of_merged_sketches_hold_the_positions(spark, monkeypatch, size, n):
    import numpy as np
    from cohorta.operators import sketches
    monkeypatch.setattr(sketches, "MERGED_TOGETHER", 3)
    data = np.random.default_rng(n).normal(size=n).round(2)
    df = spark.createDataFrame([(float(v), None) for v in data], "x double, y double").repartition(11)
    merged = sketches.merge_sketches(sketches.sketch_columns(df, ["x", "y"], size))
    found = sketches.sketch_brackets(merged, [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]).collect()
    assert len(found) == 6 and {r["column"] for r in found} == {"x"} and {r["n"] for r in found} == {n}
    ordered = np.sort(data)
    for r in found:
        at = r["prob"] * (n - 1)
        assert r["low"] <= ordered[int(np.floor(at))] <= ordered[int(np.ceil(at))] <= r["high"]
    if size == 64:  # and they are narrow
        assert all(np.searchsorted(ordered, r["high"], "right") - np.searchsorted(ordered, r["low"]) < 0.3 * n + 60 for r in found)


def test_column_pickers(spark):
    df = frame(spark, [(i, i % 2, i % 5, float(i), "t") for i in range(40)],
               "subject_id long, flag int, grade int, x double, s string")
    kinds = {r["column"]: r["kind"] for r in prof.cardinality_classes(df, ["subject_id"], ["s"]).collect()}
    assert kinds == {"flag": "binary", "grade": "categorical_numeric", "x": "continuous", "s": "categorical"}
    assert prof.column_kinds(df, ["subject_id"], doubles_only=True) == {"x": "numeric", "s": "categorical"}
    assert prof.column_kinds(df, ["subject_id"])["flag"] == "numeric"


def test_vif_equals_regressions_and_is_infinite_for_a_sum(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 3))
    x[:, 2] += x[:, 0]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    got = {r["feature"]: r["vif"] for r in prof.vif(df, ["a", "b", "c"]).collect()}
    for i, c in enumerate("abc"):
        rest = np.column_stack([np.ones(300), np.delete(x, i, axis=1)])
        residual = x[:, i] - rest @ np.linalg.lstsq(rest, x[:, i], rcond=None)[0]
        r2 = 1 - residual.var() / x[:, i].var()
        assert got[c] == pytest.approx(1 / (1 - r2))
    dependent = df.withColumn("d", F.col("a") + F.col("b"))
    assert {r["vif"] for r in prof.vif(dependent, ["a", "b", "d"]).collect()} == {math.inf}


def test_correlation_of_a_constant_is_null(spark):
    df = frame(spark, [(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "x double, k double")
    got = {(r["x"], r["y"]): r["r"] for r in prof.correlation_matrix(df, ["x", "k"]).collect()}
    assert got == {("x", "x"): pytest.approx(1.0), ("x", "k"): None, ("k", "x"): None, ("k", "k"): None}


def test_threshold(spark):
    df = frame(spark, [(0.5,), (0.49,), (None,)], "s double")
    assert [r[0] for r in df.select(threshold_score("s")).collect()] == [1, 0, 0]


def test_inferred_and_explicit_csv(spark, tmp_path):
    from cohorta.sources import schemas, tables
    path = str(tmp_path / "DIAGNOSES_ICD.csv")
    df = frame(spark, [(1, 7, 2, "0042"), (1, 7, 3, None)], "ROW_ID long, SUBJECT_ID long, HADM_ID long, ICD9_CODE string")
    assert tables.write_csv(df, path) == 2
    read = tables.read_csv(spark, path, schemas.DIAGNOSES)
    assert read.columns == ["subject_id", "hadm_id", "icd9_code"]
    assert sorted(values(read, "icd9_code"), key=str) == ["0042", None]
    assert dict(tables.read_csv(spark, path).dtypes)["ICD9_CODE"] == "int"


def test_mode_fills_null_and_nan(spark):
    df = frame(spark, [(NAN,), (NAN,), (1.0,), (None,)], "x double")
    assert values(cleaning.mode_imputer(df, ["x"]).transform(df), "x") == [1.0] * 4


def csv_part(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


def test_csv_headers_are_checked(spark, tmp_path):
    from cohorta.sources.tables import read_csv
    from pyspark.sql.types import LongType, StructField, StructType
    schema = StructType([StructField(c, LongType()) for c in ("subject_id", "hadm_id")])
    csv_part(tmp_path / "a", "p0.csv", "HADM_ID,x,SUBJECT_ID\n7,z,1\n")
    assert [tuple(r) for r in read_csv(spark, str(tmp_path / "a"), schema).collect()] == [(1, 7)]
    csv_part(tmp_path / "a", "p1.csv", "SUBJECT_ID,x,HADM_ID\n2,z,8\n")
    with pytest.raises(Exception, match="CSV header"):
        read_csv(spark, str(tmp_path / "a"), schema).collect()
    csv_part(tmp_path / "b", "p0.csv", "subject_id,hadmid\n1,2\n")
    with pytest.raises(ValueError, match="hadm_id"):
        read_csv(spark, str(tmp_path / "b"), schema)
    assert [tuple(r) for r in read_csv(spark, str(tmp_path / "b"), schema, ("hadm_id",)).collect()] == [(1, None)]


def test_csv_text_survives(spark, tmp_path):
    from cohorta.sources.tables import read_csv, write_csv
    texts = ['a "quoted", text', "two\nlines", " blanks ", "", None, '"', "back\\slash", "cr\r\nlf", "x,"]
    df = frame(spark, list(enumerate(texts)), "i long, s string")
    assert write_csv(df, str(tmp_path / "t")) == len(texts)
    got = read_csv(spark, str(tmp_path / "t"), df.schema).orderBy("i")
    assert values(got, "s") == texts
