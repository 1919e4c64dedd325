"""Metrics against the Spark evaluators, fits against their optimum, models after a reload."""

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from cohorta.operators import cleaning, evaluation as ev, hinge, modelling as ml, newton
from cohorta.operators.certificate import linear_gap
from cohorta.operators.kernel import FourierFeatures


def scored(spark, rows):
    return spark.createDataFrame(rows, "actual int, prediction int, probability double")


@pytest.fixture(scope="module")
def mixed(spark):
    rng = np.random.default_rng(1)
    score = rng.random(2000).round(2)
    actual = (rng.random(2000) < score).astype(int)
    return scored(spark, [(int(a), int(s > 0.6), float(s)) for a, s in zip(actual, score)])


@pytest.mark.parametrize("scores,area", [((0.1, 0.2, 0.8, 0.9), 1.0), ((0.9, 0.8, 0.2, 0.1), 0.0), ((0.5,) * 4, 0.5)])
def test_auc_corners(spark, scores, area):
    df = scored(spark, [(a, a, s) for a, s in zip((0, 0, 1, 1), scores)])
    assert ev.auc(df).first()["auc"] == area


def test_one_class_has_no_auc(spark):
    df = scored(spark, [(0, 0, 0.1), (0, 1, 0.7)])
    assert ev.auc(df).first()["auc"] is None
    assert {r["tpr"] for r in ev.roc_curve(df).collect()} == {None}
    assert tuple(ev.binary_metrics(df).first()) == (0.5, 0.0, 0.0, 0.0)


def test_auc_equals_rank_statistic_and_evaluator(mixed):
    area = ev.auc(mixed).first()["auc"]
    rows = mixed.collect()
    pos = [r["probability"] for r in rows if r["actual"]]
    neg = [r["probability"] for r in rows if not r["actual"]]
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    assert area == pytest.approx(wins / (len(pos) * len(neg)), abs=1e-12)
    flipped = mixed.withColumn("probability", -F.col("probability"))
    assert ev.auc(flipped).first()["auc"] == pytest.approx(1 - area)
    judge = BinaryClassificationEvaluator(labelCol="actual", rawPredictionCol="probability", numBins=0)
    assert judge.evaluate(mixed) == pytest.approx(area, abs=1e-12)


def test_roc_is_monotone_from_corner_to_corner(mixed):
    points = sorted(ev.roc_curve(mixed).collect(), key=lambda r: r["point_no"])
    xy = [(r["fpr"], r["tpr"]) for r in points]
    assert xy[0] == (0.0, 0.0) and xy[-1] == (1.0, 1.0)
    assert all(a[0] <= b[0] and a[1] <= b[1] for a, b in zip(xy, xy[1:]))
    assert [r["point_no"] for r in points] == list(range(len(points)))


def test_weighted_metrics_equal_the_evaluators(mixed):
    got = ev.weighted_metrics(mixed).first()
    df = mixed.select("actual", F.col("prediction").cast("double").alias("prediction"))
    for name, metric in (("accuracy", "accuracy"), ("precision", "weightedPrecision"),
                         ("recall", "weightedRecall"), ("f1", "f1")):
        judge = MulticlassClassificationEvaluator(labelCol="actual", metricName=metric)
        assert got[name] == pytest.approx(judge.evaluate(df))


def test_compare_roc_reads_the_same_grid(mixed):
    runs = mixed.withColumn("run", F.lit("a")).unionByName(
        mixed.withColumn("run", F.lit("b")).withColumn("probability", F.col("probability") ** 2))
    table = ev.compare_roc(runs, "run")
    assert table.count() == 202
    assert ev.roc_gap(table, "run", "a", "b").first()["gap"] == 0.0


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(800, 2)) * [1.0, 3.0] + [0.5, -1.0]
    y = (rng.random(800) < 1 / (1 + np.exp(-(x[:, 0] - 0.4 * x[:, 1])))).astype(int)
    df = spark.createDataFrame([(i, float(a), float(b), int(c)) for i, ((a, b), c) in enumerate(zip(x, y))],
                               "id long, a double, b double, y int")
    return x, y, cleaning.assembler(["a", "b"]).transform(df).cache()


@pytest.mark.parametrize("c", [0.01, 1.0])
def test_logistic_reaches_the_penalised_optimum(cloud, c):
    x, y, df = cloud
    lr = ml.fit_logistic(df, "features", "y", c=c, tol=1e-12).stages[0]
    w, b = np.array(lr.coefficients), lr.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.abs(c * x.T @ (p - y) + w).max() < 1e-3
    assert abs((p - y).sum()) < 1e-3


def test_linear_fit_is_least_squares(cloud):
    x, y, df = cloud
    coefficients, intercept, r2 = ml.regression_summary(df, "features", "y")
    full = np.column_stack([x, np.ones(len(x))])
    best = np.linalg.lstsq(full, y, rcond=None)[0]
    assert [*coefficients, intercept] == pytest.approx(list(best))
    assert r2 == pytest.approx(1 - ((y - full @ best) ** 2).sum() / ((y - y.mean()) ** 2).sum())


def test_models_survive_a_reload(cloud, tmp_path):
    _, _, df = cloud
    models = ml.fit_baselines(df, "features", "y")
    ml.save_models(models, str(tmp_path))
    again = ml.load_models(str(tmp_path), list(models))
    for name in models:
        assert ml.score_rows(again[name], df, "y", ["id"]).orderBy("id").collect() == \
            ml.score_rows(models[name], df, "y", ["id"]).orderBy("id").collect()


def test_rbf_beats_linear_on_a_circle(spark):
    rng = np.random.default_rng(5)
    x = rng.uniform(-1.5, 1.5, size=(400, 2))
    df = spark.createDataFrame([(i, float(a), float(b), int(a * a + b * b < 1)) for i, (a, b) in enumerate(x)],
                               "id long, a double, b double, y int")
    df = cleaning.assembler(["a", "b"]).transform(df).cache()
    found = {kernel: ev.binary_metrics(ml.score_rows(ml.fit_svm(df, "features", "y", kernel=kernel), df, "y"))
             .first()["accuracy"] for kernel in ("rbf", "linear")}
    assert found["rbf"] > 0.93 > found["linear"]


def test_grids_list_all_cells(cloud, monkeypatch):
    monkeypatch.setattr(ml, "C_GRID", [0.1, 1.0])
    _, _, df = cloud
    cells, model = ml.tune_logistic(df, "features", "y", ["id"], folds=3, max_iter=50)
    got = cells.collect()
    assert [(r["c"], r["penalty"]) for r in got] == [(0.1, "l1"), (0.1, "l2"), (1.0, "l1"), (1.0, "l2")]
    assert sum(r["best"] for r in got) == 1 and all(0.5 < r["accuracy"] <= 1 for r in got)
    monkeypatch.setattr(ml, "C_GRID", [1.0])
    cells, model = ml.tune_svm(df, "features", "y", ["id"], folds=2, size=50, max_iter=15)
    got = {(r["gamma"], r["kernel"]): r["accuracy"] for r in cells.collect()}
    assert len(got) == 4 and got["scale", "linear"] == got["auto", "linear"]
    assert ml.score_rows(model, df, "y").count() == 800


def circle(spark, n=600):
    rng = np.random.default_rng(5)
    x = rng.uniform(-1.5, 1.5, size=(n, 2))
    rows = [(i, float(a), float(b), int(a * a + b * b < 1), i % 3) for i, (a, b) in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y int, fold int")
    return cleaning.assembler(["a", "b"]).transform(df).cache()


def test_machines_side_by_side_are_those_fitted_one_by_one(spark):
    df = circle(spark)
    fourier = FourierFeatures(inputCol="features", outputCol="f", gamma=0.7, inputs=2, size=30, seed=3)
    rows = hinge.training_rows(df, vector_to_array("features"), "y", 2, "fold").cache()
    fits = [hinge.Fit(k, p, fold) for k, p in ((0, 1e-1), (1, 1e-2)) for fold in (0, 2)]
    weights = hinge.fit_all(rows, [hinge.Kernel(), fourier.kernel()], fits, 2, folds=3)
    right = hinge.held_out_accuracy(rows, [hinge.Kernel(), fourier.kernel()], fits, weights)
    wide = fourier.transform(df).cache()
    for fit, found, share in zip(fits, weights, right):
        model = LinearSVC(featuresCol="f" if fit.kernel else "features", labelCol="y", maxIter=100, tol=1e-3,
                          standardization=False, regParam=fit.penalty).fit(wide.filter(F.col("fold") != fit.left_out))
        assert found == pytest.approx(np.append(model.coefficients.toArray(), model.intercept), rel=1e-6, abs=1e-8)
        held = model.transform(wide.filter(F.col("fold") == fit.left_out))
        assert share == held.agg(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0]


def test_copies_of_rows_are_read_as_one(spark, monkeypatch, tmp_path):
    rng = np.random.default_rng(9)
    x = rng.integers(0, 12, size=(900, 2)) / 4.0
    rows = [(i, float(a), float(b), int(a + 2 * b + rng.normal() > 4)) for i, (a, b) in enumerate(x)]
    df = cleaning.assembler(["a", "b"]).transform(spark.createDataFrame(rows, "id long, a double, b double, y int")).cache()
    read, sums = [], hinge._hinge_sums
    monkeypatch.setattr(hinge, "_hinge_sums", lambda rows, *more: (read.append(rows.count()), sums(rows, *more))[1])
    model = ml.fit_svm(df, "features", "y", kernel="linear", max_iter=20)
    assert read and set(read) == {len({r[1:] for r in rows})}
    svc = LinearSVC(featuresCol="features", labelCol="y", maxIter=20, tol=ml.SVM_TOL, standardization=False,
                    regParam=ml.penalty_weight(1.0, 900)).fit(df)
    found = model.stages[0]
    assert [*found.coefficients.toArray(), found.intercept] == pytest.approx([*svc.coefficients.toArray(), svc.intercept], rel=1e-6)
    ml.save_model(model, str(tmp_path / "m"))
    one, two = (ml.score_rows(m, df, "y", ["id"]).orderBy("id").collect() for m in (model, ml.load_model(str(tmp_path / "m"))))
    assert one == two
    plain = {r["id"]: r["prediction"] for r in svc.transform(df).select("id", "prediction").collect()}
    assert {r["id"]: r["prediction"] for r in one} == plain


def test_more_cells_and_folds_read_the_rows_no_more_often(spark, monkeypatch):
    df, passes, stored = circle(spark), [], []
    sums, keep = hinge._hinge_sums, ml.materialise
    monkeypatch.setattr(hinge, "_hinge_sums", lambda rows, kernels, inputs, fits, w: (
        passes.append(len(fits)), sums(rows, kernels, inputs, fits, w))[1])
    monkeypatch.setattr(ml, "materialise", lambda d: (stored.append(d.columns), keep(d))[1])
    monkeypatch.setattr(ml, "C_GRID", [0.1, 10.0])
    ml.tune_svm(df, "features", "y", ["id"], folds=3, size=20, max_iter=4)
    # Two C, three folds, three kernels; a step tries some lengths, and the last fit is one more.
    assert max(passes) == 18 and len(passes) < 18 * 4
    assert all(c == ["x", "y", "fold"] for c in stored)


def test_a_stored_machine_scores_alike(spark, tmp_path):
    df = circle(spark, 200)
    model = ml.fit_svm(df, "features", "y", size=20, max_iter=5)
    ml.save_model(model, str(tmp_path / "m"))
    one, two = (ml.score_rows(m, df, "y", ["id"]).orderBy("id").collect()
                for m in (model, ml.load_model(str(tmp_path / "m"))))
    assert one == two and {r["prediction"] for r in one} == {0, 1}


@pytest.mark.parametrize("label,x", [(2, 0.5), (None, 0.5), (1, float("nan")), (1, None)])
def test_a_machine_refuses_what_is_no_label_or_number(spark, label, x):
    df = spark.createDataFrame([([0.1], 0), ([0.7], 1), ([x], label)], "x array<double>, y int")
    with pytest.raises(Exception, match="not 0 or 1 or a feature"):
        hinge.training_rows(df, F.col("x"), "y", 1).collect()


def weighted_rows(seed=8, n=1500):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)) * [1, 2, 0.5], 1)
    y = (rng.random(n) < 1 / (1 + np.exp(-(x @ [1.5, -0.6, 0.0] + 0.4)))).astype(int)
    return [(i, [float(v) for v in a], int(b), i % 3) for i, (a, b) in enumerate(zip(x, y))]


def test_newton_reaches_the_optimum_of_every_fit(spark, monkeypatch):
    data = weighted_rows()
    df = spark.createDataFrame(data, "id long, x array<double>, y int, fold int").repartition(3)
    rows = newton.collapse(df, F.col("x"), "y", "fold")
    assert rows.count() < len(data) and rows.agg(F.sum("n")).first()[0] == len(data)
    fits = [newton.Fit(c, p, f) for c in (0.01, 1.0) for p in ("l1", "l2", None) for f in (newton.NO_FOLD, 0, 2)]
    passes, sums = [], newton.loss_sums
    monkeypatch.setattr(newton, "loss_sums", lambda *a: passes.append(1) or sums(*a))
    found = newton.fit_all(rows, fits, 3)
    assert len(passes) < 40  # one job per step for all 18 fits
    x, y, fold = (np.array([r[k] for r in data], float) for k in (1, 2, 3))
    full = np.column_stack([x, np.ones(len(x))])
    for fit, w in zip(fits, found):
        kept = fold != fit.left_out
        slope = full[kept].T @ (1 / (1 + np.exp(-full[kept] @ w)) - y[kept])
        if fit.penalty == "l2":
            slope[:3] += w[:3] / fit.c
        if fit.penalty == "l1":
            zero = w[:3] == 0
            assert (np.abs(slope[:3][zero]) <= 1 / fit.c + 1e-4).all()
            slope[:3] = np.where(zero, 0, slope[:3] + np.sign(w[:3]) / fit.c)
        assert np.abs(slope).max() < 1e-3
    accuracy = newton.held_out_accuracy(rows, fits, found)
    for fit, w, a in zip(fits, found, accuracy):
        held = fold == fit.left_out
        assert a == (None if not held.any() else pytest.approx(((full[held] @ w > 0) == (y[held] == 1)).mean()))


def test_newton_equals_single_fits(spark):
    df = spark.createDataFrame(weighted_rows(), "id long, x array<double>, y int, fold int")
    rows = newton.collapse(df, F.col("x"), "y")
    vectors = df.withColumn("features", array_to_vector("x"))
    fits = [newton.Fit(c, p) for c in (0.1, 1.0) for p in ("l1", "l2")]
    for fit, w in zip(fits, newton.fit_all(rows, fits, 3)):
        model = ml.fit_logistic(vectors, "features", "y", fit.c, fit.penalty).stages[-1]
        assert np.abs(model.coefficients.toArray() - w[:3]).max() < 2e-3 and abs(model.intercept - w[3]) < 2e-3


def test_newton_refuses_missing_values_and_takes_no_rows(spark):
    for bad in ([1.0, None], [1.0, float("nan")], None):
        df = spark.createDataFrame([([0.0, 1.0], 1), (bad, 0)], "x array<double>, y int")
        with pytest.raises(Exception, match="missing or not finite"):
            newton.collapse(df, F.col("x"), "y").collect()
    none = newton.collapse(spark.createDataFrame([], "x array<double>, y int"), F.col("x"), "y")
    assert np.allclose(newton.fit_all(none, [newton.Fit()], 2)[0], 0)
    assert newton.held_out_accuracy(none, [newton.Fit(left_out=1)], [np.zeros(3)]) == [None]


def test_the_gap_of_a_linear_fit_holds(spark):
    data = weighted_rows(n=600)
    df = spark.createDataFrame(data, "id long, x array<double>, y int, fold int").repartition(3)
    rows = newton.collapse(df, F.col("x"), "y")
    x, sign = np.array([r[1] for r in data]), np.array([2.0 * r[2] - 1 for r in data])

    def loss(w, b):
        return 0.5 * w @ w + np.maximum(0, 1 - sign * (x @ w + b)).sum()

    svc = ml.fit_svm(df.withColumn("features", array_to_vector("x")), "features", "y", kernel="linear").stages[0]
    w, b = svc.coefficients.toArray(), svc.intercept
    gap = linear_gap(rows, w, b)
    assert gap.primal == pytest.approx(loss(w, b)) and 0 < gap.dual <= gap.primal and gap.share < 0.05
    rng = np.random.default_rng(1)
    for _ in range(200):  # nothing is below the bound
        assert loss(w + rng.normal(size=3) * 0.1, b + rng.normal() * 0.1) >= gap.dual
    poor = linear_gap(rows, np.zeros(3), 0.0)
    assert poor.primal == pytest.approx(600) and poor.dual <= gap.primal and poor.share > gap.share
    none = linear_gap(rows.limit(0), np.zeros(3), 0.0)
    assert none.primal == none.dual == none.share == 0
