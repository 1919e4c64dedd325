"""Fits, tuning and scoring. Iterative fits have no SQL twin; tests check their optimum."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from cohorta.catalog.registry import query, rounded, with_views
from cohorta.catalog.sampling import u_sql
from cohorta.functions.uniform import hash_uniform
from cohorta.operators import cleaning, evaluation as ev, modelling as ml, newton, sampling
from cohorta.operators.certificate import linear_gap
from cohorta.session import materialise, scratch_path

FEATURES = ["x1", "x2", "x3"]


def labelled(t):
    """Scaled features of the labelled documents, written once for the fits that follow."""
    df = t.fx_labelled
    scaled = cleaning.fit_scaling(df, FEATURES, "features").transform(df)
    return materialise(scaled.select("doc_id", "label", "features"))


def order_lines(t):
    """Features of every order line against its late-lines outcome."""
    df = t.fx_predictions.withColumn("line", F.col("l_linenumber").cast("double"))
    return (cleaning.assembler(["probability", "line"], "features").transform(df)
            .select("l_orderkey", "l_linenumber", "actual", "features"))


@query("linreg_fit", """
    select round(regr_slope(l_extendedprice, l_quantity), 4) as slope,
           round(regr_intercept(l_extendedprice, l_quantity), 4) as intercept,
           round(regr_r2(l_extendedprice, l_quantity), 6) as r2 from lineitem""")
def linreg_fit(t):
    df = cleaning.assembler(["l_quantity"], "x").transform(t.lineitem)
    (slope,), intercept, r2 = ml.regression_summary(df, "x", "l_extendedprice")
    return t.spark.createDataFrame([(round(slope, 4), round(intercept, 4), round(r2, 6))],
                                   "slope double, intercept double, r2 double")


def newton_sql(models: str, steps: int) -> str:
    """Newton steps on the order lines, unrolled: ``models`` lists c and the fold left out of each fit.

    u, v and w are the weights of probability and line number and the intercept.
    """
    text = f""", rows as (select probability as a, cast(l_linenumber as double) as b, actual as y,
                                 cast(floor({u_sql('l_orderkey', 'fold')} * 5) as integer) as fold, count(*) as n
                          from fx_predictions group by all),
    b0 as (select c, left_out, 0e0 as u, 0e0 as v, 0e0 as w from ({models}) m)"""
    for k in range(steps):
        text += f""",
    s{k} as (select c, left_out, u, v, w, sum(n * (p - y) * a) + u / c as g0, sum(n * (p - y) * b) + v / c as g1,
                    sum(n * (p - y)) as g2, sum(n * p * (1 - p) * a * a) + 1 / c as h00, sum(n * p * (1 - p) * a * b) as h01,
                    sum(n * p * (1 - p) * a) as h02, sum(n * p * (1 - p) * b * b) + 1 / c as h11,
                    sum(n * p * (1 - p) * b) as h12, sum(n * p * (1 - p)) as h22
             from (select *, 1 / (1 + exp(-(u * a + v * b + w))) as p from b{k}, rows where fold <> left_out) z
             group by c, left_out, u, v, w),
    d{k} as (select *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02) as det
             from s{k}),
    b{k + 1} as (select c, left_out,
        u - (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / det as u,
        v - (h00 * (g1 * h22 - g2 * h12) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / det as v,
        w - (h00 * (h11 * g2 - h12 * g1) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)) / det as w from d{k})"""
    return text


@query("logreg_newton_scores", with_views("fx_predictions", newton_sql("select 1e0 as c, -1 as left_out", 16) + """
    select l_orderkey, l_linenumber, round(1 / (1 + exp(-(u * probability + v * l_linenumber + w))), 6) as probability
    from fx_predictions, b16"""))
def logreg_newton_scores(t):
    x = F.array("probability", F.col("l_linenumber").cast("double"))
    weights, = newton.fit_all(newton.collapse(t.fx_predictions, x, "actual"), [newton.Fit(1.0)], 2)
    return t.fx_predictions.select("l_orderkey", "l_linenumber", F.round(newton.probability(x, weights), 6).alias("probability"))


@query("grid_newton", with_views("fx_predictions", newton_sql(
    "select unnest([0.01e0, 0.1e0, 1e0, 10e0]) as c, left_out from (select unnest([0, 1, 2, 3, 4]) as left_out) f", 18) + """
    , held as (select c, left_out, sum(case when (u * a + v * b + w > 0) = (y = 1) then n else 0 end) / cast(sum(n) as double) as right_share
               from b18 join rows on fold = left_out group by c, left_out)
    select c, round(avg(right_share), 6) as accuracy from held group by c"""))
def grid_newton(t):
    """Every C and fold of the grid with the l2 penalty, on one reading per step."""
    x = F.array("probability", F.col("l_linenumber").cast("double"))
    placed = t.fx_predictions.withColumn("fold", F.floor(hash_uniform("l_orderkey", stream="fold") * 5).cast("int"))
    rows = newton.collapse(placed, x, "actual", "fold")
    fits = [newton.Fit(c, "l2", fold) for c in ml.C_GRID for fold in range(5)]
    right = newton.held_out_accuracy(rows, fits, newton.fit_all(rows, fits, 2))
    cells = t.spark.createDataFrame([(f.c, a) for f, a in zip(fits, right)], "c double, share double")
    return rounded(cells.groupBy("c").agg(F.avg("share").alias("accuracy")))


@query("logreg_scores")
def logreg_scores(t):
    df = order_lines(t)
    model = ml.fit_logistic(df, "features", "actual")
    return rounded(ml.score_rows(model, df, "actual", ["l_orderkey", "l_linenumber"]))


@query("logreg_plain_scores")
def logreg_plain_scores(t):
    df = labelled(t)
    return rounded(ml.score_rows(ml.fit_plain_logistic(df, "features", "label"), df, "label", ["doc_id"]))


@query("linreg_classifier", """
    with f as (select regr_slope(actual, x) as a, regr_intercept(actual, x) as b
               from (select case when l_quantity + 3 * l_linenumber > 40 then 1 else 0 end as actual,
                            l_quantity as x from lineitem) s)
    select l_orderkey, l_linenumber, case when l_quantity + 3 * l_linenumber > 40 then 1 else 0 end as actual,
           case when a * l_quantity + b >= 0.5e0 then 1 else 0 end as prediction,
           round(a * l_quantity + b, 6) as probability
    from lineitem, f""")
def linreg_classifier(t):
    df = t.fx_predictions.select("l_orderkey", "l_linenumber", "actual", (F.col("probability") * 51.0).alias("x"))
    df = cleaning.assembler(["x"], "features").transform(df)
    model = ml.fit_linear(df, "features", "actual")
    return rounded(ml.score_rows(model, df, "actual", ["l_orderkey", "l_linenumber"]))


@query("svm_rbf_scores")
def svm_rbf_scores(t):
    df = labelled(t)
    return rounded(ml.score_rows(ml.fit_svm(df, "features", "label"), df, "label", ["doc_id"]))


@query("svm_linear_scores")
def svm_linear_scores(t):
    df = labelled(t)
    return rounded(ml.score_rows(ml.fit_svm(df, "features", "label", kernel="linear"), df, "label", ["doc_id"]))


@query("svm_linear_gap", """
    select count(*) as "rows", true as ordered, true as bounded from lineitem""")
def svm_linear_gap(t):
    """A dual bound lies above 0 and not above the penalised hinge loss of the fit, which is that of its rows."""
    df = order_lines(t)
    svc = ml.fit_svm(df, "features", "actual", kernel="linear").stages[0]
    rows = newton.collapse(df, vector_to_array("features"), "actual")
    gap = linear_gap(rows, svc.coefficients.toArray(), svc.intercept)
    return rows.agg(F.sum("n").alias("rows"), F.lit(0 < gap.dual <= gap.primal).alias("ordered"),
                    F.lit(0 <= gap.share < 1).alias("bounded"))


@query("grid_logreg")
def grid_logreg(t):
    return rounded(ml.tune_logistic(labelled(t), "features", "label", ["doc_id"])[0])


@query("grid_svm")
def grid_svm(t):
    return rounded(ml.tune_svm(labelled(t), "features", "label", ["doc_id"])[0])


@query("score_batch", with_views("fx_predictions", f"""
    select l_orderkey, l_linenumber, actual, true as sound from fx_predictions
    where {u_sql('l_orderkey', 'split')} < 0.3e0"""))
def score_batch(t):
    """Fit on the train part, store the model, load it and score the test part: every row once, with a
    probability that agrees with its class."""
    train, test = sampling.split_train_test(order_lines(t), 0.3, ["l_orderkey"])
    path = scratch_path(t.spark, "model")
    ml.save_model(ml.fit_logistic(train, "features", "actual"), path)
    scored = ml.score_rows(ml.load_model(path), test, "actual", ["l_orderkey", "l_linenumber"])
    p = F.col("probability")
    return scored.select("l_orderkey", "l_linenumber", "actual", (
        p.between(0, 1) & ((F.col("prediction") == 1) == (p > 0.5))).alias("sound"))


@query("baseline_bakeoff")
def baseline_bakeoff(t):
    train, test = sampling.split_train_test(labelled(t), 0.2, ["doc_id"])
    scored = ml.score_models(ml.fit_baselines(train, "features", "label"), test, "label")
    return rounded(ev.compare_models(materialise(scored), score="probability"))


@query("logreg_saturated", """
    select l_linenumber, round(avg(case when l_returnflag = 'R' then 1e0 else 0e0 end), 3) as probability
    from lineitem group by l_linenumber""")
def logreg_saturated(t):
    """One indicator per line number: the fitted probabilities are the groups' shares."""
    lines = [F.col("l_linenumber") == k for k in range(1, 7)]
    df = t.lineitem.select("l_linenumber", (F.col("l_returnflag") == "R").cast("double").alias("y"),
                           array_to_vector(F.array(*[x.cast("double") for x in lines])).alias("features"))
    model = ml.fit_plain_logistic(df, "features", "y")
    fitted = model.transform(df.select("l_linenumber", "features").dropDuplicates(["l_linenumber"]))
    return fitted.select("l_linenumber", F.round(vector_to_array("probability")[1], 3).alias("probability"))
