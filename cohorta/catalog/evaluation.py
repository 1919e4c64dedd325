"""Classification metrics, ROC and AUC."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cohorta.catalog.registry import query, rounded, with_views
from cohorta.functions.scalar import positive_probability
from cohorta.operators import evaluation as ev
from cohorta.operators.modelling import evaluator_auc
from cohorta.session import scratch_path
from cohorta.sources.tables import read_roc, write_roc

_RATIO = "coalesce({a} / nullif(cast({b} as double), 0), 0)"


def binary_sql(source: str, group: str = "") -> str:
    head = f"{group}, " if group else ""
    tail = f"group by {group}" if group else ""
    return f"""
        select {head}round(avg(case when actual = prediction then 1e0 else 0e0 end), 6) as accuracy,
               round({_RATIO.format(a="sum(actual * prediction)", b="sum(prediction)")}, 6) as "precision",
               round({_RATIO.format(a="sum(actual * prediction)", b="sum(actual)")}, 6) as recall,
               round({_RATIO.format(a="2 * sum(actual * prediction)", b="sum(actual) + sum(prediction)")}, 6) as f1
        from {source} {tail}"""


def roc_ctes(source: str, score: str, group: str | None = None) -> str:
    g = f"{group}, " if group else ""
    over = f"partition by {group} order by" if group else "order by"
    whole = f"over (partition by {group})" if group else "over ()"
    by = f"partition by {group}" if group else ""
    return f""", levels as (select {g}{score} as score, sum(actual) as pos, sum(1 - actual) as neg
                            from {source} group by {g}{score}),
    cum as (select *, sum(pos) over ({over} score desc) as tp, sum(neg) over ({over} score desc) as fp,
                   sum(pos) {whole} as p, sum(neg) {whole} as n,
                   row_number() over ({over} score desc) as point_no from levels),
    curve as (select {g}point_no, score as threshold, fp / cast(n as double) as fpr, tp / cast(p as double) as tpr from cum
              union all select distinct {g}cast(0 as bigint), cast('inf' as double), 0e0, 0e0 from cum),
    steps as (select {g}fpr - lag(fpr) over ({by} order by point_no) as dx,
                     tpr + lag(tpr) over ({by} order by point_no) as dy from curve)"""


@query("confusion_matrix", with_views("fx_predictions", """
    select actual, prediction, count(*) as n from fx_predictions group by actual, prediction"""))
def confusion_matrix(t):
    return ev.confusion_matrix(t.fx_predictions)


@query("binary_metrics", with_views("fx_predictions", binary_sql("fx_predictions")))
def binary_metrics(t):
    return rounded(ev.binary_metrics(t.fx_predictions))


_REPORT = """
    , classes as (
        select c as class, sum(case when actual = c then 1 else 0 end) as support,
               sum(case when prediction = c then 1 else 0 end) as chosen,
               sum(case when actual = c and prediction = c then 1 else 0 end) as hit
        from fx_predictions, (select unnest([0, 1]) as c) k group by c),
    m as (select class, support, hit / cast(chosen as double) as "precision", hit / cast(support as double) as recall,
                 2e0 * hit / (chosen + support) as f1 from classes),
    report as (
        select cast(class as varchar) as "row", "precision", recall, f1, support from m
        union all select 'accuracy', sum(recall * support) / sum(support), sum(recall * support) / sum(support),
                         sum(recall * support) / sum(support), sum(support) from m
        union all select 'macro avg', avg("precision"), avg(recall), avg(f1), sum(support) from m
        union all select 'weighted avg', sum("precision" * support) / sum(support),
                         sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) from m)"""


@query("classification_report", with_views("fx_predictions", f"""{_REPORT}
    select "row", round("precision", 6) as "precision", round(recall, 6) as recall, round(f1, 6) as f1,
           cast(support as bigint) as support from report"""))
def classification_report(t):
    return rounded(ev.classification_report(t.fx_predictions))


@query("weighted_metrics", with_views("fx_predictions", f"""{_REPORT}
    select round(recall, 6) as accuracy, round("precision", 6) as "precision", round(recall, 6) as recall,
           round(f1, 6) as f1 from report where "row" = 'weighted avg'"""))
def weighted_metrics(t):
    return rounded(ev.weighted_metrics(t.fx_predictions))


_POINTS = """select {g}cast(point_no as bigint) as point_no, case when point_no = 0 then null else round(threshold, 6) end as threshold,
    round(fpr, 6) as fpr, round(tpr, 6) as tpr from curve"""


def finite(curve):
    """Show the open threshold of the first point as NULL."""
    return rounded(curve.withColumn("threshold", F.when(F.col("point_no") > 0, F.col("threshold"))))


@query("roc_curve", with_views("fx_predictions", roc_ctes("fx_predictions", "probability")
                               + _POINTS.format(g="")))
def roc_curve(t):
    return finite(ev.roc_curve(t.fx_predictions))


_CORNERS = """
    , moves as (select {g}score, point_no, pos, neg, lead(pos) over ({over} point_no) as next_pos,
                       lead(neg) over ({over} point_no) as next_neg from cum),
    corners as (select c.* from curve c left join moves m on m.point_no = c.point_no {on}
                where c.point_no <= 1 or m.next_pos is null or m.next_pos <> m.pos or m.next_neg <> m.neg)"""


@query("roc_curve_corners", with_views("fx_models", roc_ctes("fx_models", "score", "model") + _CORNERS.format(
    g="model, ", over="partition by model order by", on="and m.model = c.model") + _POINTS.format(g="model, ")
    .replace("from curve", "from corners")))
def roc_curve_corners(t):
    return finite(ev.roc_curve(t.fx_models, score="score", groups=["model"], drop_intermediate=True))


@query("roc_overlay", with_views("fx_models", roc_ctes("fx_models", "score", "model")
                                 + _POINTS.format(g="model, ")))
def roc_overlay(t):
    return finite(ev.roc_curve(t.fx_models, score="score", groups=["model"]))


@query("roc_artefact", with_views("fx_models", roc_ctes("fx_models", "score", "model")
                                  + _POINTS.format(g="model as run, ")))
def roc_artefact(t):
    path = scratch_path(t.spark, "roc")
    write_roc(ev.roc_curve(t.fx_models.withColumnRenamed("model", "run"), score="score", groups=["run"]), path)
    return finite(read_roc(t.spark, path))


@query("auc_exact", with_views("fx_predictions", roc_ctes("fx_predictions", "probability") + """
    select round(sum(dx * dy) / 2, 6) as auc from steps"""))
def auc_exact(t):
    return rounded(ev.auc(t.fx_predictions))


@query("auc_evaluator", with_views("fx_predictions", roc_ctes("fx_predictions", "probability") + """
    select round(sum(dx * dy) / 2, 6) as auc from steps"""))
def auc_evaluator(t):
    """The same area by Spark's evaluator."""
    scores = F.array(1 - F.col("probability"), F.col("probability"))
    scored = t.fx_predictions.select("actual", array_to_vector(scores).alias("rawPrediction"))
    return t.spark.createDataFrame([(round(evaluator_auc(scored, "actual"), 6),)], "auc double")


@query("probability_element", with_views("fx_predictions", """
    select l_orderkey, l_linenumber, round(probability, 6) as score from fx_predictions"""))
def probability_element(t):
    vectors = array_to_vector(F.array(1 - F.col("probability"), F.col("probability")))
    return rounded(t.fx_predictions.select("l_orderkey", "l_linenumber", positive_probability(vectors).alias("score")))


@query("model_comparison", with_views("fx_models", roc_ctes("fx_models", "score", "model") + f"""
    , basic as ({binary_sql("fx_models", "model")}),
    areas as (select model, round(sum(dx * dy) / 2, 6) as auc from steps group by model)
    select b.*, a.auc from basic b join areas a on b.model = a.model"""))
def model_comparison(t):
    return rounded(ev.compare_models(t.fx_models))


_GRID = """
    , grid as (select model, step from (select distinct model from curve) r, (select unnest(range(0, 101)) as step) s),
    read_off as (select g.model, g.step, max(c.tpr) as tpr from grid g join curve c
                 on c.model = g.model and c.fpr <= g.step / 100e0 + 1e-11 group by g.model, g.step)"""


@query("roc_compare", with_views("fx_models", roc_ctes("fx_models", "score", "model") + _GRID + """
    select model, round(step / 100e0, 6) as fpr, round(tpr, 6) as tpr from read_off"""))
def roc_compare(t):
    return rounded(ev.compare_roc(t.fx_models, "model", score="score"))


@query("roc_gap", with_views("fx_models", roc_ctes("fx_models", "score", "model") + _GRID + """
    select round(a.step / 100e0, 6) as fpr, round(abs(a.tpr - b.tpr), 6) as gap
    from read_off a join read_off b on a.step = b.step and a.model = 'by quantity' and b.model = 'by price'
    order by abs(a.tpr - b.tpr) desc, a.step limit 1"""))
def roc_gap(t):
    return rounded(ev.roc_gap(ev.compare_roc(t.fx_models, "model", score="score"), "model",
                              "by quantity", "by price"))
