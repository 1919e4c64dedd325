"""Classification metrics, exact ROC curves and AUC.

Every metric comes from the confusion counts or from the counts per distinct score, both
reduced before the shuffle. All operators take optional group columns (model, run).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohorta.operators.ranking import running_totals


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion_matrix(df: DataFrame, actual: str = "actual", predicted: str = "prediction",
                     groups: list[str] | None = None) -> DataFrame:
    """(groups, actual, prediction, n)."""
    return (df.groupBy(*(groups or []), F.col(actual).cast("int").alias("actual"),
                       F.col(predicted).cast("int").alias("prediction"))
            .agg(F.count(F.lit(1)).alias("n")))


def binary_metrics(df: DataFrame, actual: str = "actual", predicted: str = "prediction",
                   groups: list[str] | None = None) -> DataFrame:
    """(groups, accuracy, precision, recall, f1) of class 1; a metric without cases is 0."""
    a, p = F.col(actual).cast("int"), F.col(predicted).cast("int")
    counts = df.groupBy(*(groups or [])).agg(
        F.count_if((a == 1) & (p == 1)).alias("tp"), F.count_if((a == 0) & (p == 1)).alias("fp"),
        F.count_if((a == 1) & (p == 0)).alias("fn"), F.count_if(a == p).alias("hit"),
        F.count(F.lit(1)).alias("n"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        *(groups or []), ratio(F.col("hit"), F.col("n")).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def _per_class(confusion: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, class, precision, recall, f1, support) from confusion counts."""
    sides = confusion.select(*groups, F.explode(F.array(
        F.struct(F.col("actual").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("chosen"),
                 F.when(F.col("actual") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("support"),
                 F.col("n").alias("chosen"), F.lit(0).cast("long").alias("hit")))).alias("e")).select(*groups, "e.*")
    s, c, h = F.sum("support"), F.sum("chosen"), F.sum("hit")
    return sides.groupBy(*groups, "class").agg(
        ratio(h, c).alias("precision"), ratio(h, s).alias("recall"), ratio(2 * h, c + s).alias("f1"),
        s.alias("support"))


def classification_report(df: DataFrame, actual: str = "actual", predicted: str = "prediction",
                          groups: list[str] | None = None) -> DataFrame:
    """(groups, row, precision, recall, f1, support): one row per class, then the overall
    accuracy, the plain average and the support-weighted average of the classes."""
    groups = groups or []
    confusion = confusion_matrix(df, actual, predicted, groups)
    classes = _per_class(confusion, groups)
    n = F.sum("support")
    accuracy = F.sum(F.col("recall") * F.col("support")) / n
    overall = classes.groupBy(*groups).agg(
        accuracy.alias("acc"), n.alias("n"),
        *[F.avg(m).alias(f"m_{m}") for m in ("precision", "recall", "f1")],
        *[(F.sum(F.col(m) * F.col("support")) / n).alias(f"w_{m}") for m in ("precision", "recall", "f1")])

    def line(name: str, prefix: str | None) -> Column:
        values = [F.col(f"{prefix}_{m}" if prefix else "acc").alias(m) for m in ("precision", "recall", "f1")]
        return F.struct(F.lit(name).alias("row"), *values, F.col("n").alias("support"))

    lines = (overall.select(*groups, F.explode(F.array(
        line("accuracy", None), line("macro avg", "m"), line("weighted avg", "w"))).alias("e"))
        .select(*groups, "e.*"))
    return classes.withColumnRenamed("class", "row").withColumn(
        "row", F.col("row").cast("string")).unionByName(lines)


def weighted_metrics(df: DataFrame, actual: str = "actual", predicted: str = "prediction",
                     groups: list[str] | None = None) -> DataFrame:
    """(groups, accuracy, precision, recall, f1), the last three weighted by support. One job."""
    return (classification_report(df, actual, predicted, groups)
            .filter(F.col("row") == "weighted avg")
            .select(*(groups or []), F.col("recall").alias("accuracy"), "precision", "recall", "f1"))


def score_counts(df: DataFrame, actual: str = "actual", score: str = "probability",
                 groups: list[str] | None = None) -> DataFrame:
    """(groups, score, pos, neg): ties become one row before anything is sorted."""
    return (df.groupBy(*(groups or []), (F.col(score).cast("double") + F.lit(0.0)).alias("score"))
            .agg(F.count_if(F.col(actual) == 1).alias("pos"), F.count_if(F.col(actual) != 1).alias("neg")))


def _cumulated(df: DataFrame, actual: str, score: str, groups: list[str]) -> tuple[DataFrame, DataFrame]:
    """Score levels from the highest down with running totals, and the totals per group."""
    levels = score_counts(df, actual, score, groups).withColumn("_one", F.lit(1))
    cumulated = running_totals(levels.withColumn("_step", F.struct("pos", "neg")), "score",
                               {"pos": "tp", "neg": "fp", "_one": "point_no"}, groups, descending=True,
                               following={"_step": "_next"})
    totals = cumulated.groupBy(*groups).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return cumulated, totals


def _with_totals(df: DataFrame, totals: DataFrame, groups: list[str]) -> DataFrame:
    """Attach the totals: one row per group, one at all without groups."""
    if groups:
        return df.join(totals, groups)
    one = F.broadcast(totals.withColumn("_all", F.lit(1)))
    return df.withColumn("_all", F.lit(1)).join(one, "_all").drop("_all")


def roc_curve(df: DataFrame, actual: str = "actual", score: str = "probability",
              groups: list[str] | None = None, drop_intermediate: bool = False) -> DataFrame:
    """(groups, point_no, threshold, fpr, tpr): (0, 0) first, then one point per distinct score.

    ``drop_intermediate`` leaves out points in the middle of equal steps (as many positives and
    negatives at this score as at the next one): a drawn curve is the same without them, and so is
    its area. The first and the last score stay, points keep their numbers. A rate without cases
    (one class only) is NULL.
    """
    groups = groups or []
    cumulated, totals = _cumulated(df, actual, score, groups)
    if drop_intermediate:
        cumulated = cumulated.filter((F.col("point_no") == 1) | ~F.col("_step").eqNullSafe(F.col("_next")))
    start = totals.select(*groups, F.lit(0).cast("long").alias("point_no"),
                          F.lit(float("inf")).alias("threshold"),
                          F.when(F.col("N") > 0, 0.0).alias("fpr"), F.when(F.col("P") > 0, 0.0).alias("tpr"))
    points = _with_totals(cumulated, totals, groups).select(
        *groups, F.col("point_no"), F.col("score").alias("threshold"),
        F.try_divide(F.col("fp").cast("double"), F.col("N").cast("double")).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), F.col("P").cast("double")).alias("tpr"))
    return start.unionByName(points)


def auc(df: DataFrame, actual: str = "actual", score: str = "probability",
        groups: list[str] | None = None) -> DataFrame:
    """(groups, auc): exact trapezoid area; NULL when a group has one class only."""
    groups = groups or []
    cumulated, _ = _cumulated(df, actual, score, groups)
    area = F.sum(F.col("neg").cast("double") * (F.col("tp") - F.col("pos") / F.lit(2.0)))
    cells = F.max("tp").cast("double") * F.max("fp").cast("double")
    return cumulated.groupBy(*groups).agg(F.try_divide(area, cells).alias("auc"))


def compare_models(df: DataFrame, actual: str = "actual", predicted: str = "prediction",
                   score: str = "score", model: str = "model") -> DataFrame:
    """(model, accuracy, precision, recall, f1, auc) for scored rows of several models."""
    return (binary_metrics(df, actual, predicted, [model])
            .join(auc(df, actual, score, [model]), model))


def compare_roc(df: DataFrame, run: str, actual: str = "actual", score: str = "probability",
                steps: int = 100) -> DataFrame:
    """(run, fpr, tpr): each run's curve read off at the same ``steps`` + 1 false positive rates.

    tpr is the highest rate reached at or below the given fpr.
    """
    curve = roc_curve(df, actual, score, [run])
    at = F.ceil(F.col("fpr") * steps - F.lit(1e-9)).cast("int")
    per_step = curve.groupBy(run, at.alias("step")).agg(F.max("tpr").alias("tpr"))
    return _fill_steps(per_step, run, steps)


def _fill_steps(per_step: DataFrame, run: str, steps: int) -> DataFrame:
    """At most steps + 1 rows per run come in, so one small window per run is enough."""
    from pyspark.sql import Window
    grid = (per_step.select(run).distinct()
            .withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(steps)))))
    upto = Window.partitionBy(run).orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (grid.join(per_step, [run, "step"], "left")
            .select(run, (F.col("step") / F.lit(float(steps))).alias("fpr"), F.max("tpr").over(upto).alias("tpr")))


def roc_gap(compared: DataFrame, run: str, first, second) -> DataFrame:
    """(fpr, gap) where two runs of ``compare_roc`` differ most; the smaller fpr on a tie."""
    both = compared.groupBy("fpr").agg(
        F.max(F.when(F.col(run) == first, F.col("tpr"))).alias("a"),
        F.max(F.when(F.col(run) == second, F.col("tpr"))).alias("b"))
    return (both.select("fpr", F.abs(F.col("a") - F.col("b")).alias("gap"))
            .orderBy(F.desc_nulls_last("gap"), "fpr").limit(1))
