"""Sketches that are merged, curves without needless points, binned densities and bounded bins."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohorta.operators import evaluation as ev, exploration as ex, gram, relational as rel, sketches
from cohorta.operators.ranking import running_totals
from cohorta.session import tune_tables


def off_by(values, found, p):
    """By how much the rank of ``found`` misses p n."""
    values = np.sort(values)
    low, high = np.searchsorted(values, found), np.searchsorted(values, found, "right")
    return max(low - p * len(values), p * len(values) - high, 0)


@given(st.lists(st.lists(st.floats(-1e6, 1e6), max_size=300), min_size=1, max_size=8), st.sampled_from([4, 16, 64]))
@settings(max_examples=80, deadline=None)
def test_a_sketch_knows_its_error(parts, size):
    whole, total = np.array(sum(parts, [])), sketches.Sketch(size)
    for part in parts:
        one = sketches.Sketch(size)
        for i in range(0, len(part), 50):
            one.add(np.array(part[i:i + 50]))
        if one.n:
            total.merge(sketches.Sketch.of(one.n, one.rank_error, one.lowest, one.highest, one.to_bytes()))
    assert total.n == len(whole)
    if len(whole):
        assert sum(len(x) << k for k, x in enumerate(total.levels)) == len(whole)
        for p in (0.01, 0.25, 0.5, 0.75, 0.99):
            assert off_by(whole, total.quantile(p), p) <= total.rank_error + (1 << len(total.levels) - 1)


@pytest.mark.parametrize("order", ["random", "rising", "falling", "few"])
def test_the_error_stays_small(order):
    values = np.random.default_rng(1).normal(size=400_000)
    values = {"random": values, "rising": np.sort(values), "falling": -np.sort(values), "few": np.round(values)}[order]
    one = sketches.Sketch()
    for part in np.split(values, 40):
        one.add(part)
    assert one.rank_error <= 0.005 * one.n and len(one.to_bytes()) < 500_000
    assert all(off_by(values, one.quantile(p), p) <= 0.002 * one.n for p in np.linspace(0.01, 0.99, 50))


def test_stored_sketches_are_merged_in_rounds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sketches, "MERGED_TOGETHER", 3)
    df = spark.range(20_000).select(F.when(F.col("id") % 7 > 0, F.sin("id")).alias("a"),
                                    F.when(F.col("id") % 2 == 0, float("nan")).otherwise(F.col("id") * 1.0).alias("b"),
                                    F.lit(None).cast("double").alias("none"))
    path = str(tmp_path / "s")
    for part in (df.repartition(9), df.limit(0)):
        sketches.sketch_columns(part, ["a", "b", "none"], 128).write.mode("append").parquet(path)
    got = {(r["column"], r["prob"]): r for r in sketches.sketch_quantiles(
        sketches.merge_sketches(spark.read.parquet(path)), [0.0, 0.5, 1.0]).collect()}
    assert {c for c, _ in got} == {"a", "b"}
    b = np.arange(1, 20_000, 2.0)
    assert got["b", 0.0]["value"] == 1 and got["b", 1.0]["value"] == 19_999 and got["b", 0.5]["n"] == 10_000
    assert off_by(b, got["b", 0.5]["value"], 0.5) <= got["b", 0.5]["rank_error"] < 1000
    assert sketches.merge_sketches(spark.read.parquet(path).limit(0)).count() == 0


def test_next_rows_are_known_across_partitions(spark):
    df = spark.range(200).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 200).alias("o"), F.lit(1).alias("one"),
                                 (F.col("id") * 3).alias("v"))
    got = running_totals(df, "o", {"one": "rank"}, ["g"], True, partitions=7, following={"v": "next"}).collect()
    for g in range(3):
        rows = sorted((r for r in got if r["g"] == g), key=lambda r: r["rank"])
        assert [r["o"] for r in rows] == sorted((r["o"] for r in rows), reverse=True)
        assert [r["next"] for r in rows] == [r["v"] for r in rows[1:]] + [None]


def test_corners_draw_the_same_curve(spark):
    rng = np.random.default_rng(2)
    score = np.repeat(rng.permutation(3000) / 3000, 1 + (np.arange(3000) % 2))
    actual = (rng.random(len(score)) < score ** 3).astype(int)
    df = spark.createDataFrame([(int(a), float(s)) for a, s in zip(actual, score)], "actual int, probability double")
    whole = sorted(ev.roc_curve(df).collect(), key=lambda r: r["point_no"])
    corners = sorted(ev.roc_curve(df, drop_intermediate=True).collect(), key=lambda r: r["point_no"])
    points = np.array([(r["fpr"], r["tpr"]) for r in whole])
    # The rule of common libraries: after the first point, no change of step.
    bend = np.abs(np.diff(points[1:], 2, axis=0)).max(axis=1) > 1e-12
    kept = np.concatenate(([True, True], bend, [True]))
    assert [r["point_no"] for r in corners] == [r["point_no"] for r, k in zip(whole, kept) if k]
    assert len(corners) < len(whole)
    x, y = np.array([(r["fpr"], r["tpr"]) for r in corners]).T
    assert float(((x[1:] - x[:-1]) * (y[1:] + y[:-1])).sum() / 2) == pytest.approx(ev.auc(df).first()["auc"])
    one = spark.createDataFrame([(1, 0.5)], "actual int, probability double")
    assert ev.roc_curve(one, drop_intermediate=True).count() == 2


@pytest.mark.parametrize("tail", [0.0, 400.0])
def test_binned_density_is_near_the_exact_one(spark, tail):
    values = np.append(np.random.default_rng(3).normal(size=3000), [tail])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double")
    got = sorted((r["point"], r["x"], r["density"]) for r in ex.density(df, ["v"], points=400).collect())
    h = values.std(ddof=1) * len(values) ** -0.2
    exact = np.array([np.exp(-0.5 * ((values - x) / h) ** 2).sum() / (len(values) * h * math.sqrt(2 * math.pi)) for _, x, _ in got])
    found = np.array([d for _, _, d in got])
    assert [p for p, _, _ in got] == list(range(400)) and np.abs(found - exact).max() <= 0.005 * exact.max()


def test_density_sums_the_kernel_of_every_value(spark):
    """Also where the values are few and the range is many thousand bandwidths wide."""
    values = np.append(np.random.default_rng(5).normal(size=500), [30.0, 1e6])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    got = sorted((r["point"], r["x"], r["density"]) for r in ex.density(df, ["v"], points=50).collect())
    h = values.std(ddof=1) * len(values) ** -0.2
    exact = [np.exp(-0.5 * ((values - x) / h) ** 2).sum() / (len(values) * h * math.sqrt(2 * math.pi)) for _, x, _ in got]
    assert [d for _, _, d in got] == pytest.approx(exact, rel=1e-7, abs=1e-9 * max(exact))


def test_bins_are_bounded_and_count_all_rows(spark):
    df = spark.createDataFrame([(float(i % 97), float(i)) for i in range(5000)] + [(1e9, 1.0)], "far double, near double")
    summary = ex.summarise(df, ["far", "near"])
    low, width, bins = summary.bins("far")
    assert ex.MOST_BINS / 2 <= bins <= ex.MOST_BINS and low + width * bins >= 1e9
    got = ex.histogram(df, ["far", "near"], summary).groupBy("column").agg(F.sum("n").alias("n"), F.max("bin").alias("b")).collect()
    assert {r["column"]: r["n"] for r in got} == {"far": 5001, "near": 5001} and max(r["b"] for r in got) < ex.MOST_BINS
    pairs = ex.pair_density(df, ["far", "near"], summary)
    assert pairs.agg(F.sum("n")).first()[0] == 5001
    assert pairs.agg(F.max("x_bin")).first()[0] < ex.MOST_PAIR_BINS


def test_sums_of_pairs_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(gram, "BLOCK", 3)
    monkeypatch.setattr(gram, "ADDED_TOGETHER", 2)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 7)) @ rng.normal(size=(7, 7)) + 1e6
    holes = rng.random(x.shape) < 0.2
    rows = [tuple(None if h else float(v) for v, h in zip(a, b)) + (5.0, None) for a, b in zip(x, holes)]
    names = [f"c{j}" for j in range(7)] + ["same", "none"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(5)
    r = gram.correlations(gram.pair_sums(df, names))
    for i in range(7):
        for j in range(7):
            both = ~holes[:, i] & ~holes[:, j]
            assert r[i, j] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)
    assert np.isnan(r[7:]).all() and np.isnan(r[:, 7:]).all()
    assert np.isnan(gram.correlations(gram.pair_sums(df.limit(0), names))).all()


def test_nan_spoils_its_pairs_only(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, float("nan"), 1.0), (4.0, 5.0, 9.0)], "a double, b double, c double")
    sums = gram.pair_sums(df, ["a", "b", "c"])
    assert np.isnan(gram.correlations(sums)).tolist() == [[False, True, False], [True, True, True], [False, True, False]]


def test_a_tasks_share_of_a_shuffle_is_bounded(spark):
    """Few shuffle partitions asked for, much to group: adaptive execution still makes more, smaller ones."""
    tune_tables(spark)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "1m")
    try:
        diagnoses = spark.range(800_000).repartition(4).select(F.col("id").alias("subject_id"), F.xxhash64("id").alias("hadm_id"),
                                                               F.lit("a").alias("icd9_code"))
        placed = rel.comorbidity_count(diagnoses).select(F.spark_partition_id().alias("part"))
        sizes = [r["count"] for r in placed.groupBy("part").count().collect()]
    finally:
        spark.conf.set(key, old)
    assert sum(sizes) == 800_000 and len(sizes) > 4 and max(sizes) < 800_000 / 4


def test_a_growing_table_is_not_broadcast(spark):
    """Patients, admissions and stays of a few MB: no task holds a whole one of them."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.unset(key)
    tune_tables(spark)
    ids = spark.range(200_000)
    admissions = ids.select(F.col("id").alias("subject_id"), F.col("id").alias("hadm_id"),
                            F.lit("2020-01-01").cast("timestamp").alias("admittime"))
    patients = ids.select(F.col("id").alias("subject_id"), F.lit("1950-01-01").cast("timestamp").alias("dob"))
    stays = ids.select(F.col("id").alias("subject_id"), F.col("id").alias("hadm_id"), F.col("id").alias("icustay_id"))
    core = rel.merge_core(admissions, patients, stays)
    joined = core.select("hadm_id", "age")
    assert len(joined.collect()) == 200_000
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()


def test_a_tasks_share_of_score_levels_is_bounded(spark):
    """The scores of one run under few shuffle partitions: more and smaller tasks give the totals."""
    tune_tables(spark)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "1m")
    try:
        levels = spark.range(800_000).select(F.lit("inference").alias("run"), F.xxhash64("id").cast("double").alias("score"),
                                             F.lit(1).alias("n"))
        totals = running_totals(levels, "score", {"n": "upto"}, ["run"], descending=True)
        placed = totals.groupBy(F.spark_partition_id().alias("part")).agg(F.count("n").alias("n"), F.max("upto").alias("upto"))
        parts = placed.collect()
    finally:
        spark.conf.set(key, old)
    sizes = [r["n"] for r in parts]
    assert sum(sizes) == 800_000 == max(r["upto"] for r in parts)
    assert len(sizes) > 4 and max(sizes) < 800_000 / 3  # two ranges may meet in one task


def test_a_callers_setting_stays(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "5m")
    try:
        assert tune_tables(spark).conf.get(key) == "5m"
    finally:
        spark.conf.set(key, old)
