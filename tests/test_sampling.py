"""Samples, folds, neighbours and SMOTE: exact, seeded and independent of partitioning."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohorta.functions import hash_uniform
from cohorta.operators import neighbours, ranking, sampling


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def numbers(spark):
    """A third of the rows share one group and one value."""
    return spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).cast("int").alias("g"),
        F.when(F.col("id") % 3 == 0, 1.5).otherwise(F.col("id") * 0.25).alias("v"))


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_partitioning_changes_nothing(numbers, parts):
    again = numbers.repartition(parts)
    for op in (lambda d: sampling.sample_rows(d, 100, ["id"]),
               lambda d: sampling.upsample_rows(d, 4000, ["id"]),
               lambda d: sampling.split_flag(d, 0.3, ["id"], exact=True),
               lambda d: sampling.stratified_folds(d, 5, "g", ["id"])):
        assert rows(op(again)) == rows(op(numbers))


def test_large_sample_is_exact_and_nested(numbers):
    u = numbers.withColumn("u", hash_uniform("id"))
    for n in (0, 1, 777, 2999, 3000, 9999):
        got = rows(ranking.take_by_hash(u, n, "u", ["id"], small=0))
        assert got == sorted(tuple(r) for r in sorted(u.collect(), key=lambda r: (r["u"], r["id"]))[:n])


def test_upsample_counts(numbers, spark):
    counts = [r["n"] for r in sampling.upsample_rows(numbers, 7500, ["id"]).groupBy("id").agg(F.count("*").alias("n")).collect()]
    assert sum(counts) == 7500 and max(counts) <= 3
    with pytest.raises(ValueError):
        sampling.upsample_rows(spark.range(0), 10, ["id"])


def test_split_is_disjoint_complete_and_exact(numbers):
    train, test = sampling.split_train_test(numbers, 0.3, ["id"], exact=True)
    assert test.count() == math.ceil(0.3 * 3000) and train.count() + test.count() == 3000
    assert train.join(test, "id").count() == 0


def test_folds_are_balanced_per_class(numbers):
    sizes = sampling.stratified_folds(numbers, 5, "g", ["id"]).groupBy("g", "fold").count().collect()
    for g in {r["g"] for r in sizes}:
        ns = [r["count"] for r in sizes if r["g"] == g]
        assert max(ns) - min(ns) <= 1 and len(ns) == 5


def test_hash_rank_with_null_group(spark):
    df = spark.createDataFrame([(i, None if i % 2 else 1) for i in range(20)], "id long, g int")
    ranked = ranking.hash_rank(df.withColumn("u", hash_uniform("id")), "u", ["id"], ["g"])
    assert sorted(r["rank"] for r in ranked.filter("g is null").collect()) == list(range(10))


def test_running_totals_match_a_plain_window(numbers):
    per_value = numbers.groupBy("g", "v").agg(F.count("*").alias("n"))
    got = ranking.running_totals(per_value, "v", {"n": "upto"}, ["g"], descending=True).collect()
    for g in {r["g"] for r in got}:
        total = 0
        for r in sorted((r for r in got if r["g"] == g), key=lambda r: -r["v"]):
            total += r["n"]
            assert r["upto"] == total


def test_no_single_partition_over_rows(numbers):
    plan = ranking.hash_rank(numbers.withColumn("u", hash_uniform("id")), "u", ["id"])._jdf.queryExecution().toString()
    head = plan.split("== Physical Plan ==")[1]
    assert head.count("SinglePartition") <= 1  # only the bucket offsets


def brute(points, k):
    ids = sorted(points)
    out = []
    for i in ids:
        d = sorted((sum((a - b) ** 2 for a, b in zip(points[i], points[j])), j) for j in ids if j != i)[:k]
        out += [(i, r + 1, j, round(d2, 9)) for r, (d2, j) in enumerate(d)]
    return sorted(out)


@pytest.mark.parametrize("n,dims,cell_rows,hot", [(600, 2, 40, 200), (500, 4, 64, 0), (400, 3, 10_000, 150),
                                                  (6, 2, 4, 0), (300, 1, 16, 280)])
def test_neighbours_equal_brute_force(spark, n, dims, cell_rows, hot):
    rng = np.random.default_rng(n)
    x = rng.integers(0, 25, size=(n, dims)).astype(float)
    x[:hot] = 7.0
    data = {int(i): tuple(v) for i, v in enumerate(x)}
    names = [f"f{j}" for j in range(dims)]
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in data.items()],
                               "id long, " + ", ".join(f"{c} double" for c in names)).repartition(3)
    got = neighbours.nearest_neighbours(df, "id", names, 5, cell_rows)
    assert sorted((r[0], r[1], r[2], round(r[3], 9)) for r in got.collect()) == brute(data, 5)


@pytest.mark.parametrize("dims", [2, 8])
def test_neighbours_through_two_levels_of_trees(spark, monkeypatch, dims):
    monkeypatch.setattr(neighbours, "ROUTED_ROWS", 30)
    rng = np.random.default_rng(dims)
    x = np.round(rng.normal(size=(400, dims)) @ rng.normal(size=(dims, dims)), 3)
    data = {int(i): tuple(v) for i, v in enumerate(x)}
    points = spark.createDataFrame([(i, list(map(float, v))) for i, v in data.items()], "vid long, x array<double>")
    found, visits = neighbours._vector_neighbours(points, 400, dims, 4, 10, top_cells=5)
    got = [(r["vid"], i + 1, e["vid"], round(e["d2"], 9)) for r in found.collect() for i, e in enumerate(r["near"])]
    assert sorted(got) == brute(data, 4)
    assert visits.agg(F.max("first")).first()[0] <= neighbours.FIRST_VISITS and visits.count() == 400


@pytest.mark.parametrize("top_cells,block_rows", [(1000, 80), (5, 80), (40, 200)])
def test_a_point_is_sent_once_to_a_block_of_cells(spark, monkeypatch, top_cells, block_rows):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", block_rows)
    x = np.round(np.random.default_rng(4).normal(size=(600, 6)), 3)
    points = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], "vid long, x array<double>")
    cells = neighbours.Cells(points, 600, 6, 10, top_cells)
    asks = points.withColumns({"r2": F.lit(4.0), "seen": F.array().cast("array<long>")})
    visits = cells.within(asks, None).cache()
    sent = neighbours._by_block(visits, cells).cache()
    assert sent.count() == sent.dropDuplicates(["vid", "block"]).count() < visits.agg(F.sum(F.size("cells"))).first()[0] / 3
    flat = sent.select("vid", F.explode("cells").alias("cell"))
    assert flat.exceptAll(visits.select("vid", F.explode("cells"))).count() == 0
    assert flat.count() == visits.agg(F.sum(F.size("cells"))).first()[0]
    held = neighbours._with_block(cells.place(points), cells).groupBy("block").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("cell").alias("cells")).collect()
    assert max(r["n"] for r in held) <= 4 * block_rows and len(held) >= 600 / (4 * block_rows)


def test_bounds_hold_and_cut_off_leaves():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 5)) * [10, 5, 1, 0.5, 0.1]
    tree = neighbours.build_tree(x, 50)
    leaf = neighbours.leaf_of(tree, x)
    asks = rng.normal(size=(60, 5)) * [10, 5, 1, 0.5, 0.1]
    point, found, bound = neighbours.leaves_within(tree, asks, np.full(60, np.inf))
    assert len(point) == 60 * len(set(leaf))
    for i, c, b in zip(point, found, bound):
        assert ((x[leaf == c] - asks[i]) ** 2).sum(axis=1).min() >= b * (1 - 1e-9)
    assert len(neighbours.leaves_within(tree, asks, np.full(60, 1.0))[0]) < 60 * len(set(leaf)) / 4


def test_training_partitions_grow_with_the_rows(spark):
    from cohorta.operators.modelling import ROWS_PER_TASK, _dealt
    df = spark.range(10)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    assert _dealt(df, 100).rdd.getNumPartitions() == 1
    assert _dealt(df, 40 * ROWS_PER_TASK).rdd.getNumPartitions() == 41


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_smote_refuses_missing_features(spark, bad):
    data = [(i, int(i >= 10), float(i), 1.0 if i != 3 else bad) for i in range(40)]
    df = spark.createDataFrame(data, "id long, y int, a double, b double")
    with pytest.raises(ValueError, match="NULL or NaN"):
        sampling.smote(df, ["a", "b"], "y", "id")
    with pytest.raises(ValueError, match="NULL or NaN"):
        sampling.smote_rows(df, ["a", "b"], "y", "id", 0)


@pytest.mark.parametrize("minority", [2, 3, 5, 6, 40])
def test_smote_balances_with_few_rows(spark, minority):
    rng = np.random.default_rng(minority)
    data = [(i, int(i >= minority), float(rng.normal()), float(rng.normal())) for i in range(minority + 60)]
    df = spark.createDataFrame(data, "id long, y int, a double, b double")
    out = sampling.smote(df, ["a", "b"], "y", "id")
    assert {r["y"]: r["count"] for r in out.groupBy("y").count().collect()} == {0: 60, 1: 60}
    made = sampling.smote_rows(df, ["a", "b"], "y", "id", 0).collect()
    points = {i: (a, b) for i, y, a, b in data if y == 0}
    for r in made:
        p, q = np.array(points[r["base"]]), np.array(points[r["neighbour"]])
        z = np.array([r["a"], r["b"]])
        assert r["base"] != r["neighbour"]
        assert np.linalg.norm(z - p) + np.linalg.norm(q - z) == pytest.approx(np.linalg.norm(q - p))


def test_smote_single_row_class_raises(spark):
    df = spark.createDataFrame([(0, 0, 1.0), (1, 1, 2.0), (2, 1, 3.0)], "id long, y int, a double")
    with pytest.raises(ValueError):
        sampling.smote(df, ["a"], "y", "id")


def test_synthesis_shape_and_label_halves(spark):
    df = spark.createDataFrame([(1.0, "a", 0), (3.0, "b", 1), (5.0, None, 1)], "x double, s string, hospital_expire_flag int")
    out = sampling.synthesise(df, 501)
    assert out.columns == ["row_no", "x", "s", "hospital_expire_flag"]
    got = out.collect()
    assert sum(r["hospital_expire_flag"] for r in got) == 250
    assert {r["s"] for r in got} == {"a", "b"}
    assert np.mean([r["x"] for r in got]) == pytest.approx(3.0, abs=0.4)
    assert np.std([r["x"] for r in got]) == pytest.approx(2.0, abs=0.3)
