"""Seeded sampling, synthesis, SMOTE, splits and folds.

Every draw is a hash of (seed, key), so ``keys`` must identify a row. Results do not
change with partitioning, retries or cluster size.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from cohorta.config import LABEL, SEED
from cohorta.functions.uniform import choice_index, hash_normal, hash_uniform
from cohorta.operators.neighbours import with_neighbours
from cohorta.operators.profiling import column_profile, distinct_values
from cohorta.operators.ranking import hash_rank, running_totals, take_by_hash
from cohorta.operators.relational import replicate_rows

# A lookup table up to this many rows is sent to every executor.
BROADCAST_ROWS = 100_000


def sample_rows(df: DataFrame, n: int, keys: list[str], seed: int = SEED) -> DataFrame:
    """n rows without replacement, or all rows if there are fewer."""
    return take_by_hash(df.withColumn("_u", hash_uniform(*keys, seed=seed)), n, "_u", keys).drop("_u")


def upsample_rows(df: DataFrame, n: int, keys: list[str], seed: int = SEED) -> DataFrame:
    """n rows out of equal copies of the table; a row appears at most n // count + 1 times.

    Fewer rows than the table has are refused: that is ``sample_rows``.
    """
    rows = df.count()
    if rows == 0:
        raise ValueError("cannot up-sample an empty table")
    if n < rows:
        raise ValueError(f"{n} rows are fewer than the table's {rows}; sample_rows draws fewer rows")
    copies = replicate_rows(df, n // rows + 1)
    drawn = copies.withColumn("_u", hash_uniform(*keys, "copy_no", seed=seed))
    return take_by_hash(drawn, n, "_u", [*keys, "copy_no"]).drop("_u")


def synthesise(df: DataFrame, n: int, label: str | None = LABEL, seed: int = SEED) -> DataFrame:
    """n rows drawn column by column: numbers from Normal(mean, sample std) of the column,
    all else uniformly from its different values; ``label`` is 1 for the first half, then 0.
    """
    spark = df.sparkSession
    names = [c for c in df.columns if c != label]
    numeric = [c for c in names if isinstance(df.schema[c].dataType, NumericType)]
    others = [c for c in names if c not in numeric]
    out = spark.range(n).withColumnRenamed("id", "row_no")
    if numeric:
        moments = {r["column"]: r for r in column_profile(df, numeric).collect()}
        out = out.withColumns({
            c: F.lit(moments[c]["mean"]) + F.lit(moments[c]["std"] or 0.0)
            * hash_normal("row_no", seed=seed, stream=c) for c in numeric})
    if others:
        values = running_totals(distinct_values(df, others).withColumn("_one", F.lit(1)),
                                "value", {"_one": "_rank"}, groups=["column"])
        sizes = {r["column"]: r["n"] for r in values.groupBy("column").agg(F.max("_rank").alias("n")).collect()}
        for c in others:
            if c not in sizes:
                out = out.withColumn(c, F.lit(None).cast(df.schema[c].dataType))
                continue
            # Few values: broadcast, as the draws pile up on them. Many: the draws spread out.
            choices = values.filter(F.col("column") == c).select(
                (F.col("_rank") - 1).alias("_pick"), F.col("value").cast(df.schema[c].dataType).alias(c))
            out = (out.withColumn("_pick", choice_index(sizes[c], "row_no", seed=seed, stream=c))
                   .join(F.broadcast(choices) if sizes[c] <= BROADCAST_ROWS else choices, "_pick")
                   .drop("_pick"))
    if label:
        out = half_labels(out, "row_no", n, label)
    return out.select("row_no", *[c for c in df.columns if c in out.columns],
                      *([label] if label and label not in df.columns else []))


def half_labels(df: DataFrame, row_no: str, n: int, label: str = LABEL) -> DataFrame:
    """Label 1 for the first n // 2 rows, 0 for the rest; an odd n is allowed."""
    return df.withColumn(label, F.when(F.col(row_no) < n // 2, 1).otherwise(0))


def smote(df: DataFrame, features: list[str], label: str, key: str, k: int = 5, seed: int = SEED,
          cell_rows: int = 2048) -> DataFrame:
    """Raise every smaller class to the size of the largest one.

    A new row lies between a drawn row and one of its k nearest rows of the same class:
    x + u (neighbour - x), one u per row. Returns key (NULL on new rows), features,
    label and ``synthetic``. Classes are few; neighbours are exact. A NULL or NaN feature of a
    labelled row is refused: such a row has no neighbours.
    """
    _check_features(df.filter(F.col(label).isNotNull()), features)
    sizes = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()
             if r[label] is not None}
    largest = max(sizes.values())
    doubles = {f: F.col(f).cast("double") for f in features}
    out = (df.select(key, *features, label).withColumns(doubles)
           .withColumn("synthetic", F.lit(0)))
    for value in sorted(sizes):
        if sizes[value] < largest:
            members = df.filter(F.col(label) == value).select(key, *features).withColumns(doubles)
            new = _new_rows(members, sizes[value], largest - sizes[value], features, key, k, seed, cell_rows)
            out = out.unionByName(
                new.select(*features)
                .withColumn(key, F.lit(None).cast(df.schema[key].dataType))
                .withColumn(label, F.lit(value).cast(df.schema[label].dataType))
                .withColumn("synthetic", F.lit(1)))
    return out


def _check_features(df: DataFrame, features: list[str]) -> None:
    bad = [F.col(f).isNull() | F.isnan(F.col(f).cast("double")) for f in features]
    if df.filter(F.greatest(F.lit(False), *bad)).limit(1).count():
        raise ValueError("features with NULL or NaN have no neighbours: fill them first")


def _new_rows(members: DataFrame, size: int, n: int, features: list[str], key: str, k: int,
              seed: int, cell_rows: int) -> DataFrame:
    """(draw, base, neighbour, features...) of n synthetic rows."""
    if size < 2:
        raise ValueError("a class of one row has no neighbours to draw from")
    k = min(k, size - 1)
    ranked = hash_rank(members.withColumn("_u", hash_uniform(key, seed=seed, stream="order")),
                       "_u", [key], rank_col="_rank").drop("_u")
    draws = members.sparkSession.range(n).select(
        F.col("id").alias("draw"), choice_index(size, "id", seed=seed, stream="base").alias("_rank"))
    # Few members: every draw meets them in place. Many: each member is drawn a few times only.
    base = draws.join(F.broadcast(ranked) if size <= BROADCAST_ROWS else ranked, "_rank").drop("_rank")
    found = with_neighbours(members, base, key, features, k, cell_rows)
    picked = F.element_at("near", (choice_index(F.size("near"), "draw", seed=seed, stream="nn") + 1).cast("int"))
    step = hash_uniform("draw", seed=seed, stream="step")
    return (found.withColumn("_to", picked).withColumn("_step", step)
            .select("draw", F.col(key).alias("base"), F.col("_to.id").alias("neighbour"),
                    *[(F.col(f) + F.col("_step") * (F.col("_to.x")[i] - F.col(f))).alias(f)
                      for i, f in enumerate(features)]))


def smote_rows(df: DataFrame, features: list[str], label: str, key: str, value, k: int = 5,
               seed: int = SEED, cell_rows: int = 2048) -> DataFrame:
    """The new rows of one class with the rows they were drawn between."""
    _check_features(df.filter(F.col(label) == value), features)
    sizes = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    doubles = {f: F.col(f).cast("double") for f in features}
    members = df.filter(F.col(label) == value).select(key, *features).withColumns(doubles)
    return _new_rows(members, sizes[value], max(sizes.values()) - sizes[value], features, key, k, seed, cell_rows)


def split_flag(df: DataFrame, test_share: float, keys: list[str], seed: int = SEED,
               exact: bool = False, flag: str = "is_test") -> DataFrame:
    """Mark test rows. By default each row decides on its own hash: no shuffle, and a row
    keeps its side when rows are added. ``exact`` takes ceil(share * n) rows instead."""
    u = df.withColumn("_u", hash_uniform(*keys, seed=seed, stream="split"))
    if not exact:
        return u.withColumn(flag, F.col("_u") < test_share).drop("_u")
    cut = math.ceil(test_share * df.count())
    return hash_rank(u, "_u", keys, rank_col="_rank").withColumn(flag, F.col("_rank") < cut).drop("_u", "_rank")


def split_train_test(df: DataFrame, test_share: float, keys: list[str], seed: int = SEED,
                     exact: bool = False) -> tuple[DataFrame, DataFrame]:
    marked = split_flag(df, test_share, keys, seed, exact)
    return (marked.filter(~F.col("is_test")).drop("is_test"), marked.filter("is_test").drop("is_test"))


def stratified_folds(df: DataFrame, k: int, label: str, keys: list[str], seed: int = SEED,
                     fold: str = "fold") -> DataFrame:
    """Fold 0..k-1 with every class spread evenly: fold sizes of a class differ by at most 1."""
    u = df.withColumn("_u", hash_uniform(*keys, seed=seed, stream="fold"))
    return (hash_rank(u, "_u", keys, [label], "_rank")
            .withColumn(fold, (F.col("_rank") % k).cast("int")).drop("_u", "_rank"))
