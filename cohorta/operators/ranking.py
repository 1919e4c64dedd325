"""Global positions, running totals and exact quantiles without a one-partition window.

Each operator sorts buckets of the data in parallel and adds what lies before a bucket,
which is one small row per bucket.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohorta.operators.sketches import merge_sketches, sketch_brackets, sketch_columns
from cohorta.session import materialise

# Equal slices of a uniform hash. Offsets are one small row per slice and group; a slice holds a
# 65,536th of a group, whatever the number of partitions.
SLICES = 65_536


def _with_offsets(df: DataFrame, per_bucket: DataFrame, keys: list[str], added: list[str]) -> DataFrame:
    """Attach the bucket rows. They are few: buckets x groups, whatever the data size."""
    left, right = df.alias("l"), F.broadcast(per_bucket).alias("r")
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    return left.join(right, cond).select("l.*", *[F.col(f"r.{a}") for a in added])


def hash_rank(df: DataFrame, u: str, tie: list[str], groups: list[str] | None = None,
              rank_col: str = "rank") -> DataFrame:
    """0-based position of each row in the order (u, tie) inside its group.

    ``u`` is uniform in [0, 1), so equal-width buckets hold equal shares of the rows
    even when one group holds most of the table. ``groups`` must be few (class labels).
    """
    groups = groups or []
    placed = df.withColumn("_bucket", F.floor(F.col(u) * SLICES).cast("int"))
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy(*groups, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
               .select(*groups, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    inside = Window.partitionBy(*groups, "_bucket").orderBy(u, *tie)
    return (_with_offsets(placed, offsets, [*groups, "_bucket"], ["_before"])
            .withColumn(rank_col, F.col("_before") + F.row_number().over(inside) - 1)
            .drop("_bucket", "_before"))


def take_by_hash(df: DataFrame, n: int, u: str, tie: list[str], small: int = 200_000) -> DataFrame:
    """The n rows with the smallest (u, tie): a sample without replacement of exact size.

    The row counts of 65,536 slices of u tell where the n-th row lies; a plain filter drops
    all slices above. A plain sort with limit would send n rows of every partition to one
    task. What is left is sorted if it is small; else only the slice at the cut is ranked.
    """
    slices = SLICES
    slice_of = F.floor(F.col(u) * slices).cast("int")
    sizes = dict(df.groupBy(slice_of.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect())
    below, cut = 0, 0
    while cut < slices and below + sizes.get(cut, 0) <= n:
        below += sizes.get(cut, 0)
        cut += 1
    if cut == slices:
        return df
    if below + sizes[cut] <= small:
        return df.filter(F.col(u) < F.lit((cut + 1) / slices)).orderBy(u, *tie).limit(n)
    kept = df.filter(F.col(u) < F.lit(cut / slices))
    if below == n:
        return kept
    at_cut = df.filter(slice_of == cut).withColumn("_spread", F.col(u) * slices - F.lit(float(cut)))
    ranked = hash_rank(at_cut, "_spread", tie, rank_col="_rank")
    return kept.unionByName(ranked.filter(F.col("_rank") < n - below).drop("_rank", "_spread"))


def running_totals(df: DataFrame, order: str, sums: dict[str, str], groups: list[str] | None = None,
                   descending: bool = False, partitions: int | None = None,
                   following: dict[str, str] | None = None) -> DataFrame:
    """Add ``sums[name]`` = running total of column ``name`` up to and with this row, and
    ``following[name]`` = column ``name`` of the next row (NULL in a group's last row).

    Rows must be unique in (groups, order): collapse equal values first. The range
    partitions are written to the checkpoint folder, so the totals of each partition and
    the rows they are added to come from the same placement, also after a lost executor.
    """
    groups = groups or []
    key = F.desc(order) if descending else F.asc(order)
    # Without a number, adaptive execution may merge small neighbouring ranges.
    ranges = ([partitions] if partitions else []) + [F.asc(g) for g in groups] + [key]
    placed = materialise(df.repartitionByRange(*ranges).withColumn("_part", F.spark_partition_id()))
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    following = following or {}
    first_of = F.max_by if descending else F.min_by  # a partition's first row is the one before's next
    part_sums = placed.groupBy(*groups, "_part").agg(
        *[F.sum(c).alias(c) for c in sums], *[first_of(c, order).alias(f"_first_{c}") for c in following])
    parts = Window.partitionBy(*groups).orderBy("_part")
    offsets = part_sums.select(
        *groups, "_part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_before_{c}") for c in sums],
        *[F.lead(f"_first_{c}").over(parts).alias(f"_next_{c}") for c in following])
    ordered = Window.partitionBy(*groups, "_part").orderBy(key)
    inside = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = [*[f"_before_{c}" for c in sums], *[f"_next_{c}" for c in following]]
    out = _with_offsets(placed, offsets, [*groups, "_part"], added)
    return (out.withColumns({name: F.col(f"_before_{c}") + F.sum(c).over(inside) for c, name in sums.items()}
                            | {name: F.coalesce(F.lead(c).over(ordered), F.col(f"_next_{c}"))
                               for c, name in following.items()})
            .drop("_part", *added))


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                    accuracy: int = 8192) -> dict[str, list[float | None]]:
    """Exact linear-interpolated quantiles of several columns; NULL and NaN are skipped.

    Pass 1 brackets each quantile by sketches with ``accuracy`` values a level, which are merged in
    rounds; their error is proven. Pass 2 counts the different values inside the brackets; all values
    between two brackets collapse to one count in each task. So only about 2 log2(n/accuracy) n/accuracy
    values per quantile are shuffled and sorted, by column.
    """
    values = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in cols])
    merged = merge_sketches(sketch_columns(values, cols, accuracy))
    found: dict[str, dict] = {}
    for r in sketch_brackets(merged, sorted(set(probs))).collect():
        found.setdefault(r["column"], {})[r["prob"]] = r

    ranks: dict[int, list[float]] = {}  # per column with values: the position of each prob
    entries = []
    for i, c in enumerate(cols):
        if c not in found:
            continue
        n = found[c][probs[0]]["n"]
        brackets: list[list[float]] = []
        for p in sorted(probs):
            lo, hi = found[c][p]["low"], found[c][p]["high"]
            if brackets and lo <= brackets[-1][1]:
                brackets[-1][1] = max(hi, brackets[-1][1])
            else:
                brackets.append([lo, hi])
        v = F.col(c)
        part = F.when(v.isNull(), F.lit(None).cast("int"))  # odd: inside a bracket, even: between two
        for b, (lo, hi) in enumerate(brackets):
            part = part.when(v < lo, 2 * b).when(v <= hi, 2 * b + 1)
        part = part.otherwise(2 * len(brackets))
        entries.append(F.struct(F.lit(i).alias("c"), part.alias("part"),
                                F.when(part % 2 == 1, v).alias("v")))
        ranks[i] = [p * (n - 1) for p in probs]
    out: dict[str, list[float | None]] = {c: [None] * len(probs) for c in cols}
    if not ranks:
        return out

    counted = (values.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
               .filter(F.col("part").isNotNull())
               .groupBy("c", "part", "v").agg(F.count(F.lit(1)).alias("n")))
    wanted = F.create_map(*[x for i, positions in ranks.items() for x in (F.lit(i), F.array(*[
        F.lit(k) for k in sorted({math.floor(pos) for pos in positions} | {math.ceil(pos) for pos in positions})]))])
    # Range partitions, not one window per column: no task gets all values of a column.
    ordered = running_totals(counted.withColumn("o", F.struct("part", "v")), "o", {"n": "upto"}, groups=["c"])
    hits = (ordered
            .withColumn("k", F.explode(wanted[F.col("c")]))
            .filter((F.col("k") < F.col("upto")) & (F.col("k") >= F.col("upto") - F.col("n")))
            .select("c", "k", "v").collect())
    at = {(r["c"], r["k"]): r["v"] for r in hits}
    for i, positions in ranks.items():
        for j, pos in enumerate(positions):
            low, high = at.get((i, math.floor(pos))), at.get((i, math.ceil(pos)))
            if low is None or high is None:
                raise RuntimeError(f"quantile bracket of {cols[i]} missed its rank")
            out[cols[i]][j] = low + (high - low) * (pos - math.floor(pos))
    return out
