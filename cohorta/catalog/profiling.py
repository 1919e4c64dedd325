"""Column profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohorta.catalog.registry import query, rounded, with_views
from cohorta.operators import cleaning, profiling as prof, sketches
from cohorta.operators.ranking import exact_quantiles
from cohorta.session import scratch_path

HOLES = ["qty", "price", "supp", "flag", "status"]
NUMBERS = ["l_quantity", "l_extendedprice", "l_discount"]


def per_column(cols, select, source, key="column"):
    """UNION ALL of one select per column; ``{c}`` stands for the column."""
    return " union all ".join(
        f'select \'{c}\' as "{key}", {select.format(c=c)} from {source}' for c in cols)


@query("null_counts", with_views("fx_holes", per_column(
    HOLES, "count({c}) as present, count(*) - count({c}) as nulls, cast(0 as bigint) as nans", "fx_holes")))
def null_counts(t):
    return prof.null_counts(t.fx_holes, HOLES)


@query("column_profile", per_column(
    NUMBERS, "count({c}) as n, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std, "
    "round(min({c}), 6) as min, round(max({c}), 6) as max", "lineitem"))
def column_profile(t):
    return rounded(prof.column_profile(t.lineitem, NUMBERS))


_G1 = ("round((sum(pow({c} - m, 3)) / count(*)) / pow(sum(pow({c} - m, 2)) / count(*), 1.5e0), 6) as skew")


@query("skewness_population", " union all ".join(
    f"select '{c}' as \"column\", {_G1.format(c=c)} from {t}, (select avg({c}) as m from {t}) mean_of"
    for c, t in (("value", "events"),)) + " union all " + " union all ".join(
    f"select '{c}' as \"column\", {_G1.format(c=c)} from lineitem, (select avg({c}) as m from lineitem) mean_of"
    for c in NUMBERS))
def skewness_population(t):
    return rounded(prof.skewness_population(t.events, ["value"])
                   .unionByName(prof.skewness_population(t.lineitem, NUMBERS)))


@query("skewness_sample", per_column(["value"], "round(skewness({c}), 6) as skew", "events")
       + " union all " + per_column(NUMBERS, "round(skewness({c}), 6) as skew", "lineitem"))
def skewness_sample(t):
    return rounded(prof.skewness_sample(t.events, ["value"])
                   .unionByName(prof.skewness_sample(t.lineitem, NUMBERS)))


PROBS = [0.05, 0.25, 0.5, 0.75, 0.95]
_QUANTILES = " union all ".join(
    per_column([c], f"cast({p} as double) as prob, round(quantile_cont({{c}}, {p}), 6) as value", source)
    for source, cols in (("lineitem", NUMBERS), ("events", ["value"])) for c in cols for p in PROBS)


@query("quantiles_exact", _QUANTILES)
def quantiles_exact(t):
    found = {**exact_quantiles(t.lineitem, NUMBERS, PROBS), **exact_quantiles(t.events, ["value"], PROBS)}
    rows = [(c, p, v) for c, values in found.items() for p, v in zip(PROBS, values)]
    return rounded(t.spark.createDataFrame(rows, "column string, prob double, value double"))


def rank_checked(df, found):
    """column, prob, n and whether a value's rank is as near to prob n as the sketch says."""
    tests = [F.struct(F.lit(r["column"]).alias("column"), F.lit(r["prob"]).alias("prob"), F.lit(r["n"]).alias("n"), (
        (F.count_if(F.col(r["column"]) < r["value"]) - r["rank_error"] <= r["prob"] * r["n"])
        & (F.count_if(F.col(r["column"]) <= r["value"]) + r["rank_error"] >= r["prob"] * r["n"])).alias("within"))
        for r in found]
    return df.agg(F.array(*tests).alias("t")).select(F.explode("t").alias("t")).select("t.*")


@query("quantiles_approx", " union all ".join(
    per_column([c], f"cast({p} as double) as prob, count({{c}}) as n, true as within", "lineitem")
    for c in NUMBERS for p in PROBS))
def quantiles_approx(t):
    """Sketches of the two halves of the lines are stored apart, merged from the files and asked."""
    path = scratch_path(t.spark, "sketches")
    for half in ("l_linenumber <= 3", "l_linenumber > 3"):
        sketches.sketch_columns(t.lineitem.filter(half), NUMBERS, size=256).write.mode("append").parquet(path)
    merged = sketches.merge_sketches(t.spark.read.parquet(path))
    return rank_checked(t.lineitem, sketches.sketch_quantiles(merged, PROBS).collect())


@query("distinct_profile", with_views("fx_holes", per_column(
    HOLES, "count(distinct {c}) + max(case when {c} is null then 1 else 0 end) as distinct_values", "fx_holes")))
def distinct_profile(t):
    return prof.distinct_profile(t.fx_holes, HOLES)


@query("distinct_values", """
    select distinct 'o_orderpriority' as "column", o_orderpriority as "value" from orders
    union all select distinct 'o_orderstatus', o_orderstatus from orders""")
def distinct_values(t):
    return prof.distinct_values(t.orders, ["o_orderpriority", "o_orderstatus"])


def mode_sql(col, source, where="true"):
    return (f"select {col} as v, count(*) as n from {source} where {col} is not null and {where} "
            f"group by {col} order by n desc, v limit 1")


@query("column_mode", with_views("fx_holes", " union all ".join(
    f"select '{c}' as \"column\", cast(v as varchar) as \"value\", n from ({mode_sql(c, 'fx_holes')}) m_{c}"
    for c in ("supp", "flag", "status"))))
def column_mode(t):
    return prof.column_mode(t.fx_holes, ["supp", "flag", "status"])


_KINDS = [("l_linenumber", "numeric"), ("qty", "numeric"), ("price", "numeric"), ("supp", "numeric"),
          ("flag", "categorical"), ("status", "categorical")]


@query("column_kinds", with_views("fx_holes", " union all ".join(
    f"select '{c}' as \"column\", '{k}' as kind, count({c}) as present from fx_holes" for c, k in _KINDS)))
def column_kinds(t):
    df = t.fx_holes
    kinds = prof.column_kinds(df, ids=["l_orderkey"])
    picked = t.spark.createDataFrame(list(kinds.items()), "column string, kind string")
    return picked.join(prof.null_counts(df, list(kinds)), "column").select("column", "kind", "present")


_CLASSES = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("column_cardinality_class", with_views("fx_predictions", f"""
    , sizes as ({per_column(_CLASSES, "count(distinct {c}) as d", "lineitem")}
                union all {per_column(["actual", "prediction", "probability"], "count(distinct {c}) as d", "fx_predictions")})
    select "column", case when d = 2 then 'binary' when d <= 10 then 'categorical_numeric'
                          else 'continuous' end as kind from sizes
    union all select 'l_returnflag', 'categorical'"""))
def column_cardinality_class(t):
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return (prof.cardinality_classes(t.lineitem, keys[:3], ["l_returnflag"])
            .unionByName(prof.cardinality_classes(t.fx_predictions, keys)))


def _pairs(cols, source, where=""):
    return " union all ".join(
        f"select '{x}' as x, '{y}' as y, round(corr({x}, {y}), 6) as r from {source} {where}"
        for x in cols for y in cols)


@query("correlation_matrix", with_views("fx_holes", _pairs(["qty", "price", "supp"], "fx_holes")))
def correlation_matrix(t):
    return rounded(prof.correlation_matrix(t.fx_holes, ["qty", "price", "supp"]))


@query("correlation_wide", """
    with waves as (select c_custkey, k, case when c_nationkey = k % 25 then null else cos(k * c_acctbal / 1000e0) end as v
                   from customer, (select unnest(range(1, 201)) as k) r)
    select 'w' || a.k as x, 'w' || b.k as y, round(corr(a.v, b.v), 6) as r
    from waves a join waves b on a.c_custkey = b.c_custkey group by a.k, b.k""")
def correlation_wide(t):
    """200 derived columns with holes: 40,000 cells out of blocks of sums."""
    waves = [F.when(F.col("c_nationkey") != k % 25, F.cos(k * F.col("c_acctbal") / 1000.0)).alias(f"w{k}")
             for k in range(1, 201)]
    return rounded(prof.correlation_matrix(t.customer.select(*waves), [f"w{k}" for k in range(1, 201)]))


@query("correlation_complete", with_views("fx_holes", _pairs(
    ["qty", "price", "supp"], "fx_holes",
    "where qty is not null and price is not null and supp is not null")))
def correlation_complete(t):
    cols = ["qty", "price", "supp"]
    r = prof.complete_correlation(t.fx_holes, cols)
    cells = [(x, y, float(r[i, j])) for i, x in enumerate(cols) for j, y in enumerate(cols)]
    return rounded(t.spark.createDataFrame(cells, "x string, y string, r double"))


@query("vif", """
    with r as (select corr(l_quantity, l_extendedprice) as a, corr(l_quantity, l_discount) as b,
                      corr(l_extendedprice, l_discount) as c from lineitem),
    v as (select 'l_quantity' as feature, (1 - c * c) / (1 + 2 * a * b * c - a * a - b * b - c * c) as vif from r
          union all select 'l_extendedprice', (1 - b * b) / (1 + 2 * a * b * c - a * a - b * b - c * c) from r
          union all select 'l_discount', (1 - a * a) / (1 + 2 * a * b * c - a * a - b * b - c * c) from r)
    select feature, round(1 - 1 / vif, 6) as r2, round(vif, 6) as vif from v""")
def vif(t):
    return rounded(prof.vif(t.lineitem, NUMBERS))


@query("nan_vector_count", with_views("fx_holes", """
    select count(*) as n from fx_holes where qty is null or price is null"""))
def nan_vector_count(t):
    vectors = cleaning.assembler(["qty", "price"], "v", on_invalid="keep").transform(t.fx_holes)
    return t.spark.createDataFrame([(prof.nan_vector_count(vectors, "v"),)], "n long")
