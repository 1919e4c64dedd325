"""Imputation, capping, logs, assembly and scaling."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohorta.catalog.profiling import mode_sql, rank_checked
from cohorta.catalog.registry import query, rounded, with_views
from cohorta.functions import log1p_columns as add_logs
from cohorta.functions.scalar import vector_has_nan
from cohorta.operators import cleaning
from cohorta.operators.profiling import approx_quantiles

KEYS = ["l_orderkey", "l_linenumber"]


@query("impute_mean", with_views("fx_holes", """
    select l_orderkey, l_linenumber,
           round(coalesce(qty, (select avg(qty) from fx_holes)), 6) as qty,
           round(coalesce(price, (select avg(price) from fx_holes)), 6) as price from fx_holes"""))
def impute_mean(t):
    df = t.fx_holes.select(*KEYS, "qty", "price")
    return rounded(cleaning.mean_imputer(df, ["qty", "price"]).transform(df))


@query("impute_mean_nan", """
    select l_orderkey, l_linenumber,
           round(case when l_linenumber in (3, 4) then (select avg(l_quantity) from lineitem
                                                        where l_linenumber not in (3, 4))
                      else l_quantity end, 6) as qty from lineitem""")
def impute_mean_nan(t):
    df = t.lineitem.select(*KEYS, F.when(F.col("l_linenumber") == 4, F.lit(float("nan")))
                           .when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("qty"))
    return rounded(cleaning.mean_imputer_nan(df, ["qty"]).transform(df))


@query("impute_mode_string", with_views("fx_holes", f"""
    , f as ({mode_sql("flag", "fx_holes")}), s as ({mode_sql("status", "fx_holes")})
    select l_orderkey, l_linenumber, coalesce(flag, (select v from f)) as flag,
           coalesce(status, (select v from s)) as status from fx_holes"""))
def impute_mode_string(t):
    df = t.fx_holes.select(*KEYS, "flag", "status")
    return cleaning.mode_imputer(df, ["flag", "status"]).transform(df)


@query("impute_mode_numeric", with_views("fx_holes", f"""
    , m as ({mode_sql("supp", "fx_holes")})
    select l_orderkey, l_linenumber, coalesce(supp, (select v from m)) as supp from fx_holes"""))
def impute_mode_numeric(t):
    df = t.fx_holes.select(*KEYS, "supp")
    return cleaning.mode_imputer(df, ["supp"]).transform(df)


@query("impute_mode_nan", """
    select l_orderkey, l_linenumber,
           case when l_linenumber in (3, 4)
                then (select l_quantity from lineitem where l_linenumber not in (3, 4)
                      group by l_quantity order by count(*) desc, l_quantity limit 1)
                else l_quantity end as qty from lineitem""")
def impute_mode_nan(t):
    df = t.lineitem.select(*KEYS, F.when(F.col("l_linenumber") == 4, F.lit(float("nan")))
                           .when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("qty"))
    return cleaning.mode_imputer(df, ["qty"]).transform(df)


@query("fill_zero", with_views("fx_holes", """
    select l_orderkey, l_linenumber, round(coalesce(qty, 0), 6) as qty, coalesce(supp, 0) as supp
    from fx_holes"""))
def fill_zero(t):
    df = t.fx_holes.select(*KEYS, "qty", "supp")
    return rounded(cleaning.zero_filler(["qty", "supp"]).transform(df))


@query("iqr_cap", """
    with q as (select quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3 from events),
    f as (select q1 - 1.5e0 * (q3 - q1) as lo, q3 + 1.5e0 * (q3 - q1) as hi from q)
    select event_id, round(case when value < lo then lo when value > hi then hi else value end, 6) as value
    from events, f""")
def iqr_cap(t):
    df = t.events.select("event_id", "value")
    return rounded(cleaning.iqr_capper(df, ["value"], exact=True).transform(df))


@query("iqr_cap_sketch", """
    select 0.25e0 as prob, count(value) as n, true as within, cast(0 as bigint) as outside from events
    union all select 0.75e0, count(value), true, cast(0 as bigint) from events""")
def iqr_cap_sketch(t):
    """Quartiles of a sketch within its rank error, and no value beyond their fences after capping."""
    df = t.events.select("event_id", "value")
    found = approx_quantiles(df, ["value"], [0.25, 0.75]).collect()
    quartiles = {"value": tuple(r["value"] for r in sorted(found, key=lambda r: r["prob"]))}
    (lo, hi), = cleaning.iqr_fences(df, ["value"], quartiles=quartiles).values()
    capped = cleaning.iqr_capper(df, ["value"], quartiles=quartiles).transform(df)
    outside = capped.agg(F.count_if((F.col("value") < lo) | (F.col("value") > hi)).alias("outside"))
    return rank_checked(df, found).select("prob", "n", "within").withColumn("one", F.lit(1)).join(
        outside.withColumn("one", F.lit(1)), "one").drop("one")


@query("log1p_columns", """
    select event_id, round(ln(1 + value), 6) as log_value,
           round(case when value - 60 > -1 then ln(1 + (value - 60)) end, 6) as log_shifted from events""")
def log1p_columns(t):
    df = t.events.select("event_id", "value", (F.col("value") - 60).alias("shifted"))
    return rounded(add_logs(df, ["value", "shifted"]).select("event_id", "log_value", "log_shifted"))


@query("assemble_array", """
    select l_orderkey, l_linenumber, round(l_quantity, 6) as f0, round(l_extendedprice, 6) as f1,
           round(l_discount, 6) as f2 from lineitem""")
def assemble_array(t):
    df = cleaning.assembler(["l_quantity", "l_extendedprice", "l_discount"], "v").transform(t.lineitem)
    array = vector_to_array("v")
    return rounded(df.select(*KEYS, *[array[i].alias(f"f{i}") for i in range(3)]))


@query("standard_scale", """
    with p as (select avg(l_quantity) as m0, stddev_samp(l_quantity) as s0, avg(l_extendedprice) as m1,
                      stddev_samp(l_extendedprice) as s1 from lineitem)
    select l_orderkey, l_linenumber, round((l_quantity - m0) / s0, 6) as f0,
           round((l_extendedprice - m1) / s1, 6) as f1, 0e0 as f2 from lineitem, p""")
def standard_scale(t):
    df = t.lineitem.select(*KEYS, "l_quantity", "l_extendedprice", F.lit(5.0).alias("five"))
    scaled = cleaning.fit_scaling(df, ["l_quantity", "l_extendedprice", "five"], "z").transform(df)
    array = vector_to_array("z")
    return rounded(scaled.select(*KEYS, *[array[i].alias(f"f{i}") for i in range(3)]))


@query("gate_vectors", with_views("fx_holes", """
    select 'filled' as gate, true as passed, count(*) as "rows" from fx_holes
    union all select 'with holes', false, count(*) from fx_holes where qty is null or price is null
    union all select 'no rows', false, 0::bigint"""))
def gate_vectors(t):
    """The gates before scaling: vectors without NaN pass and are counted; NaN and no rows halt."""
    assemble = cleaning.assembler(["qty", "price"], "v", on_invalid="keep")
    whole = assemble.transform(t.fx_holes)
    out = [("filled", True, cleaning.check_vectors(assemble.transform(cleaning.zero_filler(["qty", "price"]).transform(t.fx_holes)), "v"))]
    for name, df in (("with holes", whole), ("no rows", whole.filter(F.col("v").isNull()))):
        try:
            out.append((name, True, cleaning.check_vectors(df, "v")))
        except cleaning.QualityGateError:
            out.append((name, False, df.filter(F.col("v").isNotNull() & vector_has_nan("v")).count()))
    return t.spark.createDataFrame(out, "gate string, passed boolean, rows long")


@query("log1p_if_absent", """
    select event_id, round(ln(1 + value), 6) as log_value, round(value / 7, 6) as log_known from events""")
def log1p_if_absent(t):
    """A log column that is there already stays as it is."""
    df = t.events.select("event_id", "value", (F.col("value") * 2).alias("known"), (F.col("value") / 7).alias("log_known"))
    return rounded(add_logs(add_logs(df, ["value", "known"]), ["value"]).select("event_id", "log_value", "log_known"))
