"""The tables behind the plots."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohorta.catalog.registry import query, rounded
from cohorta.operators import exploration as ex


def rule_sql(cols: list[str], source: str, most: int = ex.MOST_BINS) -> str:
    """CTE ``rule``: low, width and bins per column; too many bins are merged by powers of two."""
    return "rule as (" + " union all ".join(f"""
        select '{c}' as "column", lo, w * merged as w, ceil(bins / merged) as bins
        from (select lo, bins, case when span = 0 then 1e0 else span / bins end as w,
                     case when bins > {most} then pow(2, ceil(log2(bins / {most}e0))) else 1 end as merged
              from (select *, case when span = 0 then 1 else ceil(span / case when fd > 0 and fd < st then fd else st end) end as bins
                    from (select min({c}) as lo, max({c}) - min({c}) as span,
                                 (max({c}) - min({c})) / (log2(count({c})) + 1) as st,
                                 2 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) / pow(count({c}), 1e0 / 3) as fd
                          from {source}) a) b) d""" for c in cols) + ")"


def long_sql(cols: list[str], source: str) -> str:
    return " union all ".join(f'select \'{c}\' as "column", cast({c} as double) as "value" from {source}'
                              for c in cols)


_LINE = ["l_quantity", "l_extendedprice", "l_discount"]


def histogram_sql(cols, source):
    return f"""
    with {rule_sql(cols, source)}, vals as ({long_sql(cols, source)}),
    placed as (select v."column", lo, w, cast(least(floor(("value" - lo) / w), bins - 1) as integer) as bin
               from vals v join rule r on v."column" = r."column")
    select "column", bin, round(min(lo) + bin * min(w), 6) as low, round(min(lo) + (bin + 1) * min(w), 6) as high,
           count(*) as n from placed group by "column", bin"""


@query("histogram", histogram_sql(["value"], "events"))
def histogram(t):
    return rounded(ex.histogram(t.events, ["value"]))


@query("histogram_lines", histogram_sql(_LINE, "lineitem"))
def histogram_lines(t):
    return rounded(ex.histogram(t.lineitem, _LINE))


@query("kde", """
    with p as (select min(value) as lo, (max(value) - min(value)) / 199e0 as st,
                      stddev_samp(value) * pow(count(value), -0.2e0) as h, cast(count(value) as double) as n from events),
    weighted as (select value, count(*) as w from events group by value),
    grid as (select unnest(range(0, 200)) as point)
    select 'value' as "column", cast(point as integer) as point, round(min(lo + point * st), 6) as x,
           round(sum(w * exp(-0.5e0 * pow((value - (lo + point * st)) / h, 2))
                     / (n * h * sqrt(2 * pi()))), 6) as density
    from weighted, p, grid group by point""")
def kde(t):
    return rounded(ex.density(t.events, ["value"]))


_HEAVY = "(select exp(l_quantity) as heavy, l_extendedprice as price from lineitem) h"


@query("histogram_merged", histogram_sql(["heavy"], _HEAVY).replace("round(min(lo)", "round(1e-12 * (min(lo)")
       .replace("* min(w), 6)", "* min(w)), 6)"))
def histogram_merged(t):
    """A column with a far outlier: a thousand bins hold every row, where the rule asks for millions."""
    heavy = ex.histogram(t.lineitem.select(F.exp("l_quantity").alias("heavy")), ["heavy"])
    return rounded(heavy.withColumns({c: 1e-12 * F.col(c) for c in ("low", "high")}))


@query("pair_density_merged", f"""
    with {rule_sql(["heavy", "price"], _HEAVY, ex.MOST_PAIR_BINS)},
    a as (select * from rule where "column" = 'heavy'), b as (select * from rule where "column" = 'price')
    select 'heavy' as x, 'price' as y, cast(least(floor((heavy - a.lo) / a.w), a.bins - 1) as integer) as x_bin,
           cast(least(floor((price - b.lo) / b.w), b.bins - 1) as integer) as y_bin, count(*) as n
    from {_HEAVY}, a, b group by 1, 2, 3, 4""")
def pair_density_merged(t):
    return ex.pair_density(t.lineitem.select(F.exp("l_quantity").alias("heavy"), F.col("l_extendedprice").alias("price")),
                           ["heavy", "price"])


def _box(c, source):
    return f"""
    select '{c}' as "column", round(min(q1), 6) as q1, round(min(q2), 6) as median, round(min(q3), 6) as q3,
           round(min(case when {c} >= q1 - 1.5e0 * (q3 - q1) then {c} end), 6) as low_whisker,
           round(max(case when {c} <= q3 + 1.5e0 * (q3 - q1) then {c} end), 6) as high_whisker,
           count(case when {c} < q1 - 1.5e0 * (q3 - q1) or {c} > q3 + 1.5e0 * (q3 - q1) then 1 end) as outliers
    from {source}, (select quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.5) as q2,
                           quantile_cont({c}, 0.75) as q3 from {source}) q"""


@query("boxplot_stats", _box("value", "events"))
def boxplot_stats(t):
    return rounded(ex.boxplot_stats(t.events, ["value"]))


@query("boxplot_lines", " union all ".join(_box(c, "lineitem") for c in _LINE))
def boxplot_lines(t):
    return rounded(ex.boxplot_stats(t.lineitem, _LINE))


@query("pair_density", f"""
    with {rule_sql(["l_quantity", "l_extendedprice"], "lineitem", ex.MOST_PAIR_BINS)},
    a as (select * from rule where "column" = 'l_quantity'), b as (select * from rule where "column" = 'l_extendedprice')
    select 'l_quantity' as x, 'l_extendedprice' as y,
           cast(least(floor((l_quantity - a.lo) / a.w), a.bins - 1) as integer) as x_bin,
           cast(least(floor((l_extendedprice - b.lo) / b.w), b.bins - 1) as integer) as y_bin, count(*) as n
    from lineitem, a, b group by 1, 2, 3, 4""")
def pair_density(t):
    return ex.pair_density(t.lineitem, ["l_quantity", "l_extendedprice"])
