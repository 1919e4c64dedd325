"""Draws, samples, synthesis, SMOTE, splits and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohorta.catalog.registry import query, rounded, with_views
from cohorta.functions import hash_normal as normal, hash_uniform as uniform
from cohorta.operators import neighbours, sampling

FEATURES = ["x1", "x2", "x3"]


def u_sql(key: str, stream: str = "") -> str:
    prefix = f"42:{stream}:" if stream else "42:"
    return (f"(cast(('0x' || substr(md5('{prefix}' || {key}), 1, 13)) as ubigint)::double"
            f" / 4503599627370496e0)")


def normal_sql(key: str, stream: str) -> str:
    return (f"(sqrt(-2e0 * ln({u_sql(key, stream + ':u')} + 1.1102230246251565e-16))"
            f" * cos(2e0 * pi() * {u_sql(key, stream + ':v')}))")


@query("hash_uniform", f"select o_orderkey, round({u_sql('o_orderkey')}, 9) as u from orders")
def hash_uniform(t):
    return t.orders.select("o_orderkey", F.round(uniform("o_orderkey"), 9).alias("u"))


@query("hash_normal", f"select o_orderkey, round({normal_sql('o_orderkey', 'z')}, 6) as z from orders")
def hash_normal(t):
    return t.orders.select("o_orderkey", F.round(normal("o_orderkey", stream="z"), 6).alias("z"))


@query("sample_n", f"""
    select o_orderkey, o_custkey, o_orderpriority from orders
    order by {u_sql('o_orderkey')}, o_orderkey limit 2500""")
def sample_n(t):
    return sampling.sample_rows(t.orders, 2500, ["o_orderkey"]).select("o_orderkey", "o_custkey", "o_orderpriority")


@query("sample_two_thirds", f"""
    select o_orderkey, o_custkey from orders order by {u_sql('o_orderkey')}, o_orderkey
    limit (select (2 * count(*)) // 3 from orders)""")
def sample_two_thirds(t):
    from cohorta.operators.ranking import take_by_hash
    n = 2 * t.orders.count() // 3
    drawn = t.orders.select("o_orderkey", "o_custkey").withColumn("u", uniform("o_orderkey"))
    return take_by_hash(drawn, n, "u", ["o_orderkey"], small=1).drop("u")


@query("upsample_n", f"""
    with n as (select 7 * count(*) // 3 as n from customer),
    copies as (select c_custkey, c_nationkey, copy_no
               from customer, (select unnest([0, 1, 2]) as copy_no) c)
    select c_custkey, c_nationkey, copy_no from copies
    order by {u_sql("c_custkey || ':' || copy_no")}, c_custkey, copy_no limit (select n from n)""")
def upsample_n(t):
    n = 7 * t.customer.count() // 3
    return (sampling.upsample_rows(t.customer, n, ["c_custkey"])
            .select("c_custkey", "c_nationkey", "copy_no"))


_NUMBERED = ("select v, row_number() over (order by v) - 1 as i, count(*) over () as k "
             "from (select distinct {c} as v from orders where {c} is not null) d")


@query("synth_parametric", f"""
    with ids as (select row_number() over () - 1 as id from orders),
    m as (select avg(o_custkey) as mc, stddev_samp(o_custkey) as sc, avg(o_totalprice) as mp,
                 stddev_samp(o_totalprice) as sp from orders),
    p as ({_NUMBERED.format(c="o_orderpriority")}), s as ({_NUMBERED.format(c="o_orderstatus")})
    select id as row_no, round(mc + sc * {normal_sql('id', 'o_custkey')}, 4) as o_custkey,
           round(mp + sp * {normal_sql('id', 'o_totalprice')}, 4) as o_totalprice,
           p.v as o_orderpriority, s.v as o_orderstatus,
           case when id < (select count(*) // 2 from orders) then 1 else 0 end as hospital_expire_flag
    from ids, m, p, s
    where p.i = cast(floor({u_sql('id', 'o_orderpriority')} * p.k) as bigint)
      and s.i = cast(floor({u_sql('id', 'o_orderstatus')} * s.k) as bigint)""")
def synth_parametric(t):
    df = t.orders.select("o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    return rounded(sampling.synthesise(df, df.count()), 4)


@query("synth_label_split", """
    with ids as (select row_number() over () - 1 as id from customer)
    select case when id < (select count(*) // 2 from customer) then 1 else 0 end as hospital_expire_flag,
           count(*) as n from ids group by 1""")
def synth_label_split(t):
    synthetic = sampling.synthesise(t.customer.select("c_acctbal"), t.customer.count())
    return synthetic.groupBy("hospital_expire_flag").agg(F.count(F.lit(1)).alias("n"))


_NEIGHBOURS = """
    , members as (select * from fx_labelled where label = 0),
    pairs as (select a.doc_id, b.doc_id as nn_id,
                     (a.x1 - b.x1) * (a.x1 - b.x1) + (a.x2 - b.x2) * (a.x2 - b.x2)
                     + (a.x3 - b.x3) * (a.x3 - b.x3) as d2
              from members a join members b on a.doc_id <> b.doc_id),
    near as (select doc_id, nn_id, d2,
                    row_number() over (partition by doc_id order by d2, nn_id) as nn_rank from pairs)"""


@query("smote_neighbors", with_views("fx_labelled", f"""{_NEIGHBOURS}
    select doc_id, cast(nn_rank as integer) as nn_rank, nn_id, round(d2, 6) as d2 from near where nn_rank <= 5"""))
def smote_neighbors(t):
    return rounded(neighbours.nearest_neighbours(
        t.fx_labelled.filter("label = 0"), "doc_id", FEATURES, k=5))


# Eight measures of a document: how often each of these characters occurs in its text.
_LETTERS = [" ", ".", ",", "e", "a", "t", "o", "1"]
_WIDE_VIEW = "select doc_id, " + ", ".join(
    f"cast(length(coalesce(text, '')) - length(replace(coalesce(text, ''), '{c}', '')) as double) as w{j}"
    for j, c in enumerate(_LETTERS)) + " from documents"


@query("smote_neighbors_cells", f"""
    with points as ({_WIDE_VIEW}),
    pairs as (select a.doc_id, b.doc_id as nn_id, {" + ".join(f"(a.w{j} - b.w{j}) * (a.w{j} - b.w{j})" for j in range(8))} as d2
              from points a join points b on a.doc_id <> b.doc_id),
    near as (select doc_id, nn_id, d2, row_number() over (partition by doc_id order by d2, nn_id) as nn_rank from pairs)
    select doc_id, cast(nn_rank as integer) as nn_rank, nn_id, round(d2, 6) as d2 from near where nn_rank <= 5""")
def smote_neighbors_cells(t):
    """All documents, in cells of a few dozen."""
    return rounded(neighbours.nearest_neighbours(t.sql(_WIDE_VIEW), "doc_id", [f"w{j}" for j in range(8)], k=5, cell_rows=32))


@query("smote_rows", with_views("fx_labelled", f"""{_NEIGHBOURS},
    ranked as (select *, row_number() over (order by {u_sql('doc_id', 'order')}, doc_id) - 1 as pos,
                      count(*) over () as m from members),
    big as (select max(n) as n from (select count(*) as n from fx_labelled group by label) g),
    draws as (select row_number() over () - 1 as j from fx_labelled),
    based as (select j, b.* from draws join ranked b on b.pos = cast(floor({u_sql('j', 'base')} * b.m) as bigint)
              where j < (select n from big) - b.m)
    select j as draw, b.doc_id as base, n.nn_id as neighbour,
           round(b.x1 + {u_sql('j', 'step')} * (c.x1 - b.x1), 6) as x1,
           round(b.x2 + {u_sql('j', 'step')} * (c.x2 - b.x2), 6) as x2,
           round(b.x3 + {u_sql('j', 'step')} * (c.x3 - b.x3), 6) as x3
    from based b join near n on n.doc_id = b.doc_id
         and n.nn_rank = 1 + cast(floor({u_sql('j', 'nn')} * 5) as bigint)
    join members c on c.doc_id = n.nn_id"""))
def smote_rows(t):
    return rounded(sampling.smote_rows(t.fx_labelled, FEATURES, "label", "doc_id", 0))


@query("smote_balance", with_views("fx_labelled", """
    , big as (select max(n) as n from (select count(*) as n from fx_labelled group by label) g)
    select label, 0 as synthetic, count(*) as n from fx_labelled group by label
    union all
    select label, 1, (select n from big) - count(*) from fx_labelled group by label
    having count(*) < (select n from big)"""))
def smote_balance(t):
    balanced = sampling.smote(t.fx_labelled, FEATURES, "label", "doc_id")
    return balanced.groupBy("label", "synthetic").agg(F.count(F.lit(1)).alias("n"))


@query("split_train_test", f"""
    select o_orderkey, {u_sql('o_orderkey', 'split')} < 0.3e0 as is_test from orders""")
def split_train_test(t):
    return sampling.split_flag(t.orders, 0.3, ["o_orderkey"]).select("o_orderkey", "is_test")


@query("split_exact", f"""
    select o_orderkey, row_number() over (order by {u_sql('o_orderkey', 'split')}, o_orderkey)
           <= (select ceil(0.2e0 * count(*)) from orders) as is_test from orders""")
def split_exact(t):
    return sampling.split_flag(t.orders, 0.2, ["o_orderkey"], exact=True).select("o_orderkey", "is_test")


@query("kfold_assign", with_views("fx_admissions", f"""
    select hadm_id, cast((row_number() over (partition by hospital_expire_flag
           order by {u_sql('hadm_id', 'fold')}, hadm_id) - 1) % 5 as integer) as fold from fx_admissions"""))
def kfold_assign(t):
    return (sampling.stratified_folds(t.fx_admissions, 5, "hospital_expire_flag", ["hadm_id"])
            .select("hadm_id", "fold"))
