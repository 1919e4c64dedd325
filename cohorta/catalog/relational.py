"""Scans, sinks, filters, joins and grouped aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohorta.catalog.registry import Tables, query, rounded, with_views
from cohorta.operators import relational as rel
from cohorta.session import scratch_path
from cohorta.sources import schemas, tables as src

# In the order tables supplier numbers 1-5 stand for the five vital sign items.
VITALS = [1, 2, 3, 4, 5]

_AGE_SQL = """
    case when day(admittime) = day(dob)
           or (last_day(admittime) = date_trunc('day', admittime) and last_day(dob) = date_trunc('day', dob))
         then cast(((year(admittime) - year(dob)) * 12 + month(admittime) - month(dob)) as double)
         else round((year(admittime) - year(dob)) * 12 + month(admittime) - month(dob)
              + ((day(admittime) - day(dob)) * 86400
                 + floor(epoch(admittime) - epoch(date_trunc('day', admittime)))
                 - floor(epoch(dob) - epoch(date_trunc('day', dob)))) / 2678400e0, 8)
    end"""

_CORE_SQL = f"""
    select a.subject_id, a.hadm_id, i.icustay_id, a.admission_type, a.hospital_expire_flag,
           p.gender, i.los, round({_AGE_SQL} / 12e0, 2) as age
    from fx_admissions a join fx_patients p on a.subject_id = p.subject_id
    join fx_icustays i on a.subject_id = i.subject_id and a.hadm_id = i.hadm_id"""

_VITALS_SQL = """
    select subject_id, hadm_id, icustay_id, avg(valuenum) as mean_vitals,
           min(valuenum) as min_vitals, max(valuenum) as max_vitals
    from fx_chartevents where itemid in (1, 2, 3, 4, 5) group by subject_id, hadm_id, icustay_id"""

_TOP_SQL = "select itemid, count(*) as n from fx_labevents group by itemid order by n desc, itemid limit 5"

_LABS_SQL = f"""
    select subject_id, hadm_id, avg(valuenum) as mean_labs, min(valuenum) as min_labs,
           max(valuenum) as max_labs
    from fx_labevents where itemid in (select itemid from ({_TOP_SQL}) top)
    group by subject_id, hadm_id"""

_CODES_SQL = """
    select subject_id, hadm_id, count(distinct icd9_code) as num_comorbidities
    from fx_diagnoses group by subject_id, hadm_id"""

FEATURE_VIEWS = "fx_patients fx_admissions fx_icustays fx_chartevents fx_labevents fx_diagnoses"
FEATURE_SQL = f"""
    select c.*, v.mean_vitals, v.min_vitals, v.max_vitals, l.mean_labs, l.min_labs, l.max_labs,
           d.num_comorbidities
    from ({_CORE_SQL}) c
    left join ({_VITALS_SQL}) v on c.subject_id = v.subject_id and c.hadm_id = v.hadm_id
          and c.icustay_id = v.icustay_id
    left join ({_LABS_SQL}) l on c.subject_id = l.subject_id and c.hadm_id = l.hadm_id
    left join ({_CODES_SQL}) d on c.subject_id = d.subject_id and c.hadm_id = d.hadm_id"""


def core(t: Tables):
    return (rel.merge_core(t.fx_admissions, t.fx_patients, t.fx_icustays)
            .drop("balance", "admittime", "dob"))


def features(t: Tables):
    """The feature table of the order tables, used by many queries."""
    return rel.feature_table(
        t.fx_admissions, t.fx_patients, t.fx_icustays, t.fx_chartevents, t.fx_labevents,
        t.fx_diagnoses, vital_items=VITALS).drop("balance", "admittime", "dob")


def features_sql(body: str, extra: str = "") -> str:
    """SQL over the feature table as CTE ``ft``; ``extra`` holds more CTEs."""
    return with_views(FEATURE_VIEWS, f", ft as ({FEATURE_SQL}) {extra} {body}")


@query("feature_table", with_views(FEATURE_VIEWS, f"""
    select subject_id, hadm_id, icustay_id, admission_type, hospital_expire_flag, gender,
           round(los, 6) as los, round(age, 6) as age, round(mean_vitals, 6) as mean_vitals,
           round(min_vitals, 6) as min_vitals, round(max_vitals, 6) as max_vitals,
           round(mean_labs, 6) as mean_labs, round(min_labs, 6) as min_labs,
           round(max_labs, 6) as max_labs, num_comorbidities
    from ({FEATURE_SQL}) f"""))
def feature_table(t):
    return rounded(features(t))


@query("core_merge", with_views("fx_patients fx_admissions fx_icustays", f"""
    select subject_id, hadm_id, icustay_id, admission_type, hospital_expire_flag, gender,
           round(los, 6) as los, round(age, 6) as age from ({_CORE_SQL}) c"""))
def core_merge(t):
    return rounded(core(t))


@query("join_inner_single", with_views("fx_admissions fx_patients", """
    select a.subject_id, a.hadm_id, a.admission_type, a.hospital_expire_flag, p.gender,
           round(p.balance, 6) as balance
    from fx_admissions a join fx_patients p on a.subject_id = p.subject_id"""))
def join_inner_single(t):
    return rounded(t.fx_admissions.join(t.fx_patients, "subject_id").drop("admittime", "dob"))


@query("vitals_by_stay", with_views("fx_chartevents", f"""
    select subject_id, hadm_id, icustay_id, round(mean_vitals, 6) as mean_vitals,
           round(min_vitals, 6) as min_vitals, round(max_vitals, 6) as max_vitals
    from ({_VITALS_SQL}) v"""))
def vitals_by_stay(t):
    return rounded(rel.vitals_by_stay(t.fx_chartevents, VITALS))


@query("labs_by_admission", with_views("fx_labevents", f"""
    select subject_id, hadm_id, round(mean_labs, 6) as mean_labs, round(min_labs, 6) as min_labs,
           round(max_labs, 6) as max_labs from ({_LABS_SQL}) l"""))
def labs_by_admission(t):
    return rounded(rel.labs_by_admission(t.fx_labevents))


@query("comorbidity_count", with_views("fx_diagnoses", _CODES_SQL))
def comorbidity_count(t):
    return rel.comorbidity_count(t.fx_diagnoses)


@query("topk_items", with_views("fx_labevents", f"select itemid, n from ({_TOP_SQL}) top"))
def topk_items(t):
    return rel.top_items(t.fx_labevents).withColumnRenamed("count", "n")


@query("topk_semi", with_views("fx_labevents", f"""
    select subject_id, hadm_id, itemid, round(valuenum, 6) as valuenum from fx_labevents
    where itemid in (select itemid from ({_TOP_SQL}) top)"""))
def topk_semi(t):
    return rounded(rel.keep_top_items(t.fx_labevents))


@query("lookup_left", with_views("fx_diagnoses fx_codes", """
    select d.subject_id, d.hadm_id, d.icd9_code, c.title
    from fx_diagnoses d left join fx_codes c on d.icd9_code = c.icd9_code"""))
def lookup_left(t):
    return rel.code_lookup(t.fx_diagnoses, t.fx_codes)


@query("filter_isin", with_views("fx_chartevents", """
    select subject_id, hadm_id, icustay_id, itemid, round(valuenum, 6) as valuenum
    from fx_chartevents where itemid in (1, 2, 3, 4, 5)"""))
def filter_isin(t):
    return rounded(rel.filter_isin(t.fx_chartevents, "itemid", VITALS))


@query("filter_not_null", with_views("fx_labevents", """
    select subject_id, hadm_id, itemid, round(valuenum, 6) as valuenum
    from fx_labevents where valuenum is not null"""))
def filter_not_null(t):
    return rounded(rel.filter_not_null(t.fx_labevents, "valuenum"))


@query("cast_double", """
    select cast(o_orderkey as double) as o_orderkey, cast(o_custkey as double) as o_custkey
    from orders""")
def cast_double(t):
    return rel.cast_double(t.orders, ["o_orderkey", "o_custkey"]).select("o_orderkey", "o_custkey")


@query("na_drop_subset", with_views("fx_holes", """
    select l_orderkey, l_linenumber, round(qty, 6) as qty, round(price, 6) as price
    from fx_holes where qty is not null and price is not null"""))
def na_drop_subset(t):
    return rounded(rel.drop_incomplete(t.fx_holes, ["qty", "price"])
                   .select("l_orderkey", "l_linenumber", "qty", "price"))


@query("threshold_score", """
    select l_orderkey, l_linenumber, case when l_quantity / 51e0 >= 0.5e0 then 1 else 0 end as predicted
    from lineitem""")
def threshold_score(t):
    from cohorta.functions import threshold_score as cut
    return t.lineitem.select("l_orderkey", "l_linenumber",
                             cut(F.col("l_quantity") / 51.0).alias("predicted"))


@query("age_years", with_views("fx_patients", f"""
    , visits as (select o_orderkey as hadm_id, o_orderdate as admittime, dob
                 from orders join fx_patients on o_custkey = subject_id
                 union all
                 select event_id as hadm_id, ts as admittime, timestamp '1950-01-31 13:14:15' as dob from events)
    select hadm_id, round({_AGE_SQL} / 12e0, 2) as age from visits"""))
def age_years(t):
    from cohorta.functions import age_years as age
    orders = (t.orders.join(t.fx_patients, F.col("o_custkey") == F.col("subject_id"))
              .select(F.col("o_orderkey").alias("hadm_id"), age("o_orderdate", "dob").alias("age")))
    events = t.events.select(
        F.col("event_id").alias("hadm_id"),
        age("ts", F.lit("1950-01-31 13:14:15").cast("timestamp_ntz")).alias("age"))
    return orders.unionByName(events)


@query("category_counts", """
    select o_orderpriority, count(*) as n from orders group by o_orderpriority""")
def category_counts(t):
    return rel.category_counts(t.orders, "o_orderpriority").withColumnRenamed("count", "n")


@query("value_counts", with_views("fx_holes", """
    select 'flag' as "column", flag as "value", count(*) as n from fx_holes group by flag
    union all select 'status', status, count(*) from fx_holes group by status
    union all select 'supp', cast(supp as varchar), count(*) from fx_holes group by supp"""))
def value_counts(t):
    return rel.value_counts(t.fx_holes, ["flag", "status", "supp"]).withColumnRenamed("count", "n")


@query("kpi_by_label", features_sql("""
    select hospital_expire_flag, round(avg(age), 6) as avg_age, round(avg(los), 6) as avg_los,
           round(avg(mean_vitals), 4) as avg_vitals, round(avg(num_comorbidities), 6) as avg_comorbidities
    from ft group by hospital_expire_flag"""))
def kpi_by_label(t):
    return rounded(rel.kpi_by_label(features(t))).withColumn("avg_vitals", F.round("avg_vitals", 4))


@query("class_balance", with_views("fx_labelled", """
    select label, count(*) as n from fx_labelled group by label"""))
def class_balance(t):
    return rel.category_counts(t.fx_labelled, "label").withColumnRenamed("count", "n")


@query("replicate_rows", """
    select c_custkey, copy_no from customer, (select unnest([0, 1, 2, 3]) as copy_no) copies""")
def replicate_rows(t):
    return rel.replicate_rows(t.customer, 4).select("c_custkey", "copy_no")


@query("src_csv_text", "select doc_id, text, lang, source from documents")
def src_csv_text(t):
    path = scratch_path(t.spark, "documents-csv")
    df = t.documents.select("doc_id", "text", "lang", "source")
    src.write_csv(df, path)
    return src.read_csv(t.spark, path, df.schema)


@query("src_csv_roundtrip", with_views("fx_predictions", """
    select actual, prediction, round(probability, 6) as probability from fx_predictions"""))
def src_csv_roundtrip(t):
    path = scratch_path(t.spark, "predictions-csv")
    src.write_csv(t.fx_predictions.select("actual", "prediction", "probability"), path)
    return rounded(src.load_predictions(t.spark, path))


@query("stage_roundtrip", with_views("fx_patients fx_admissions fx_icustays", f"""
    select subject_id, hadm_id, icustay_id, round(los, 6) as los, round(age, 6) as age
    from ({_CORE_SQL}) c"""))
def stage_roundtrip(t):
    path = scratch_path(t.spark, "core-stage")
    src.write_stage(core(t), path)
    return rounded(src.read_stage(t.spark, path).select("subject_id", "hadm_id", "icustay_id", "los", "age"))


@query("write_audit", """
    select 'orders' as "table", count(*) as written from orders
    union all select 'lineitem', count(*) from lineitem""")
def write_audit(t):
    rows = {name: src.write_stage(getattr(t, name), scratch_path(t.spark, name))
            for name in ("orders", "lineitem")}
    return t.spark.createDataFrame(list(rows.items()), "table string, written long")
