"""Registration of queries and the test views they run on."""

from __future__ import annotations

import re
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorta.session import tune_tables

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

# The hospital tables, read out of the order tables: customer ~ patient, order ~ admission,
# order line ~ ICU stay and event, part ~ diagnosis code. Valid in Spark SQL and DuckDB.
VIEWS = {
    "fx_patients": """
        select c_custkey as subject_id, c_mktsegment as gender,
               cast('1950-01-01' as timestamp) as dob, c_acctbal as balance
        from customer""",
    "fx_admissions": """
        select o_custkey as subject_id, o_orderkey as hadm_id, o_orderdate as admittime,
               o_orderpriority as admission_type,
               case when o_orderstatus = 'F' then 1 else 0 end as hospital_expire_flag
        from orders""",
    "fx_icustays": """
        select o_custkey as subject_id, l_orderkey as hadm_id, l_linenumber as icustay_id,
               avg(l_quantity) as los
        from lineitem join orders on l_orderkey = o_orderkey
        group by o_custkey, l_orderkey, l_linenumber""",
    "fx_chartevents": """
        select o_custkey as subject_id, l_orderkey as hadm_id, l_linenumber as icustay_id,
               l_suppkey as itemid,
               case when l_linenumber = 7 then null else l_extendedprice end as valuenum
        from lineitem join orders on l_orderkey = o_orderkey""",
    "fx_labevents": """
        select o_custkey as subject_id, l_orderkey as hadm_id, l_partkey as itemid,
               case when l_linenumber = 7 then null else l_quantity end as valuenum
        from lineitem join orders on l_orderkey = o_orderkey""",
    "fx_diagnoses": """
        select o_custkey as subject_id, l_orderkey as hadm_id, p_brand as icd9_code
        from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey""",
    "fx_codes": """
        select p_brand as icd9_code, min(p_type) as title from part group by p_brand""",
    "fx_predictions": """
        select l_orderkey, l_linenumber,
               case when l_quantity + 3 * l_linenumber > 40 then 1 else 0 end as actual,
               case when l_quantity > 25 then 1 else 0 end as prediction,
               l_quantity / 51e0 as probability
        from lineitem""",
    "fx_models": """
        select 'by price' as model, case when l_quantity + 3 * l_linenumber > 40 then 1 else 0 end as actual,
               case when l_extendedprice > 38000e0 then 1 else 0 end as prediction,
               l_extendedprice as score
        from lineitem
        union all
        select 'by quantity' as model, case when l_quantity + 3 * l_linenumber > 40 then 1 else 0 end as actual,
               case when l_quantity > 25 then 1 else 0 end as prediction, l_quantity as score
        from lineitem""",
    "fx_labelled": """
        select d.doc_id, l.quality as label, cast(d.n_chars as double) as x1,
               cast(length(d.text) - length(replace(d.text, ' ', '')) as double) as x2,
               cast(length(d.text) - length(replace(d.text, '.', '')) as double) as x3
        from documents d join labels l on d.doc_id = l.doc_id""",
    # Measurements with holes: every rule leaves NULLs in a number, a code and a text column.
    "fx_holes": """
        select l_orderkey, l_linenumber,
               case when l_linenumber = 3 then null else l_quantity end as qty,
               case when l_linenumber = 5 then null else l_extendedprice end as price,
               case when l_linenumber = 2 then null else l_suppkey end as supp,
               case when l_linenumber = 4 then null else l_returnflag end as flag,
               case when l_linenumber in (1, 6) then null else l_linestatus end as status
        from lineitem""",
}


class Tables:
    """The parquet tables of one folder by name, and the views above as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune_tables(spark)
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("__"):
            raise AttributeError(name)
        if name in VIEWS:
            return self.sql(VIEWS[name])
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        """Run a view's SQL on this folder's tables, without leaving temp views behind."""
        named = re.compile(r"\b(from|join) (customer|orders|lineitem|part|documents|labels)\b")
        used = {name for _, name in named.findall(text)}
        return self.spark.sql(named.sub(r"\1 {\2}", text), **{name: getattr(self, name) for name in used})


def with_views(names: str, body: str) -> str:
    """SQL text with the named views put in front as CTEs; ``body`` may add its own after ','."""
    ctes = ", ".join(f"{n} as ({VIEWS[n]})" for n in names.split())
    return f"with {ctes} {body}"


def query(name: str, sql: str | None = None):
    def register(build):
        @wraps(build)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(spark, folder))

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return build

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double, so that two engines' summation orders agree."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c)
                       for c, t in df.dtypes])
