"""Small helpers that the operators share."""

from __future__ import annotations

import gc
import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorta.session import scratch_path, tune

# The characters that separate words in the contracts, [\x20\x09-\x0D].
SPACES = " \t\n\x0b\f\r"


def travels(module: str) -> None:
    """Executors get the module's helpers with the task; the package need not be installed there."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text; a null one counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of what is written by now: its cleaner follows the JVM's."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends at the files."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
