"""CSV and stage-table sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cohorta.sources import schemas

STAGE_FORMAT = "parquet"

# Both sides of a CSV file: quotes double inside quoted text, blanks stay, an empty text is quoted.
CSV_TEXT = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false", "lineSep": "\n"}
# An empty cell is NULL, a quoted empty one is an empty text; Spark tells them apart only if NULL
# reads as some other text, here one control character.
CSV_NULL = {"nullValue": "\x01"}


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType | None = None,
             optional: tuple[str, ...] = (), multi_line: bool = True) -> DataFrame:
    """Header CSV file, folder of part files or glob.

    With a schema the columns are matched by header name, so files may carry more columns than
    the schema or another order. All files must have the same header: Spark checks each one and
    raises. A column that is missing raises too, unless it is ``optional``: then it is NULL.
    Without a schema Spark infers the types. ``multi_line=False`` lets Spark split large files;
    it is for tables without free text.
    """
    reader = spark.read.options(**CSV_TEXT, **CSV_NULL)
    if schema is None:
        return reader.option("inferSchema", True).option("multiLine", multi_line).csv(path)
    names = reader.csv(path).columns
    header = StructType([StructField(n, StringType()) for n in names])
    text = reader.option("multiLine", multi_line).option("enforceSchema", False).schema(header).csv(path)
    have = {c.lower(): c for c in names}
    missing = [f.name for f in schema.fields if f.name.lower() not in have and f.name.lower() not in optional]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in the header {', '.join(names)}")
    return text.select(*[
        (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None))
        .cast(f.dataType).alias(f.name) for f in schema.fields])


def write_csv(df: DataFrame, path: str) -> int:
    """Overwrite a CSV folder with header; returns the rows found in the written files."""
    df.write.mode("overwrite").options(**CSV_TEXT).csv(path)
    return read_csv(df.sparkSession, path, df.schema).count()


def read_stage(spark: SparkSession, path: str, fmt: str = STAGE_FORMAT) -> DataFrame:
    return spark.read.format(fmt).load(path)


def write_stage(df: DataFrame, path: str, fmt: str = STAGE_FORMAT,
                partition_by: list[str] | None = None) -> int:
    """Overwrite a stage table; returns the rows found in the written files, which for
    parquet are read off the file footers."""
    writer = df.write.format(fmt).mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
    return read_stage(df.sparkSession, path, fmt).count()


def load_core_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: read_csv(spark, f"{folder}/{name.upper()}.csv", schema, schemas.OPTIONAL)
            for name, schema in schemas.CORE_TABLES.items()}


def load_event_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Events are numbers and codes, so large files are split; the dictionaries have free text."""
    return {name: read_csv(spark, f"{folder}/{name.upper()}.csv", schema, schemas.OPTIONAL,
                           multi_line=name in schemas.DICTIONARIES)
            for name, schema in schemas.EVENT_TABLES.items()}


def load_predictions(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.PREDICTIONS)


def write_roc(curve: DataFrame, path: str) -> int:
    """Keep ROC points, one folder per run."""
    return write_stage(curve, path, partition_by=["run"])


def read_roc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("run", F.col("run").cast("string"))
