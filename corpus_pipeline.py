"""The corpus pipeline: documents to packed sequences, each stage on all that the one before kept.

Null texts count as empty everywhere. Documents without an id are judged, searched for secrets and
packed like all others; as they have no place among the others, they are no one's copy.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorta.llm import jaccard_join, packing, quality, secrets, suffix_levels
from cohorta.llm.common import release, stored, table
from cohorta.session import materialise, tune

END_ID, LONGEST = 2, 4096
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose pairwise quality score reaches the threshold."""
    tune(spark)
    return quality.keep_good(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))


def _nameless(docs: DataFrame) -> DataFrame:
    return docs.filter("doc_id is null").select(*COLUMNS)


def different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the smallest id."""
    tune(spark)
    classes = jaccard_join.similar_classes(docs).groupBy("doc_id").agg(
        F.max(F.col("doc_id") == F.col("component_id")).alias("first"))
    others = materialise(classes.filter("not first").select("doc_id"))
    release(spark)
    return jaccard_join.without(docs.select(*COLUMNS), others)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings that occur earlier; those of which nothing is left go.

    A character of which only some bytes are cut goes whole.
    """
    tune(spark)
    cut = suffix_levels.remove_repeats(docs, whole_characters=True).filter(
        (F.octet_length("kept") > 0) | (F.col("n_bytes") == 0))
    rest = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.first("lang").alias("lang"), F.first("source").alias("source"))
    return (cut.select("doc_id", F.col("kept").cast("string").alias("text")).join(rest, "doc_id")
            .select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))
            .unionByName(_nameless(docs)))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with found secrets replaced by a mark."""
    return secrets.redact_documents(docs.select(*COLUMNS))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of binary lengths with their ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID, LONGEST)


STAGES = [
    ("pairwise quality", good),
    ("near duplicates", different),
    ("repeated strings", unrepeated),
    ("secrets", without_secrets),
    ("packing", packed),
]

# SQL says neither the learned scores nor the tokens; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"stage{i}")
    return docs
