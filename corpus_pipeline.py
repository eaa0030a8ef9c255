"""A corpus from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs. All but the last return the
columns of documents; a stage that cuts a text brings n_chars in line with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringcast.llm import jaccard, line_dedup, packing, quality_rules, substring
from ringcast.llm.ship import ship
from ringcast.session import materialize
from ringcast.sources.table import Tables


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the risk-controlled rules reject go."""
    return quality_rules.keep_good(docs, Tables(spark, sf_dir).labels)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of lines go."""
    return _counted(line_dedup.without_repeats(docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five words, 0.8)."""
    ship(spark)
    return jaccard.one_per_component(docs, width=5, num=80, den=100)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that are in an earlier document go."""
    ship(spark)
    return _counted(substring.drop_repeats(docs, size=13))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of the documents lies in the training sequences."""
    ship(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("substring_dedup", substring_stage),
    ("best_fit_packing", packing_stage),
]

# The near-duplicate and packing stages are no SQL queries; tests compare run()
# with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, one after the other."""
    docs = Tables(spark, sf_dir).documents
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
