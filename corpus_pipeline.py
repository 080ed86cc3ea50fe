"""Corpus pipeline over ``documents``: stages of ``kithwork.llm``, each on all rows its predecessor kept.

Every stage takes (spark, docs, sf_dir); all but the last return the columns of ``docs``. Rows with a null
doc_id pass the stages that need one. Rows that repeat a doc_id are one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kithwork.llm.decontamination import contaminations
from kithwork.llm.minhash_dedup import minhash_dedup
from kithwork.llm.packing import pack
from kithwork.llm.quality import keep_good
from kithwork.llm.substring_dedup import remove_repeated
from kithwork.llm.tables import stored, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier rejects go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


# Five-word shingles; the registered op3_ query has a threshold of its own.
NEAR_PERCENT = 80


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates the document with the smallest id stays."""
    return _without(docs, minhash_dedup(docs, percent=NEAR_PERCENT).where("not kept"))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of lines and sentences are cut out of the texts; ``n_chars`` follows."""
    cut = remove_repeated(docs, removed="_kithwork_removed")
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.size("_kithwork_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return cut.select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return _without(docs, contaminations(docs, table(spark, sf_dir, "benchmark")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in the sequences."""
    return pack(docs)


def _without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    ids = rows.select(F.col("doc_id").alias("_kithwork_id")).distinct()
    return docs.join(ids, F.col("doc_id").cast("long") == F.col("_kithwork_id"), "left_anti")


STAGES = [
    ("quality", good_quality),
    ("minhash_dedup", one_of_each_group),
    ("substring_dedup", without_repeats),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

# Learned scores and token ids have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
