"""Documents through the stages of a training corpus.

Each stage works on the rows that its predecessor kept and returns them with the columns of ``documents``; the last
returns the sampled segmentations of the texts that are left. ``run`` writes and rereads every stage in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.llm import decontaminate, line_dedup, near_dedup, pieces, quality_rules
from candlewright.llm.base import saved


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a fixed or learned quality rule go."""
    return quality_rules.kept_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share go, but for one document each; n_chars follows the text."""
    kept = line_dedup.deduplicated(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.col("__n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents alike in 80 of 100 five-word shingles, directly or by others, the smallest id stays."""
    return near_dedup.kept_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a copy of a benchmark item go."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two distinct sampled segmentations of every text."""
    return pieces.encoded(docs)


STAGES = [
    ("quality_rules", quality), ("line_dedup", lines), ("near_dedup", near_duplicates), ("decontamination", decontamination), ("sentencepiece", sentencepiece),
]
#: Near duplicates and sampled segmentations have no SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
