"""The corpus pipeline: quality rules, near-duplicates, decontamination, secrets, mixing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept;
run() writes every stage's rows as Parquet and rereads them as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.llm.common import cut
from turnloom.llm.decontam import remove_contaminated
from turnloom.llm.mixture import curriculum
from turnloom.llm.neardup import keep_first
from turnloom.llm.quality import keep_good
from turnloom.llm.secrets import redact


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, similarity 0.8) the document with the least id stays."""
    return keep_first(docs, k=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages (5 % of their words or more) go; shorter passages are cut out."""
    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reported secrets are replaced in the texts."""
    return redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with how much of it the mix takes and where, in order of position."""
    return curriculum(docs).drop("positions").withColumn("n_chars", F.length("text").cast("bigint"))


STAGES = [("quality_rules", quality), ("minhash_neardup", near_duplicates), ("decontamination", decontaminate), ("secret_scan", secrets), ("curriculum_mix", mixture)]

#: Sketches, certified cutoffs and hash orders have no SQL form: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
