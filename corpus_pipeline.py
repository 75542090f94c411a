"""From raw documents to a training mix, in five stages; each reads what the one before it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymark.llm.decontaminate import find_leaks
from quarrymark.llm.jaccard import keep_one
from quarrymark.llm.mixing import mix_sources
from quarrymark.llm.secrets import redact
from quarrymark.llm.shared import delete_at_exit, new_path
from quarrymark.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model calls toxic go."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep_rows=True)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are masked, and n_chars follows."""
    return redact(docs).withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mix_sources(docs)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secrets", secrets), ("mixing", mixing)]
#: Trained and randomised stages have no SQL; tests hold each against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = new_path(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            delete_at_exit(spark, path)
            docs = spark.read.parquet(path)
    return docs
