"""One query for each corpus operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sql
from .decontaminate import find_leaks
from .infill import fill_in_middle, restore
from .jaccard import similar_documents
from .mixing import mix_sources
from .prefix_trie import ordered_turns, prefix_trie, shared_starts
from .quality import judge_quality
from .secrets import scan_secrets
from .sharding import shard_keys
from .substring_dedup import dedup_words
from .suffix_dedup import dedup_bytes
from .toxicity import judge_toxicity
from .urlfilter import filter_urls
from .warc import archive_round_trip


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_words(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = ordered_turns(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return prefix_trie(*shared_starts(turns)).drop("k1", "k2")


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shard_keys(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = lambda x: F.sha2(F.encode(x, "UTF-8"), 256)
    return rows.select("doc_id", F.col("n_units").alias("n"), "form", F.char_length("prefix").cast("long").alias("prefix_chars"), F.char_length("middle").cast("long").alias("middle_chars"), digest(F.col("output")).alias("output_sha256"), digest(restore(F.col("output"), F.col("form"))).alias("restored_sha256"))


QUERIES = {f.__name__: f for f in (op1_secret_scan, op2_toxicity, op3_suffix_dedup, op4_warc, op5_quality_rules, op6_url_filter, op7_mixing, op8_substring_dedup, op9_jaccard_join, op10_decontaminate, op11_prefix_trie, op12_sharding, op13_fill_in_middle)}
ORACLE_SQL = {name: text for name, text in sql.ALL.items() if name in QUERIES}
