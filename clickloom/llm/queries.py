"""The registered queries of this subpackage: operators with their settings over whole tables, reduced to the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickloom.llm.contamination import contaminated
from clickloom.llm.language import languages
from clickloom.llm.licenses import licenses
from clickloom.llm.lines import dedup_lines
from clickloom.llm.merkle import audit
from clickloom.llm.mixing import mix
from clickloom.llm.near import near_duplicates
from clickloom.llm.passages import repeated_passages
from clickloom.llm.phrases import collocations
from clickloom.llm.quality import quality
from clickloom.llm.secrets import digest, find_secrets
from clickloom.llm.sharding import balanced_shards
from clickloom.llm.vectors import near_vectors
from clickloom.session import configure


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find_secrets(_table(spark, sf_dir, "documents")))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(_table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(_table(spark, sf_dir, "documents")).drop("kept_text")


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_shards(_table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(_table(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(_table(spark, sf_dir, "documents")).drop("source")


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_secret_scan, op2_quality, op3_language_id, op4_line_dedup, op5_embedding_near_dedup, op6_sharding, op7_mixing, op8_decontamination,
                                  op9_minhash_near_dedup, op10_substring_dedup, op11_phrase_collocations, op12_merkle_manifest, op13_license_scan)}


def oracle_sql() -> dict[str, str]:
    from clickloom.llm.oracle import SQL

    return SQL
