"""The corpus pipeline: language ID, MinHash near-dedup, benchmark decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and works on all rows the stage before it kept.  All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.contamination import without_leaks
from clickloom.llm.language import in_a_language, learn_languages
from clickloom.llm.mixing import mixed_documents
from clickloom.llm.near import near_duplicates
from clickloom.llm.sharding import balanced_shards
from clickloom.session import configure, write_down


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has letters, a null lang replaced by the predicted one; those without text or letters go.

    A lang that is given stays.  If no document has one, nothing can be learnt: lang stays null and texts with
    letters stay.  Repeated rows are treated alike; an empty table stays empty.  Other columns may have any names.
    """
    return in_a_language(docs, learn_languages(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least doc_id.

    Of rows equal in doc_id and text one stays.  Rows of one doc_id with different texts stay, unless one of them is
    a near copy of a document with a smaller doc_id: then all of that doc_id go.  Rows without doc_id stay.  An
    empty table stays empty.  Other columns may have any names.
    """
    dropped = near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("gone")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.md5(F.col("text").cast("binary")).alias("print"))
    left = rows.join(dropped, F.col("id") == F.col("gone"), "left_anti")
    named = left.where("id is not null").dropDuplicates(["id", "print"])
    return left.where("id is null").unionByName(named).select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark; null and empty texts stay."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of the mix: each document as often as its source's target takes it, one per source cut to its words.

    Documents of which no word is taken, empty ones among them, go.
    """
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and slot; equal texts together as far as a shard has room, shards equal to one row."""
    return balanced_shards(docs)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("mixing", mixing), ("sharding", sharding)]

# The network, the groups of near duplicates and the shards are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written down before the next one reads it."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = write_down(docs)
    return docs
