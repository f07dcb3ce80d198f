"""Documents to training shards: each stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jsonstrata.functions.names import free_name
from jsonstrata.llm import decontamination, langid, mixing, neardup, sharding
from jsonstrata.llm.frames import col, keep, table

SHARDS = 40


def _by_id(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """The rows of ``docs`` joined with ``ids`` on ``doc_id``, where a missing id equals a missing one."""
    at = free_name("_id", docs.columns, ids.columns)
    ids = ids.withColumnRenamed("doc_id", at)
    return docs.join(ids, F.col("doc_id").eqNullSafe(F.col(at)), how)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without letters, or without one language in most of them, go."""
    return langid.reject(docs, langid.train(docs), min_score=0.5)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of every near-duplicate group, and those without an id."""
    found = neardup.near_duplicates(docs, percent=80)
    return _by_id(docs, found.where("kept").select("doc_id").distinct(), "left_semi")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = decontamination.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return _by_id(docs, keep(found.select("doc_id").distinct()), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: up to three rows of one, none of others.

    Rows that share an id, or have none, are taken alike, as often as the mix takes any of them.
    """
    times = free_name("_times", docs.columns)
    passes = mixing.mix(docs).groupBy("doc_id").agg(F.max("passes").alias(times)).where(F.col(times) > 0)
    taken = _by_id(docs, passes, "inner")
    repeated = taken.select(*map(col, docs.columns), F.explode(F.sequence(F.lit(1), F.col(times).cast("int"))))
    return repeated.select(*map(col, docs.columns))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every row."""
    return sharding.shard_documents(docs, SHARDS)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Language models, sketches, tiling and packing can't be stated in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir))
    return docs
