"""From raw documents to packed training sequences in five stages.

Each stage takes the documents its predecessor kept and returns a
DataFrame; all but the last return the columns of ``documents``. ``run``
writes every stage as Parquet below the session's checkpoint folder and
reads it back, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitchside.llm import jaccard, mixing, packing, quality, substring
from pitchside.session import scratch_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.keep(docs)


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return jaccard.keep_one(docs)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has."""
    return substring.dedup_stage(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn for the target weights, once per epoch."""
    return mixing.mix_stage(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per packed piece, with its token ids."""
    return packing.pack(docs)


STAGES = [("quality rules", keep_quality), ("n-gram Jaccard join", keep_one_of_near),
          ("substring dedup", drop_passages), ("mixing", mix_sources), ("packing", pack_sequences)]

# Near duplicates, divergences and tokenizers have no SQL; the tests compare
# the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
