"""A training corpus in stages, each the work of one operator of ``logweir.llm``.

Every stage takes the documents its predecessor kept and returns documents with
the same columns; the last one adds each document's shard and slot.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from logweir.llm import decontamination, jaccard_join, mixing, quality, sharding
from logweir.llm.common import run_folder, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be good.

    Null and empty texts have the score of no words; repeated rows are judged alike;
    columns named like a score stay as they are. An empty table stays empty.
    """
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def deduplication_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id.

    Of repeated rows one stays; null and empty texts are near to nothing and all stay;
    a null id comes after all others; columns keep their values.
    """
    return jaccard_join.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of a benchmark item.

    Null and empty texts have no words and stay, as do all repeats of a clean row.
    """
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed by weight; a document comes as often as the mix takes it.

    A null source is one source; null and empty texts have size 0 and are taken once;
    repeated rows are drawn each on its own.
    """
    return mixing.mix(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shuffled into 24 shards.

    Every row gets a place of its own, null ids, null texts and repeats too; an older
    ``shard`` or ``slot`` column is replaced by the result.
    """
    return sharding.shard(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", deduplication_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

# Learned scores and hashed draws have no SQL; tests/llm holds the brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = run_folder(spark)
    for number, (name, stage) in enumerate(STAGES):
        path = os.path.join(folder, f"{number}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
