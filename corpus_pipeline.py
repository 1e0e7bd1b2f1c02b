"""From raw documents to packed training sequences, one corpus operator per stage.

    STAGES            (name, function); each takes (spark, docs, sf_dir), gives a DataFrame
    run(spark, dir)   all stages over `dir`/documents.parquet

Every stage works on all rows that the stage before it kept. All but the last give the
columns of the documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import exact_dedup, language, near_dedup, packing, pii
from tallyhouse.llm.common import shared_folder


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, and those of no clear language, go."""
    return language.drop_unidentified(docs, public_tokenizers.path("piece_bpe_32k.model"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dedup.drop_near_copies(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.masked(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document stands in the training sequences."""
    return packing.pack(packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [("language_id", identify), ("exact_dedup", exact), ("near_dedup", near),
          ("pii", private), ("packing", packed)]

# The language model, the components and the packing are iterative: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written as Parquet in a shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_folder(spark, "corpus")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
