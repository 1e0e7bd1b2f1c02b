"""Exact duplicates with a heavy-hitter split.

Misra-Gries summaries of every task name the digests that may be frequent; those whose
exact count confirms it are few by construction (at most 1/share of them) and are
resolved on the map side through a broadcast. All other digests go through an ordinary
shuffle, where no key is hot.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, forget, join_kept, ship

WHITE = r"[\x20\x09-\x0D]+"


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, text_sha256) of the text with each white-space run as one space."""
    text = F.regexp_replace(F.coalesce("text", F.lit("")), WHITE, " ")
    return docs.select("doc_id", F.sha2(text.cast("binary"), 256).alias("text_sha256"))


def misra_gries(counters: int):
    """Map function: at most `counters` (value, weight) rows per task. A value seen f times
    among n keeps a weight of f - n / counters or more."""

    def reduce(weights: dict[str, int]) -> None:
        if len(weights) > counters:
            cut = sorted(weights.values(), reverse=True)[counters]
            for key in list(weights):
                weights[key] -= cut
                if weights[key] <= 0:
                    del weights[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        weights: dict[str, int] = {}
        for batch in batches:
            for pair in pc.value_counts(batch.column(0)).to_pylist():
                weights[pair["values"]] = weights.get(pair["values"], 0) + pair["counts"]
            reduce(weights)
        yield pa.RecordBatch.from_pydict(
            {"text_sha256": pa.array(weights.keys(), pa.string()),
             "weight": pa.array(weights.values(), pa.int64())})

    return run


def frequent(keyed: DataFrame, share: float) -> DataFrame:
    """(text_sha256, keep_id, group_size) of the digests that hold at least `share` of the
    rows: at most 1 / share rows."""
    rows = keyed.count()
    sketch = (keyed.select("text_sha256")
              .mapInArrow(misra_gries(int(2 / share)), "text_sha256 string, weight long")
              .groupBy("text_sha256").agg(F.sum("weight").alias("weight"))
              .where(F.col("weight") >= rows * share / 2)
              .select(F.col("text_sha256").alias("_key")))  # at most 2 / share rows
    return (keyed.join(F.broadcast(sketch), F.col("text_sha256") == F.col("_key"), "left_semi")
            .groupBy("text_sha256")
            .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
            .where(F.col("group_size") >= rows * share))


def groups(docs: DataFrame, share: float = 0.001) -> DataFrame:
    """Each row's group of equal texts: doc_id, keep_id, group_size, kept, text_sha256.

    A null text counts as empty. Rows without a doc_id are never the one to stay, unless
    no row of the group has one (keep_id null, all kept). Rows that repeat the smallest
    doc_id are all marked as kept. An empty table gives no rows; other columns are ignored.
    """
    ship(docs.sparkSession)
    keyed = checkpointed(digests(docs))
    heavy = checkpointed(frequent(keyed, share))
    columns = ["doc_id", "keep_id", "group_size", "text_sha256"]
    hot = keyed.join(F.broadcast(heavy), "text_sha256").select(columns)
    rest = keyed.join(F.broadcast(heavy.select("text_sha256")), "text_sha256", "left_anti")
    sizes = rest.groupBy("text_sha256").agg(
        F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    cold = rest.join(sizes, "text_sha256").select(columns)
    kept = F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull())
    return hot.unionByName(cold).withColumn("kept", kept).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def drop_copies(docs: DataFrame, share: float = 0.001) -> DataFrame:
    """`docs` with one row of each group of equal texts, all columns unchanged."""
    decided = groups(docs, share).groupBy("doc_id").agg(F.max("kept").alias("kept"))
    return join_kept(docs, decided.where(~F.col("kept")))
