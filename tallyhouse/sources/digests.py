"""Comparing the keys of two large tables by digests.

Keys are put into ranges, and a range is summed up by the count, the xor and the sum of its
keys' hashes. Ranges whose sums agree on both sides hold the same keys and are left alone;
those that differ are split and summed again, and only in the last ranges that still differ
are keys compared one by one. What moves is one row per range and the keys near a change.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import shared_folder

WIDTHS = (1 << 20, 1 << 14, 1 << 8)  # keys per range, from level to level


def range_of(df: DataFrame, key: str, width: int) -> Column:
    """The range of a key: of an integer the range of its value, so that neighbours stay
    together; of anything else a part of the hash space, whose size is the same share."""
    if isinstance(df.schema[key].dataType, T.IntegralType):
        return F.floor(F.col(key) / width)
    return F.shiftright(F.xxhash64(key), width.bit_length() + 20)


def digests(df: DataFrame, key: str, width: int, side: str) -> DataFrame:
    """(range, n, x, s) of the keys that are present; one row per range leaves a task."""
    h = F.xxhash64(F.col(key))
    return (df.where(F.col(key).isNotNull()).groupBy(range_of(df, key, width).alias("range"))
            .agg(F.count("*").alias(f"{side}_n"), F.bit_xor(h).alias(f"{side}_x"),
                 F.sum(F.shiftright(h, 40)).alias(f"{side}_s")))


def differing(a: DataFrame, b: DataFrame, key: str, width: int) -> DataFrame:
    """(range) of the ranges whose keys are not the same on both sides."""
    both = digests(a, key, width, "a").join(digests(b, key, width, "b"), "range", "full")
    same = F.lit(True)
    for part in ("n", "x", "s"):
        same = same & F.col(f"a_{part}").eqNullSafe(F.col(f"b_{part}"))
    return both.where(~same).select("range")


def within(df: DataFrame, key: str, width: int, ranges: DataFrame) -> DataFrame:
    tagged = df.withColumn("_range", range_of(df, key, width))
    return tagged.join(ranges.withColumnRenamed("range", "_range"), "_range", "left_semi").drop(
        "_range")


def near_changes(a: DataFrame, b: DataFrame, key: str, widths: Sequence[int] = WIDTHS
                 ) -> tuple[DataFrame, DataFrame]:
    """The keys of both sides that lie in a last range that differs. The ranges of a level
    are written down, so that each level reads every side once."""
    spark = a.sparkSession
    folder = shared_folder(spark, "digests")
    a, b = a.select(key), b.select(F.col(key).cast(a.schema[key].dataType).alias(key))
    for width in widths:
        differing(a, b, key, width).write.parquet(f"{folder}/{width}")
        ranges = spark.read.parquet(f"{folder}/{width}")
        a, b = within(a, key, width, ranges), within(b, key, width, ranges)
    return a, b


def gone_keys(stored: DataFrame, current: DataFrame, key: str, widths: Sequence[int] = WIDTHS
              ) -> DataFrame:
    """Stored keys that `current` lacks, each once. A null key is never gone, and a null
    among the current keys matches nothing."""
    a, b = near_changes(stored, current, key, widths)
    return a.where(F.col(key).isNotNull()).join(b, key, "left_anti").distinct()
