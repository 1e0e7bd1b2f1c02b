"""Ordered operators that stay distributed when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import as_col


def _tie_break(df: DataFrame, rest: Sequence[str], order: Sequence[str]) -> list[str]:
    """The columns that can be ordered (maps cannot) and are not in `order` yet."""
    return [f.name for f in df.schema if f.name in rest and f.name not in order
            and "map<" not in f.dataType.simpleString()]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by `order`.

    An aggregate, not a window: map tasks keep one row per key, so a hot key
    costs one row per task in the shuffle. A missing order value sorts first; rows equal
    in `order` are told apart by their other columns, so the answer does not depend on
    the order in which rows arrive.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order, *_tie_break(df, rest, order))).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by `order`; combined and tied like latest_per_key."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order, *_tie_break(df, rest, order))).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                rank_name: str = "rn") -> DataFrame:
    """The first n rows of each key. The rank filter becomes a WindowGroupLimit on
    both sides of the shuffle, so at most n rows per key leave each map task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_name, F.row_number().over(w)).where(F.col(rank_name) <= n)


def _place(df: DataFrame, cuts: str, key: Column, splits: int, out: str) -> DataFrame:
    """How many of the sorted `cuts` lie below the key: a binary search in log2(splits)
    generated-code steps (splits is a power of two)."""
    df = df.withColumn(out, F.lit(0))
    step = splits // 2
    while step:
        below = F.get(cuts, F.col(out) + (step - 1)) < key
        df = df.withColumn(out, F.col(out) + F.when(below, step).otherwise(0))
        step //= 2
    return df


def with_row_index(df: DataFrame, key: str, out: str = "row_index", start: int = 1,
                   splits: int = 1024) -> DataFrame:
    """Consecutive numbers in the order of a unique numeric `key`.

    The keys are cut at approximate quantiles into `splits` ranges (a power of two), which
    come from one scalar subquery. Each range is numbered on its own and shifted by the row
    count of the ranges before it: no task sorts the whole table, and at most `splits` counts
    are gathered, again as a scalar subquery. Uneven cuts change the balance, never the
    numbers. The table is read three times: for the cuts, the counts (both of the key alone)
    and the rows.
    """
    k = as_col(key)
    cuts = F.percentile_approx(k, [i / splits for i in range(1, splits)], 10 * splits)
    tagged = _place(df.withColumn("_cuts", df.agg(cuts.alias("_cuts")).scalar()), "_cuts", k,
                    splits, "_range").drop("_cuts")
    counted = tagged.groupBy("_range").agg(F.count("*").alias("_n"))
    # _before[r]: rows of the ranges up to r - 1, which are not all there.
    ranges = F.map_from_entries(F.collect_list(F.struct("_range", "_n")))
    running = F.aggregate(
        F.sequence(F.lit(0), F.lit(splits - 2)), F.array(F.lit(0).cast("long")),
        lambda done, r: F.concat(done, F.array(
            F.element_at(done, -1) + F.coalesce(F.try_element_at("_counts", r), F.lit(0)))))
    before = counted.agg(ranges.alias("_counts")).select(running.alias("_before")).scalar()
    local = F.row_number().over(Window.partitionBy("_range").orderBy(key))
    return (tagged.withColumn("_local", local).withColumn("_before", before)
            .withColumn(out, F.get("_before", F.col("_range")) + F.col("_local") - 1 + start)
            .drop("_range", "_local", "_before"))
