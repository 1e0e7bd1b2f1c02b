"""Distinct people of any period from exact bitmaps.

People are numbered, and the people of a week and group are a bitmap: 32,768 numbers to a
built-in bitmap of 4 KiB, one row per part of the number range that has somebody. Bitmaps are
kept and merged: the people of a longer period are the union of its weeks' bitmaps and of the
few days before the first and after the last whole week, which are read from the rows. So a
report over a year reads 52 rows per group and number range, not a year of rows, and any
number of periods comes from one pass over them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def monday(date: Column) -> Column:
    return F.trunc(date, "week")


def person_bitmaps(rows: DataFrame, by: Sequence[str], person: str, unit: str = "unit"
                   ) -> DataFrame:
    """(unit, by.., bucket, bits) of rows that have a `unit`, the day on which a week starts
    or a single day. A row without a person counts as one person without a number, whose
    bucket is null. Every task combines its rows first, into one bitmap per row of the result."""
    return (rows.groupBy(unit, *by, F.bitmap_bucket_number(person).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.coalesce(F.bitmap_bit_position(person), F.lit(0)))
                 .alias("bits")))


def weekly_bitmaps(rows: DataFrame, by: Sequence[str], person: str, date: str) -> DataFrame:
    """The bitmaps of every week, by its Monday; rows without a date are in none."""
    dated = rows.where(F.col(date).isNotNull())
    return person_bitmaps(dated.withColumn("unit", monday(F.col(date))), by, person)


def distinct_in_periods(rows: DataFrame, weekly: DataFrame, by: Sequence[str], person: str,
                        date: str, periods: Mapping[str, tuple[str, str]]) -> DataFrame:
    """(by.., one column per period) with the distinct people of each period, first and last
    day included; 0 for a group that has people in other weeks only. `weekly` are the bitmaps
    of `rows`, kept since; only days outside whole weeks are read from `rows` again."""
    edges, flags = F.lit(False), {}
    for name, (first, last) in periods.items():
        a, b = F.lit(first).cast("date"), F.lit(last).cast("date")
        start = F.when(monday(a) == a, a).otherwise(F.date_add(monday(a), 7))  # whole weeks
        end = F.date_sub(monday(F.date_add(b, 1)), 1)
        flags[name] = (a, b, start, end)
        day = F.col(date)
        edges = edges | (day.between(a, b) & ~day.between(start, end))
    days = person_bitmaps(rows.where(edges).withColumn("unit", F.col(date)), by, person)

    def among(cells: DataFrame, is_day: bool) -> DataFrame:
        held = []
        for name, (a, b, start, end) in flags.items():
            unit = F.col("unit")
            held.append((unit.between(a, b) & ~unit.between(start, end)) if is_day
                        else (unit.between(start, end)))
        return cells.select(*by, "bucket", "bits", *[h.alias(n) for h, n in zip(held, flags)])

    cells = among(weekly, False).unionByName(among(days, True))
    merged = cells.groupBy(*by, "bucket").agg(*[
        F.bitmap_or_agg(F.when(F.col(n), F.col("bits")).otherwise(F.lit(b""))).alias(n)
        for n in flags])
    return merged.groupBy(*by).agg(*[F.sum(F.bitmap_count(n)).alias(n) for n in flags])
