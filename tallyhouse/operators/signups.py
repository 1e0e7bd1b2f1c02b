"""Project signups along a month-day axis."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import distinct_count
from ..functions.dates import month_day_number
from .audience import single_value


def cumulative(signups: DataFrame, series: str, date: str, until: int | None = None,
               axis: DataFrame | None = None) -> DataFrame:
    """Running signups of each series by month-day number, on a dense axis.

    Signups are counted per (series, month-day) first, so the window holds at most
    366 rows per series. The axis is the month-days of all series, or the `month_day`
    column of `axis`; signups before its first day still count. A day without signups
    repeats the running count, and days after `until` are blank.
    """
    counted = (signups.groupBy(F.col(series), month_day_number(date).alias("month_day"))
               .agg(F.count("*").alias("n")))
    shown = counted if axis is None else axis
    # At most 366 numbers.
    days = shown.agg(F.sort_array(F.collect_set("month_day")).alias("days")).scalar()
    dense = (counted.select(series).distinct().withColumn("month_day", F.explode(days))
             .withColumn("_shown", F.lit(True)))
    w = Window.partitionBy(series).orderBy("month_day").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    out = (dense.join(counted, [series, "month_day"], "full")
           .withColumn("cumulative", F.sum(F.coalesce("n", F.lit(0))).over(w))
           .where("_shown").drop("n", "_shown"))
    if until is None:
        return out
    return out.withColumn("cumulative", F.when(F.col("month_day") <= until, F.col("cumulative")))


def on_day(signups: DataFrame, date: str, month_day: int, person: str, project: str) -> DataFrame:
    """Distinct projects and signups overall, signups on one month-day, and that
    day's weekday name (blank when the years disagree)."""
    picked = month_day_number(date) == month_day
    tagged = signups.withColumn("_weekday", F.when(picked, F.date_format(date, "EEEE")))
    return tagged.agg(distinct_count(project).alias("projects"),
                      distinct_count(person).alias("signups"),
                      distinct_count(person, picked).alias("signups_on_day"),
                      single_value("_weekday", blank=False).alias("day_of_week"))


def by_place(signups: DataFrame, place: str, address: str, project: str,
             person: str) -> DataFrame:
    """Map points: first address, distinct projects and distinct signups per place."""
    return signups.groupBy(place).agg(F.min(address).alias("address"),
                                      distinct_count(project).alias("projects"),
                                      distinct_count(person).alias("signups"))
