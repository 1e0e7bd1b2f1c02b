"""Easter and Christmas reports over special-Sunday counts.

Input rows: (year, event, campus, literal, schedule, schedule_sort, cnt).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import change_ratio, safe_divide

BAR_CAP = 0.5  # Fixed value: a change of 50 % fills the bar.


def _total(condition, value: str = "cnt"):
    return F.sum(F.when(condition, F.col(value)))


def holiday_comparison(special: DataFrame, event: str, year: int, campuses: Sequence[str],
                       bar_cap: float = BAR_CAP) -> DataFrame:
    """This year against last year, service by service, for each campus and all.

    Service times change between years, so services are aligned by their rank
    within (ministry, year); services sharing a sort number share the higher rank.
    Rank 0 is the total row. Every ministry has every rank of its scope; a cell
    with no count in either year is 'empty', in one year 'new' or 'gone', and only
    'ok' cells have a ratio and a bar.
    """
    src = special.where((F.col("event") == event) & F.col("year").isin(year, year - 1)
                        & F.col("campus").isin(list(campuses)))
    keys = ["scope", "literal", "year"]
    base = (src.groupBy("campus", "literal", "year", "schedule", "schedule_sort")
            .agg(F.sum("cnt").alias("v"))
            .withColumn("scope", F.explode(F.array(F.lit("All"), F.col("campus"))))
            .groupBy(*keys, "schedule", "schedule_sort").agg(F.sum("v").alias("v")))
    upto = Window.partitionBy(*keys).orderBy("schedule_sort").rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    # A missing sort number compares as blank: such a service precedes all others.
    ranked = base.withColumn("rank", F.count("*").over(upto).cast("int"))
    this, last = F.col("year") == year, F.col("year") == year - 1

    def names(condition):
        pairs = F.sort_array(F.collect_list(F.when(condition,
                                                   F.struct("schedule_sort", "schedule"))))
        return F.array_join(F.transform(pairs, lambda p: p["schedule"]), " / ")

    # Each service counts once under its rank and once under the total row.
    cells = (ranked.withColumn("rank", F.explode(F.array(F.col("rank"), F.lit(0))))
             .groupBy("scope", "literal", "rank")
             .agg(_total(this, "v").alias("current"), _total(last, "v").alias("previous"),
                  names(this & (F.col("rank") > 0)).alias("service"),
                  names(last & (F.col("rank") > 0)).alias("previous_service")))
    every_rank = (ranked.groupBy("scope")
                  .agg(F.max("rank").alias("top"), F.collect_set("literal").alias("literals"))
                  .select("scope", F.explode("literals").alias("literal"), "top")
                  .select("scope", "literal", F.explode(F.sequence(F.lit(0), F.col("top")))
                          .alias("rank")))
    rows = every_rank.join(cells, ["scope", "literal", "rank"], "left")
    none_now = F.coalesce("current", F.lit(0)) == 0
    none_then = F.coalesce("previous", F.lit(0)) == 0
    ratio = F.when(F.col("state") == "ok", F.round(safe_divide(
        F.col("current") - F.col("previous"), "previous"), 6))
    bar = F.when(F.col("state") == "ok", F.least(
        F.lit(100), F.round(F.abs("ratio") / bar_cap * 100).cast("int"))).otherwise(0)
    return (rows.withColumn("state", F.when(none_now & none_then, "empty")
                            .when(none_then, "new").when(none_now, "gone").otherwise("ok"))
            .withColumn("ratio", ratio).withColumn("bar", bar)
            .withColumns({c: F.coalesce(c, F.lit("")) for c in ("service", "previous_service")}))


def holiday_totals(special: DataFrame, year: int, by: Sequence[str] = ("event",)) -> DataFrame:
    """This and last year's counts, with the change (0 without a base)."""
    return (special.groupBy(*by).agg(
        _total(F.col("year") == year).alias("current"),
        _total(F.col("year") == year - 1).alias("previous"))
        .withColumn("yoy", change_ratio("current", "previous", 0)))


def holiday_series(special: DataFrame, year: int, campuses: Sequence[str],
                   years: int = 5) -> DataFrame:
    """The last years' counts of each event, a column per campus and their total (0
    if none), with the first and last year the event has data for."""
    span = special.groupBy("event").agg(F.min("year").alias("first_year"),
                                        F.max("year").alias("last_year"))

    def or_zero(c):
        return F.coalesce(c, F.lit(0))

    here = F.col("campus").isin(list(campuses))
    wide = (special.where(F.col("year").between(year - years + 1, year))
            .groupBy("event", "year")
            .agg(or_zero(_total(here)).alias("all_campuses"),
                 *[or_zero(_total(F.col("campus") == c)).alias(f"campus_{c}")
                   for c in campuses]))
    return wide.join(span, "event")
