"""Generated calendars: spines, the date dimension, axes and holiday tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import (ZERO_WIDTH_SPACE, as_col, date_key, month_day_text,
                                 month_year_text)
from ..functions.dates import (as_date, christmas_eve, dayofweek, easter, holiday_status,
                               in_year_2000, last_sunday, month_day_number, month_start,
                               us_week_number, week_ending_sunday, yymm_number, yyyyww_text)


def date_spine(spark: SparkSession, start: str, end: str, name: str = "date_day") -> DataFrame:
    """One row per day, both ends included, generated in parallel."""
    import datetime as dt

    first, last = (dt.date.fromisoformat(d) for d in (start, end))
    days = (last - first).days + 1
    return spark.range(days).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias(name))


def spine_to_max(facts: DataFrame, date: str, start, name: str = "date_day",
                 end: Column | None = None) -> DataFrame:
    """One row per day from `start` to the newest fact date. The bounds come from
    one aggregate row; the result is bounded by the calendar."""
    last = F.max(as_col(date).cast("date"))
    return (facts.agg(last.alias("_last"))
            .select(F.explode(F.sequence(as_date(start), F.col("_last"))).alias(name)))


def auto_calendar(facts: DataFrame, date: str, name: str = "date_day") -> DataFrame:
    """Every day of every year a date column covers: January 1 of the first year to
    December 31 of the last, with the Year > Quarter > Month > Day hierarchy."""
    year = F.year(as_col(date))
    bounds = facts.agg(F.min(year).alias("_a"), F.max(year).alias("_b"))
    days = bounds.select(F.explode(F.sequence(
        F.make_date("_a", F.lit(1), F.lit(1)),
        F.make_date("_b", F.lit(12), F.lit(31)))).alias(name))
    d = F.col(name)
    return days.select(
        name, F.year(d).alias("year"), F.month(d).alias("month_no"),
        F.date_format(d, "MMMM").alias("month"), F.quarter(d).alias("quarter_no"),
        F.concat(F.lit("Qtr "), F.quarter(d).cast("string")).alias("quarter"),
        F.dayofmonth(d).alias("day"))


def fact_dates(facts: DataFrame, date: str, name: str = "date_day") -> DataFrame:
    """The dates that have facts."""
    return facts.select(as_col(date).cast("date").alias(name)).distinct()


def date_attributes(dates: DataFrame, date: str) -> DataFrame:
    """The date dimension's columns; weeks run Monday to Sunday, weekday 1 is Sunday."""
    d = F.col(date)
    return dates.select(
        date_key(d).alias("date_key"), d.alias("date_day"),
        F.year(d).alias("calendar_year"), F.quarter(d).alias("calendar_quarter"),
        F.month(d).alias("month_number"), F.date_format(d, "MMMM").alias("month_name"),
        month_start(d).alias("month_start_date"), dayofweek(d).alias("day_of_week_number"),
        F.date_format(d, "EEEE").alias("day_of_week_name"),
        dayofweek(d).isin(1, 7).alias("is_weekend"),
        week_ending_sunday(d).alias("sunday_date"))


def report_attributes(df: DataFrame, date: str) -> DataFrame:
    """Display and sort columns the report tables carry beside a date."""
    d = F.col(date)
    return df.withColumns({
        "formatted_date": month_year_text(d), "year_month_number": yymm_number(d),
        "day_sort": F.date_format(d, "yyyyMMdd"), "short_day_sort": F.date_format(d, "yyMMdd"),
        "week_number": us_week_number(d), "rolling_week_sort": yyyyww_text(d),
        "week_start_date": last_sunday(d), "month_start_date": month_start(d),
        "year_month": F.date_format(d, "yyyy-MM"),
        "year_quarter": F.concat(F.date_format(d, "yyyy"), F.lit("-Q"),
                                 F.quarter(d).cast("string"))})


def day_axis(dates: DataFrame, date: str) -> DataFrame:
    """Slicer columns: MM/DD text, month-day number, the day in 2000, days since the
    first date, a label on every second day, and the weekday name."""
    d = F.col(date)
    first = dates.agg(F.min(date).alias("first")).scalar()
    rank = F.datediff(d, first)
    even = F.pmod(rank, F.lit(2)) == 0
    return dates.select(
        d, month_day_text(d).alias("display_date"),
        month_day_number(d).alias("month_day_number"),
        in_year_2000(d).alias("normalized_date"), rank.alias("date_rank"),
        F.when(even, month_day_text(d)).otherwise(ZERO_WIDTH_SPACE).alias("axis_label"),
        F.date_format(d, "EEEE").alias("day_of_week_name"))


def day_numbers(spark: SparkSession, low: int = 1, high: int = 366) -> DataFrame:
    """Integer series of a day picker."""
    return spark.range(low, high + 1).select(F.col("id").alias("day"))


def literal_axis(spark: SparkSession, **axes: Sequence) -> DataFrame:
    """Every combination of literal axis values, built by exploding literals (a
    product of constants, never a join). Each axis also gets its 1-based order."""
    out = spark.range(1).select()
    for name, values in axes.items():
        rows = F.array(*[F.struct(F.lit(v).alias(name), F.lit(i).alias(f"{name}_order"))
                         for i, v in enumerate(values, start=1)])
        out = out.select("*", F.explode(rows).alias("_axis")).select(*out.columns, "_axis.*")
    return out


def holiday_sundays(years: DataFrame, year: str = "year") -> DataFrame:
    """Easter, and the Sunday of the week that holds December 24, for each year."""
    events = F.array(
        F.struct(F.lit("Easter").alias("event"), easter(year).alias("holiday_date")),
        F.struct(F.lit("Christmas").alias("event"), christmas_eve(year).alias("holiday_date")))
    return (years.select(year, F.explode(events).alias("h")).select(year, "h.*")
            .withColumn("sunday_date", week_ending_sunday("holiday_date")))


def year_range(spark: SparkSession, first: int, last: int) -> DataFrame:
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias("year"))


def special_sundays(rows: DataFrame, holidays: DataFrame) -> DataFrame:
    """Rows of holiday Sundays with their year and event. The holiday table has two
    rows per year of a fixed range, so it is broadcast and other rows leave the scan."""
    days = holidays.select("year", "event", "sunday_date")
    return rows.join(F.broadcast(days), "sunday_date")


def holiday_state(holidays: DataFrame, totals: DataFrame, today) -> DataFrame:
    """Whether a holiday's report is shown, and the days left to it. `totals` holds
    (year, event) rows that have data."""
    found = totals.select("year", "event").distinct().withColumn("_found", F.lit(True))
    return (holidays.join(found, ["year", "event"], "left")
            .withColumns({
                "status": holiday_status(F.coalesce("_found", F.lit(False)), today,
                                         "holiday_date"),
                "days_to_holiday": F.datediff("holiday_date", as_date(today))})
            .drop("_found"))


def selected_or_latest(facts: DataFrame, date: str, selected) -> Column:
    """The selected date, or the newest fact date when none in or after 2020 is
    selected. A scalar subquery."""
    on = as_date(selected)
    newest = facts.agg(F.max(date).alias("newest")).scalar()
    return F.when(on.isNull() | (F.year(on) < 2020), newest).otherwise(on)
