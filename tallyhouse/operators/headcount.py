"""The weekly headcount fact: one count per Sunday, campus, ministry and service.

Once aggregated it is bounded by calendar x campuses x services x ministries, so
windows over it are small whatever the size of the feeds below it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import as_col, rank_in
from ..functions.dates import us_week_number

GRAIN = ("sunday_date", "campus", "schedule", "literal", "city", "event")

# Schedule names in order of the day (special and monthly Sundays).
SERVICE_TIMES = ("8:00am", "8:30am", "9:00am", "9:15am", "9:30am", "10:00am", "10:30am",
                 "11:00am", "11:30am", "11:45am", "12:00pm", "12:30pm", "1:30pm", "2:00pm",
                 "2:30pm", "3:00pm", "3:30pm", "4:00pm", "5:00pm")
# Regular-Sunday schedule and ministry orders.
REGULAR_SCHEDULE_ORDER = ("9:30am", "11:30am", "11:45am", "5pm")
LITERAL_ORDER = ("Adults", "Door Holder", "HS", "MS", "PK", "bloom")
# The regular event, and Christmas Eve Sundays kept out of its report.
REGULAR_EVENT = "Sunday Gathering"
SKIPPED_EVES = ("2016-12-24", "2017-12-24", "2019-12-24", "2020-12-24", "2021-12-24",
                "2022-12-24", "2023-12-24", "2024-12-24")
# Service slots by schedule name.
SERVICE_SLOTS = {"9:30am Gathering": ("9:15am", "9:30am"),
                 "11:45am Gathering": ("11:00am", "11:45am")}


def feed(df: DataFrame, literal: str, value: str = "value") -> DataFrame:
    """One metric feed summed to (city, date, campus, schedule, event) and tagged."""
    keys = [c for c in GRAIN if c != "literal" and c in df.columns]
    return (df.groupBy(*keys).agg(F.sum(value).alias("cnt"))
            .withColumn("literal", F.lit(literal)))


def union_feeds(feeds: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column a feed lacks is null there."""
    out = feeds[0]
    for other in feeds[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def regroup(feeds: DataFrame) -> DataFrame:
    """Sum the united feeds to one row per grain."""
    keys = [c for c in GRAIN if c in feeds.columns]
    return feeds.groupBy(*keys).agg(F.sum("cnt").alias("cnt"))


def city_label(campus, far_campus: str, label: str, home: str):
    """The far campus's city label, or the home city; null without a campus."""
    c = as_col(campus)
    return F.when(c == far_campus, label).when(c != far_campus, home)


def service_slot(schedule, slots: Mapping[str, Sequence[str]] = SERVICE_SLOTS):
    c = as_col(schedule)
    out = F.lit(None).cast("string")
    for slot, names in reversed(list(slots.items())):
        out = F.when(c.isin(list(names)), slot).otherwise(out)
    return out


def with_sort_orders(hc: DataFrame, campuses: Sequence[str],
                     literals: Sequence[str] = LITERAL_ORDER,
                     schedules: Sequence[str] = REGULAR_SCHEDULE_ORDER) -> DataFrame:
    """Fixed sort numbers; unlisted schedules and campuses sort last, unlisted
    ministries get 99, and the time-of-day order has no number for other names."""
    return hc.withColumns({
        "schedule_order": rank_in("schedule", list(schedules), len(schedules) + 1),
        "campus_order": rank_in("campus", list(campuses), len(campuses) + 1),
        "literal_order": rank_in("literal", list(literals), 99),
        "schedule_sort": rank_in(F.trim(as_col("schedule")), list(SERVICE_TIMES), None)})


def in_person(hc: DataFrame, online: str = "Online", event: str | None = None,
              city: str | None = None, skip_dates: Sequence[str] = ()) -> DataFrame:
    """Regular in-person rows: a named campus that is not online, one event and
    city if given, without listed dates."""
    out = hc.where(~F.col("campus").eqNullSafe(online))
    if event is not None:
        out = out.where(F.col("event") == event)
    if city is not None:
        out = out.where(F.col("city") == city)
    if skip_dates:
        skipped = [F.lit(d).cast("date") for d in skip_dates]
        out = out.where(~F.col("sunday_date").isin(skipped))
    return out


def date_index(hc: DataFrame, date: str = "sunday_date") -> DataFrame:
    """Give every row its date's dense index, the newest date being 1. Ranked over
    the distinct dates only (one row per date), then joined back."""
    dates = hc.select(date).distinct()
    ranked = dates.withColumn("date_index", F.row_number().over(Window.orderBy(F.desc(date))))
    return hc.join(ranked, date, "left")


def positional_previous(hc: DataFrame, order: Sequence[str], offset: int = 7) -> DataFrame:
    """The count `offset` rows earlier in a total order, and the ratio to it (zero
    counts divide to null). Rows are numbered within the first two order columns and
    shifted by the rows of the groups before, one row per group; the earlier count is
    found by its number. The order has to be total. `hc` is read three times."""
    first, then = list(order[:2]), list(order[2:])
    before = Window.orderBy(*first).rowsBetween(Window.unboundedPreceding, -1)
    starts = hc.groupBy(*first).agg(F.count("*").alias("_n")).select(
        *first, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    local = F.row_number().over(Window.partitionBy(*first).orderBy(*(then or first))) - 1
    numbered = (hc.withColumn("_local", local).alias("h").join(starts.alias("s"), [
        F.col(f"h.{c}").eqNullSafe(F.col(f"s.{c}")) for c in first])
        .select("h.*", (F.col("_start") + F.col("_local")).cast("int").alias("row_index"))
        .drop("_local"))
    earlier = numbered.select((F.col("row_index") + offset).alias("_index"),
                              F.col("cnt").alias("prev_week"))
    return numbered.join(earlier, F.col("row_index") == F.col("_index"), "left").drop(
        "_index").withColumn(
        "wow", F.round(F.try_divide((F.col("cnt") - F.col("prev_week")).cast("double"),
                                    F.col("prev_week").cast("double")), 6))


# --- the report tables -------------------------------------------------------------------

def regular_sundays(grouped: DataFrame, city: str, campuses: Sequence[str],
                    skip_dates: Sequence[str] = SKIPPED_EVES) -> DataFrame:
    """Regular in-person Sundays of one city with their week, sort orders and date
    index. The index counts the dates of every in-person row, before the event, city
    and skipped dates are picked. `grouped` (the regrouped feeds) is read twice, so it
    should be a table or kept."""
    indexed = with_sort_orders(date_index(in_person(grouped)), campuses)
    return in_person(indexed, event=REGULAR_EVENT, city=city, skip_dates=skip_dates).withColumn(
        "week_of_year", us_week_number("sunday_date"))


def online_sundays(grouped: DataFrame, city: str, online: str = "Online",
                   skip_dates: Sequence[str] = ("2024-12-24",)) -> DataFrame:
    """Online Sundays of one city. The previous value is positional over all rows,
    online or not, as the report takes it."""
    order = ["literal", "sunday_date", "campus", "schedule", "city", "event"]
    rows = positional_previous(grouped, order)
    kept = rows.where((F.col("campus") == online) & (F.col("city") == city))
    skipped = [F.lit(d).cast("date") for d in skip_dates]
    return kept.where(~F.col("sunday_date").isin(skipped)).withColumn(
        "week_of_year", us_week_number("sunday_date"))


def monthly_gatherings(grouped: DataFrame, city: str,
                       campuses: Sequence[str]) -> DataFrame:
    """In-person monthly gatherings (and special Sundays) of one city, schedule names
    trimmed and numbered by time of day."""
    return with_sort_orders(in_person(grouped, city=city), campuses).withColumns({
        "schedule": F.trim("schedule"), "week_of_year": us_week_number("sunday_date")})
