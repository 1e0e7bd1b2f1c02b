"""Engagement summaries: distinct people in rolling windows, requests, members."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (dash_if_null, distinct_count, month_day_text, round_down,
                                 round_up)
from ..functions.dates import (as_date, as_timestamp, dayofweek, is_sunday, meetings_in_period,
                               trailing)


def window_flags(date: str, as_of) -> dict[str, Column]:
    """Past 90 and 365 days from as_of, and its calendar year."""
    c, on = F.col(date), as_timestamp(as_of)
    return {"past_90": c >= on - F.expr("INTERVAL 90 DAYS"),
            "year_to_date": F.year(c) == F.year(on),
            "past_365": c >= on - F.expr("INTERVAL 365 DAYS")}


def distinct_people(df: DataFrame, by: Sequence[str], person: str,
                    conditions: Mapping[str, Column],
                    attributes: DataFrame | None = None) -> DataFrame:
    """Distinct people per group under several conditions at once.

    One row per (group, person) with a flag per condition, then flags are counted:
    two map-side combined aggregates however many conditions there are, where a
    distinct count per condition would copy the input once for each. Group columns
    that belong to the person come from `attributes` (one row per person), joined to
    the flags rather than to the rows, so a busy person is one row by then. A blank
    person counts as one, without attributes.
    """
    own = [c for c in by if attributes is None or c not in attributes.columns]
    flags = [F.max(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()]
    people = df.groupBy(*own, person).agg(*flags)
    if attributes is not None:
        people = people.join(attributes, person, "left")
    return people.groupBy(*by).agg(*[F.count_if(F.col(n)).alias(n) for n in conditions])


def launch_events(steps: DataFrame, as_of, date: str = "started_at",
                  homes: DataFrame | None = None) -> DataFrame:
    """Distinct people by campus and step in each window; the campus is the step's, or
    the person's when `homes` (person_id, campus_id) is given."""
    return distinct_people(steps, ["campus_id", "step_name"], "person_id",
                           window_flags(date, as_of), homes)


def requests_and_completions(requests: DataFrame, as_of, done: str,
                             by: Sequence[str] = ("campus_id", "opportunity_name")) -> DataFrame:
    """Requests, and requests with the completed status (in any case), created in the
    last 90 and 365 days; every group has a row."""
    recent = window_flags("created_at", as_of)
    completed = F.lower("status") == done.lower()
    return requests.groupBy(*by).agg(
        F.count_if(recent["past_90"]).alias("requests_90"),
        F.count_if(recent["past_365"]).alias("requests_365"),
        F.count_if(recent["past_90"] & completed & F.col("updated_at").isNotNull())
        .alias("completed_90"),
        F.count_if(recent["past_365"] & completed & F.col("updated_at").isNotNull())
        .alias("completed_365"))


# Group types of the Sunday team summary.
SUNDAY_TEAM_TYPES = (102, 110)


def sunday_summary(check_ins: DataFrame, types: Sequence = SUNDAY_TEAM_TYPES) -> DataFrame:
    """Distinct people checked in, and there for the first time, by campus and Sunday."""
    rows = check_ins.where(F.col("type_id").isin(list(types)) & is_sunday("occurrence_date"))
    return distinct_people(rows, ["campus_id", "occurrence_date"], "person_id",
                           {"check_ins": F.col("did_attend"),
                            "first_time": F.col("is_first_time")})


def serving_averages(summary: DataFrame, active_members: Column, as_of) -> DataFrame:
    """Average people serving per Sunday since as_of - (35 + weekday number), rounded
    up; active members not serving, never below 0; first-timers since then and this
    year."""
    on = as_date(as_of)
    recent = F.col("occurrence_date") >= F.date_sub(on, 35 + dayofweek(on))
    sums = summary.groupBy("occurrence_date").agg(
        F.sum("check_ins").alias("check_ins"), F.sum("first_time").alias("first_time"))
    base = sums.agg(
        F.sum(F.when(recent, F.col("check_ins"))).alias("n"),
        F.count_if(recent).alias("sundays"),
        F.sum(F.when(recent, F.col("first_time"))).alias("new_recent"),
        F.sum(F.when(F.year("occurrence_date") == F.year(on), F.col("first_time")))
        .alias("new_this_year"))
    serving = round_up(F.try_divide(F.col("n").cast("double"), F.col("sundays")))
    idle = F.greatest(F.lit(0), round_down(F.col("active_members") - F.col("serving")))
    return (base.withColumn("active_members", active_members)
            .withColumn("serving", serving)
            .select("active_members", "serving",
                    F.when(F.col("serving").isNotNull(), idle).alias("not_serving"),
                    "new_recent", "new_this_year"))


def active_members(members: DataFrame, type_id) -> DataFrame:
    """Distinct people and groups of one group type."""
    one = members.where(F.col("type_id") == type_id)
    return (one.groupBy("person_id", "group_id").agg(F.lit(1).alias("_"))
            .agg(distinct_count("person_id").alias("active_people"),
                 distinct_count("group_id").alias("active_groups")))


def new_members(members: DataFrame, as_of, by: Sequence[str] = ("type_id",),
                date: str = "created_at") -> DataFrame:
    """Memberships created in the last 7, 90 and 365 days and this calendar year."""
    on, flags = as_timestamp(as_of), window_flags(date, as_of)
    return members.groupBy(*by).agg(
        F.count_if(F.col(date) >= on - F.expr("INTERVAL 7 DAYS")).alias("past_7"),
        *[F.count_if(c).alias(n) for n, c in flags.items()])


# Group types whose check-ins the group report counts.
REPORTED_TYPES = (19, 20, 60, 68, 69, 85, 128)


def check_in_counts(check_ins: DataFrame, as_of, types: Sequence = REPORTED_TYPES) -> DataFrame:
    """Check-ins and first-time check-ins of the last five weeks and this year."""
    on, day = as_date(as_of), F.col("occurrence_date")
    recent, year = day > F.date_sub(on, 35), F.year(day) == F.year(on)
    first = F.coalesce("is_first_time", F.lit(False))
    return (check_ins.where(F.col("did_attend") & F.col("type_id").isin(list(types)))
            .agg(F.count_if(recent).alias("check_ins_5_weeks"),
                 F.count_if(year).alias("check_ins_year"),
                 F.count_if(recent & first).alias("new_5_weeks"),
                 F.count_if(year & first).alias("new_year")))


def answers(values: DataFrame, as_of, wanted: str = "yes") -> DataFrame:
    """Answers equal to a word, whatever their case, in each window."""
    hits = values.where(F.lower("value") == wanted.lower())
    return hits.agg(*[F.count_if(c).alias(n)
                      for n, c in window_flags("created_at", as_of).items()])


def latest_check_in_label(check_ins: DataFrame, type_id) -> DataFrame:
    """'Last Checkin - MM/dd' of a group type, or '-'."""
    newest = check_ins.where(F.col("type_id") == type_id).agg(
        F.max("occurrence_date").alias("d"))
    return newest.select(dash_if_null(F.concat(
        F.lit("Last Checkin - "), month_day_text("d"))).alias("latest_check_in"))


def social_signups(members: DataFrame, as_of, type_id) -> DataFrame:
    """Distinct people who joined a group of the type in the last 35 days."""
    since = as_timestamp(as_of) - F.expr("INTERVAL 35 DAYS")
    return (members.where((F.col("type_id") == type_id) & (F.col("created_at") >= since))
            .agg(distinct_count("person_id").alias("signups")))


def meetings_held(groups: DataFrame, as_of, by: Sequence[str] = ("meeting_rhythm",)) -> DataFrame:
    """Meetings of the last 35 days from each group's start date and rhythm."""
    held = meetings_in_period("start_date", "meeting_rhythm", as_of)
    return groups.withColumn("meetings", held).groupBy(*by).agg(
        F.sum("meetings").alias("meetings"))


# Comparison periods, in display order.
PERIODS = {"past_365": "Past 365 Days", "year_to_date": "Year To Date", "past_90": "Past 90 Days"}


def comparison(counts: DataFrame, label: str) -> DataFrame:
    """One row per class and period from one row of window counts per class."""
    cells = ", ".join(f"'{text}', {order}, {name}"
                      for order, (name, text) in enumerate(PERIODS.items(), start=1))
    return counts.select(F.col(label).alias("class"), F.expr(
        f"stack({len(PERIODS)}, {cells}) AS (time_period, sort_order, value)"))


def date_range_label(as_of, days: int = 35) -> Column:
    on = as_date(as_of)
    return F.concat(month_day_text(F.date_sub(on, days)), F.lit(" - "), month_day_text(on))


# --- report visuals --------------------------------------------------------------------

def team_table(groups: DataFrame, type_id) -> DataFrame:
    """Members summed by group name for one group type."""
    return groups.where(F.col("type_id") == type_id).groupBy("group_name").agg(
        F.sum("member_count").alias("members"))


def check_in_matrix(check_ins: DataFrame, groups: DataFrame, as_of, type_names: Sequence[str],
                    types: Sequence = REPORTED_TYPES) -> DataFrame:
    """Check-ins and first-time check-ins by group name, for groups that are not
    archived and of the listed type names. Counted per group before the join."""
    on, day = as_date(as_of), F.col("occurrence_date")
    recent, year = day > F.date_sub(on, 35), F.year(day) == F.year(on)
    first = F.coalesce("is_first_time", F.lit(False))
    counts = {"new_5_weeks": recent & first, "check_ins_5_weeks": recent,
              "new_year": year & first, "check_ins_year": year}
    per_group = (check_ins.where(F.col("did_attend") & F.col("type_id").isin(list(types)))
                 .groupBy("group_id").agg(*[F.count_if(c).alias(n) for n, c in counts.items()]))
    shown = groups.where(~F.col("is_archived") & F.col("type_name").isin(list(type_names)))
    return (shown.select("group_id", "group_name").join(per_group, "group_id")
            .groupBy("group_name").agg(*[F.sum(n).alias(n) for n in counts]))


def sunday_trend(summary: DataFrame, as_of, days: int = 35) -> DataFrame:
    """Check-ins and first-timers by date over the last days up to as_of."""
    return (summary.where(trailing("occurrence_date", as_of, days))
            .groupBy("occurrence_date").agg(F.sum("check_ins").alias("check_ins"),
                                            F.sum("first_time").alias("first_time")))


def chart_sums(summary: DataFrame, values: Sequence[str], category: str | None = None,
               ) -> DataFrame:
    """Summed values by category, or over everything."""
    return summary.groupBy(*([category] if category else [])).agg(
        *[F.sum(v).alias(v) for v in values])
