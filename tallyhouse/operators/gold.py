"""Gold dimensions, facts and marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import (CONNECT_GROUP_OPPORTUNITIES, CONNECT_GROUP_TYPE, DOOR_HOLDER_GROUP_TYPE,
                      DOOR_HOLDER_OPPORTUNITY)
from ..functions.columns import date_key, surrogate_key
from ..functions.dates import age_years, as_date


def dim_group(groups: DataFrame, group_types: DataFrame, campuses: DataFrame,
              door_holder_type: int = DOOR_HOLDER_GROUP_TYPE,
              connect_type: int = CONNECT_GROUP_TYPE) -> DataFrame:
    types = group_types.select("group_type_id", F.col("name").alias("group_type_name"))
    places = campuses.select("campus_id", F.col("name").alias("campus_name"))

    def is_type(type_id: int):
        return F.coalesce(F.col("group_type_id") == type_id, F.lit(False))

    return (groups.join(types, "group_type_id", "left").join(places, "campus_id", "left")
            .select(surrogate_key("group_id").alias("group_key"), "group_id", "group_guid",
                    "name", "parent_group_id", "group_type_id", "group_type_name", "campus_id",
                    "campus_name", is_type(door_holder_type).alias("is_door_holder_team"),
                    is_type(connect_type).alias("is_connect_group"), "is_security_role",
                    "is_active", "is_archived", "is_currently_active", "created_at",
                    "updated_at"))


# The roles a dictionary value plays for a person.
PERSON_ROLES = ("marital_status", "record_type", "record_status", "connection_status")


def dim_person(people: DataFrame, defined_values: DataFrame, campuses: DataFrame) -> DataFrame:
    """One row per person record, one dictionary decoded in four roles."""
    out = people
    for role in PERSON_ROLES:
        lookup = defined_values.select(F.col("defined_value_id").alias(f"{role}_value_id"),
                                       F.col("value").alias(role))
        out = out.join(lookup, f"{role}_value_id", "left")
    places = campuses.select(F.col("campus_id").alias("primary_campus_id"),
                             F.col("name").alias("campus_name"))
    return (out.join(places, "primary_campus_id", "left")
            .select(surrogate_key("person_id").alias("person_key"), "person_id", "person_guid",
                    "display_name", "first_name", "last_name", "full_name", "gender",
                    "birth_date", "birth_year", *PERSON_ROLES, "email", "is_email_active",
                    "email_preference", F.col("primary_campus_id").alias("campus_id"),
                    "campus_name", "primary_family_id", "is_active", "is_deceased",
                    "created_at", "updated_at"))


def resolve_alias(fact: DataFrame, aliases: DataFrame, alias_column: str, out: str) -> DataFrame:
    """Add the person behind an alias id; null when the alias is unknown. Alias ids
    are unique and spread, so the join is not skewed by a person with many aliases."""
    lookup = aliases.select(F.col("person_alias_id").alias(alias_column),
                            F.col("person_id").alias(out))
    return fact.join(lookup, alias_column, "left")


def fct_attendance(attendance: DataFrame, aliases: DataFrame, occurrences: DataFrame) -> DataFrame:
    when = occurrences.select("occurrence_id", "group_id", "location_id", "schedule_id",
                              "occurrence_date", "sunday_date", "did_occur")
    return (resolve_alias(attendance, aliases, "person_alias_id", "person_id")
            .join(when, "occurrence_id", "left")
            .select(surrogate_key("attendance_id").alias("attendance_key"), "attendance_id",
                    surrogate_key("person_id").alias("person_key"), "occurrence_id",
                    surrogate_key("group_id").alias("group_key"), "location_id", "schedule_id",
                    "campus_id", date_key("occurrence_date").alias("date_key"),
                    "occurrence_date", "sunday_date", "started_at", "ended_at", "did_attend",
                    "did_occur",
                    F.coalesce(F.col("did_attend") & F.col("did_occur"),
                               F.lit(False)).alias("is_check_in"),
                    "rsvp", "is_first_time", "is_scheduled_to_attend", "updated_at"))


def fct_connection_request(requests: DataFrame, aliases: DataFrame, opportunities: DataFrame,
                           door_holder: int = DOOR_HOLDER_OPPORTUNITY,
                           connect_group: Sequence[int] = CONNECT_GROUP_OPPORTUNITIES
                           ) -> DataFrame:
    names = opportunities.select("connection_opportunity_id",
                                 F.col("name").alias("opportunity_name"))
    opportunity = F.col("connection_opportunity_id")
    category = (F.when(opportunity == door_holder, "Door Holder")
                .when(opportunity.isin(list(connect_group)), "Connect Group")
                .otherwise("Other"))
    out = resolve_alias(requests, aliases, "person_alias_id", "person_id")
    out = resolve_alias(out, aliases, "connector_person_alias_id", "connector_person_id")
    return (out.join(names, "connection_opportunity_id", "left")
            .select(surrogate_key("connection_request_id").alias("connection_request_key"),
                    "connection_request_id", surrogate_key("person_id").alias("person_key"),
                    surrogate_key("connector_person_id").alias("connector_person_key"),
                    "connection_opportunity_id", "opportunity_name", "connection_type_id",
                    category.alias("request_category"),
                    surrogate_key("assigned_group_id").alias("assigned_group_key"),
                    "campus_id", "connection_state", "is_connected", "days_to_connect",
                    "due_date", "was_completed_on_time", "created_date_key", "created_at",
                    date_key("connected_at").alias("connected_date_key"), "connected_at",
                    "updated_at"))


def fct_group_membership(members: DataFrame) -> DataFrame:
    return members.select(
        surrogate_key("group_member_id").alias("group_member_key"), "group_member_id",
        surrogate_key("person_id").alias("person_key"),
        surrogate_key("group_id").alias("group_key"), "group_role_id", "group_member_status",
        "is_archived", "is_currently_active_member", date_key("added_at").alias("added_date_key"),
        "added_at", "inactive_at", "archived_at", "updated_at")


def check_in_history(check_ins: DataFrame, as_of, person: str = "person_key") -> DataFrame:
    """Check-ins per person: all, first and last date, last 90 days, last 12 calendar
    months, different weeks, weekend services and serving.

    Counted in two steps, first per person and day. That leaves at most one row per
    person and day for the second shuffle, so the distinct week count needs no
    second copy of the data and a very busy person stays small.
    """
    on = as_date(as_of)
    recent = F.col("occurrence_date") >= F.date_sub(on, 90)
    year = F.col("occurrence_date") >= F.add_months(on, -12)
    daily = (check_ins.groupBy(person, "occurrence_date", "sunday_date")
             .agg(F.count("*").alias("n"),
                  F.count_if("counts_as_weekend_service").alias("weekend"),
                  F.count_if("is_door_holder_team").alias("serving")))

    def total(condition, column: str):
        return F.coalesce(F.sum(F.when(condition, F.col(column))), F.lit(0))

    return daily.groupBy(person).agg(
        F.sum("n").alias("check_ins_total"),
        F.min("occurrence_date").alias("first_check_in_date"),
        F.max("occurrence_date").alias("last_check_in_date"),
        total(recent, "n").alias("check_ins_last_90_days"),
        total(year, "n").alias("check_ins_last_12_months"),
        F.size(F.collect_set(F.when(year, F.col("sunday_date")))).cast("bigint")
        .alias("weeks_checked_in_last_12_months"),
        total(year, "weekend").alias("weekend_service_check_ins_last_12_months"),
        total(year, "serving").alias("serving_check_ins_last_12_months"))


def door_holder_engagement(membership: DataFrame, groups: DataFrame, people: DataFrame,
                           requests: DataFrame, attendance: DataFrame, aliases: DataFrame,
                           occurrences: DataFrame, group_types: DataFrame, as_of) -> DataFrame:
    """One row per person who was ever on a door holder team.

    Every child is aggregated to one row per person before the joins, which keeps
    hot people out of the joins and avoids fan-out.
    """
    on = as_date(as_of)
    flags = groups.select("group_key", "is_door_holder_team", "is_connect_group",
                          F.col("is_currently_active").alias("_group_active"))
    active = F.col("is_currently_active_member") & F.col("_group_active")
    served = (membership.join(flags, "group_key")
              .withColumn("_active", active)
              .groupBy("person_key")
              .agg(F.count_if("is_door_holder_team").alias("_memberships"),
                   F.bool_or(F.when(F.col("is_door_holder_team"), F.col("_active")))
                   .alias("is_active_door_holder"),
                   F.count_if(F.col("is_door_holder_team") & F.col("_active"))
                   .alias("active_door_holder_team_count"),
                   F.min(F.when(F.col("is_door_holder_team"), F.to_date("added_at")))
                   .alias("first_door_holder_added_date"),
                   F.count_if(F.col("is_connect_group") & F.col("_active"))
                   .alias("active_connect_group_count")))
    holders = served.where("_memberships > 0").drop("_memberships")

    asked = (requests.where((F.col("request_category") == "Door Holder")
                            & F.col("person_key").isNotNull())
             .groupBy("person_key")
             .agg(F.count("*").alias("door_holder_request_count"),
                  F.min(F.to_date("created_at")).alias("first_door_holder_request_date"),
                  F.bool_or("is_connected").alias("has_connected_door_holder_request")))

    kinds = group_types.select("group_type_id", F.col("attendance_counts_as_weekend_service")
                               .alias("counts_as_weekend_service"))
    held = (occurrences.where("did_occur")
            .join(groups.select("group_id", "group_type_id", "is_door_holder_team"),
                  "group_id", "left")
            .join(kinds, "group_type_id", "left")
            .select("occurrence_id", "occurrence_date", "sunday_date", "is_door_holder_team",
                    "counts_as_weekend_service"))
    # A hot alias or occurrence is split by the optimizer's skew join, and the
    # first aggregate of the history is map-side combined.
    check_ins = (attendance.where("did_attend").select("person_alias_id", "occurrence_id")
                 .join(aliases.select("person_alias_id",
                                      surrogate_key("person_id").alias("person_key")),
                       "person_alias_id")
                 .join(holders.select("person_key"), "person_key", "left_semi")
                 .join(held, "occurrence_id"))
    history = check_in_history(check_ins, as_of)

    def or_zero(*names: str):
        return [F.coalesce(n, F.lit(0)).alias(n) for n in names]

    return (holders.join(people, "person_key")
            .join(history, "person_key", "left").join(asked, "person_key", "left")
            .select("person_key", "person_id", "full_name", "gender", "marital_status",
                    "campus_id", "campus_name", F.col("is_active").alias("is_person_active"),
                    age_years("birth_date", on).alias("age"),
                    F.coalesce("is_active_door_holder", F.lit(False))
                    .alias("is_active_door_holder"),
                    "active_door_holder_team_count", "first_door_holder_added_date",
                    F.datediff(on, "first_door_holder_added_date")
                    .alias("days_since_first_joined"),
                    *or_zero("check_ins_total"), "first_check_in_date", "last_check_in_date",
                    F.datediff(on, "last_check_in_date").alias("days_since_last_check_in"),
                    *or_zero("check_ins_last_90_days", "check_ins_last_12_months",
                             "weeks_checked_in_last_12_months",
                             "weekend_service_check_ins_last_12_months",
                             "serving_check_ins_last_12_months"),
                    (F.col("active_connect_group_count") > 0).alias("is_in_connect_group"),
                    "active_connect_group_count", *or_zero("door_holder_request_count"),
                    "first_door_holder_request_date",
                    F.coalesce("has_connected_door_holder_request", F.lit(False))
                    .alias("has_connected_door_holder_request")))


# The giving-journey columns of the restricted mart.
JOURNEY_COLUMNS = ("current_journey_giving_stage", "previous_journey_giving_stage",
                   "journey_giving_stage_change_date", "giving_bin", "giving_percentile",
                   "next_expected_gift_date")


def door_holder_giving(engagement: DataFrame, current: DataFrame) -> DataFrame:
    """Giving journey of each door holder, kept apart from the engagement mart."""
    journey = current.select("person_id", *JOURNEY_COLUMNS,
                             F.col("_bronze_loaded_at").alias("giving_data_loaded_at"))
    return (engagement.select("person_key", "person_id").join(journey, "person_id", "left")
            .select("person_key", *JOURNEY_COLUMNS, "giving_data_loaded_at"))


# The gold date dimension's range.
DATE_DIM_START, DATE_DIM_END = "2000-01-01", "2040-12-31"


def dim_date(spark: SparkSession, start: str = DATE_DIM_START,
             end: str = DATE_DIM_END) -> DataFrame:
    from .calendar import date_attributes, date_spine

    return date_attributes(date_spine(spark, start, end, "date_day"), "date_day")
