"""The model graph: bronze tables to silver views to gold tables, and their checks."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TABLES, TableConfig
from ..sources.tables import materialise
from . import gold, quality
from . import staging as S

# Silver models by bronze table; two of them need the run date.
SILVER: dict[str, Callable[..., DataFrame]] = {
    "people": S.people, "person_aliases": S.person_aliases, "groups": S.groups,
    "group_members": S.group_members, "group_types": S.group_types,
    "attendance": S.attendance, "attendance_occurrences": S.occurrences,
    "campuses": S.campuses, "financial_accounts": S.financial_accounts,
    "financial_transactions": S.financial_transactions,
    "financial_transaction_details": S.financial_transaction_details,
    "connection_requests": S.connection_requests,
    "connection_opportunities": S.connection_opportunities,
    "defined_values": S.defined_values,
    "analytics_dim_person_historical": S.person_historical}
DATED = ("campuses", "financial_accounts")
# Silver names that differ from their bronze table's.
RENAMED = {"attendance_occurrences": "occurrences",
           "analytics_dim_person_historical": "person_historical"}


# The column spec behind each silver model.
SPECS: dict[str, S.Model] = {
    "people": S.PEOPLE, "person_aliases": S.PERSON_ALIASES, "groups": S.GROUPS,
    "group_members": S.GROUP_MEMBERS, "group_types": S.GROUP_TYPES,
    "attendance": S.ATTENDANCE, "attendance_occurrences": S.OCCURRENCES,
    "campuses": S.CAMPUSES, "financial_accounts": S.FINANCIAL_ACCOUNTS,
    "financial_transactions": S.FINANCIAL_TRANSACTIONS,
    "financial_transaction_details": S.TRANSACTION_DETAILS,
    "connection_requests": S.CONNECTION_REQUESTS,
    "connection_opportunities": S.CONNECTION_OPPORTUNITIES,
    "defined_values": S.DEFINED_VALUES,
    "analytics_dim_person_historical": S.PERSON_HISTORICAL}


def extract_configs(configs: Mapping[str, TableConfig] = TABLES) -> dict[str, TableConfig]:
    """Table configurations limited to the columns the silver models read."""
    out = {}
    for key, config in configs.items():
        needed = [config.primary_key, *SPECS[config.target].columns, config.modified_column]
        columns = dict.fromkeys(c for c in needed if c and c != "_loaded_at")
        out[key] = replace(config, columns=tuple(columns))
    return out


def silver(bronze: Callable[[str], DataFrame], as_of) -> dict[str, DataFrame]:
    """Every silver model, lazily, plus the current rows of the person history."""
    out = {}
    for table, model in SILVER.items():
        args = (as_of,) if table in DATED else ()
        out[RENAMED.get(table, table)] = model(bronze(table), *args)
    out["person_current"] = S.person_current(out["person_historical"])
    return out


def gold_models(spark: SparkSession, s: Mapping[str, DataFrame], as_of
                ) -> dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]]:
    """Gold builders in dependency order; each takes the gold models before it."""
    return {
        "dim_date": lambda g: gold.dim_date(spark),
        "dim_group": lambda g: gold.dim_group(s["groups"], s["group_types"], s["campuses"]),
        "dim_person": lambda g: gold.dim_person(s["people"], s["defined_values"], s["campuses"]),
        "fct_group_membership": lambda g: gold.fct_group_membership(s["group_members"]),
        "fct_connection_request": lambda g: gold.fct_connection_request(
            s["connection_requests"], s["person_aliases"], s["connection_opportunities"]),
        "fct_attendance": lambda g: gold.fct_attendance(
            s["attendance"], s["person_aliases"], s["occurrences"]),
        "door_holder_engagement": lambda g: gold.door_holder_engagement(
            g["fct_group_membership"], g["dim_group"], g["dim_person"],
            g["fct_connection_request"], s["attendance"], s["person_aliases"],
            s["occurrences"], s["group_types"], as_of),
        "door_holder_giving": lambda g: gold.door_holder_giving(
            g["door_holder_engagement"], s["person_current"])}


# The large fact is stored by week, the unit its reports read.
PARTITIONS = {"fct_attendance": "sunday_date"}


def build(spark: SparkSession, bronze: Callable[[str], DataFrame], as_of,
          database: str | None = None) -> dict[str, DataFrame]:
    """Silver as views, gold as tables; later gold models read the tables already
    written, so nothing is computed twice."""
    models = silver(bronze, as_of)
    for name, df in models.items():
        materialise(df, f"stg_{name}", as_table=False)
    built: dict[str, DataFrame] = {}
    for name, make in gold_models(spark, models, as_of).items():
        target = f"{database}.{name}" if database else name
        materialise(make(built), target, as_table=True, partition=PARTITIONS.get(name))
        built[name] = spark.table(target)
    return models | built


# Unique columns, other required columns, (column, parent, parent column)
# references, and accepted values of each model. References only warn.
UNIQUE = {
    "dim_date": ["date_key"], "dim_group": ["group_key", "group_id"],
    "dim_person": ["person_key", "person_id"], "fct_group_membership": ["group_member_key"],
    "fct_connection_request": ["connection_request_key"], "fct_attendance": ["attendance_key"],
    "door_holder_engagement": ["person_key"], "door_holder_giving": ["person_key"],
    "attendance": ["attendance_id"], "occurrences": ["occurrence_id"],
    "connection_requests": ["connection_request_id"],
    "financial_accounts": ["financial_account_id"],
    "financial_transactions": ["financial_transaction_id"],
    "financial_transaction_details": ["financial_transaction_detail_id"],
    "group_members": ["group_member_id"], "groups": ["group_id"], "people": ["person_id"],
    "person_historical": ["person_historical_id"],
    "person_current": ["person_historical_id", "person_id"],
    "person_aliases": ["person_alias_id"], "defined_values": ["defined_value_id"],
    "group_types": ["group_type_id"], "campuses": ["campus_id"],
    "connection_opportunities": ["connection_opportunity_id"]}
REQUIRED = {
    "dim_group": ["is_door_holder_team", "is_connect_group"], "dim_person": ["is_active"],
    "fct_group_membership": ["person_key", "group_key", "is_currently_active_member"],
    "fct_connection_request": ["request_category"], "fct_attendance": ["is_check_in"],
    "door_holder_engagement": ["is_active_door_holder", "check_ins_total",
                               "is_in_connect_group"],
    "attendance": ["occurrence_id", "did_attend"],
    "occurrences": ["occurrence_date", "did_occur"],
    "connection_requests": ["connection_opportunity_id", "person_alias_id", "is_connected"],
    "financial_accounts": ["name", "is_currently_active"],
    "financial_transaction_details": ["financial_transaction_id", "financial_account_id",
                                      "is_refund"],
    "group_members": ["group_id", "person_id", "is_currently_active_member"],
    "groups": ["is_currently_active"], "people": ["is_active"],
    "person_historical": ["person_id"], "person_aliases": ["person_id", "is_merged_alias"],
    "defined_values": ["defined_type_id", "value"], "group_types": ["name"],
    "campuses": ["name", "is_currently_open"], "connection_opportunities": ["name"]}
REQUIRED_WARN = {"fct_connection_request": ["person_key"], "people": ["email"]}
REFERENCES = {
    "fct_group_membership": [("person_key", "dim_person", "person_key"),
                             ("group_key", "dim_group", "group_key")],
    "fct_connection_request": [("person_key", "dim_person", "person_key")],
    "fct_attendance": [("person_key", "dim_person", "person_key"),
                       ("group_key", "dim_group", "group_key")],
    "attendance": [("occurrence_id", "occurrences", "occurrence_id")],
    "financial_accounts": [("parent_account_id", "financial_accounts", "financial_account_id")],
    "financial_transaction_details": [
        ("financial_transaction_id", "financial_transactions", "financial_transaction_id"),
        ("financial_account_id", "financial_accounts", "financial_account_id")],
    "group_members": [("group_id", "groups", "group_id"), ("person_id", "people", "person_id")],
    "person_aliases": [("person_id", "people", "person_id")]}
ACCEPTED = {"fct_connection_request": [
    ("request_category", ["Door Holder", "Connect Group", "Other"])]}


def bronze_checks(bronze: Callable[[str], DataFrame], as_of, configs=TABLES) -> DataFrame:
    """Checks of the source tables: every key unique and present, people as fresh as their
    newest load (severity says how late), and staging as long as bronze; one scan a table,
    and one of staging."""
    plan = quality.CheckPlan()
    tables = {c.target: bronze(c.target) for c in configs.values()}
    for c in configs.values():
        df = tables[c.target]
        plan.unique(df, c.primary_key, f"unique.{c.target}.{c.primary_key}")
        plan.not_null(df, c.primary_key, f"not_null.{c.target}.{c.primary_key}")
    people = tables["people"] if "people" in tables else bronze("people")
    if "_loaded_at" in people.columns:
        plan.fresh(people, "_loaded_at", "freshness.people")
    plan.same_row_count(people, S.people(people), "row_count.people")
    return plan.result(people.sparkSession, as_of)


def checks(models: Mapping[str, DataFrame]) -> DataFrame:
    """Every check whose models are given, each model read once: (check_name, failures,
    severity)."""
    plan = quality.CheckPlan()
    for name, df in models.items():
        for column in UNIQUE.get(name, []):
            plan.unique(df, column, f"unique.{name}.{column}")
        for column in UNIQUE.get(name, []) + REQUIRED.get(name, []):
            plan.not_null(df, column, f"not_null.{name}.{column}")
        for column in REQUIRED_WARN.get(name, []):
            plan.not_null(df, column, f"not_null.{name}.{column}", "warn")
        for column, parent, parent_column in REFERENCES.get(name, []):
            if parent in models:
                plan.reference(df, column, models[parent], parent_column,
                               f"reference.{name}.{column}")
        for column, values in ACCEPTED.get(name, []):
            plan.accepted(df, column, values, f"accepted.{name}.{column}")
    return plan.result(next(iter(models.values())).sparkSession)
