"""The driver tables seen as the platform's inputs.

Column mappings that need no engine-specific function are written as SQL text and
used by both sides: Spark reads them through `expr`, the SQL checks through
`select_sql`.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.dates import as_date, week_ending_sunday
from ..operators import staging as S

# Sundays inside the data.
AS_OF = "2000-06-04"
EVENTS_AS_OF = "2024-01-28"
CAMPUSES = ("A", "B", "C")
ONLINE = "Online"
LITERALS = ("A", "N", "R")
SERVICES = ("9:30am", "11:45am", "5:00pm")
SLOTS = ("9:30am Gathering", "11:45am Gathering")


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Its schema is read from the files once and then stated, which
    saves a footer-reading job on every later read."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def mapped(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {name}" for name, e in mapping.items()])


def select_sql(source: str, mapping: Mapping[str, str], tail: str = "") -> str:
    cols = ", ".join(f"{e} AS {name}" for name, e in mapping.items())
    return f"SELECT {cols} FROM {source} {tail}"


def as_bronze(df: DataFrame, model: S.Model) -> DataFrame:
    """Add the model's columns the mapping lacks, as nulls."""
    have = set(df.columns)
    return df.selectExpr("*", *[f"CAST(NULL AS STRING) AS `{c}`"
                                for c in model.columns if c not in have])


# --- headcount -----------------------------------------------------------------

HC_SQL = """hc AS (
  SELECT CAST(date_trunc('week', l_shipdate) AS DATE) + 6 AS sunday_date,
         CASE l_suppkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C'
              ELSE 'Online' END AS campus,
         l_returnflag AS literal,
         CASE l_linenumber % 3 WHEN 0 THEN '9:30am' WHEN 1 THEN '11:45am'
              ELSE '5:00pm' END AS schedule,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS cnt
  FROM lineitem GROUP BY 1, 2, 3, 4)"""

CAMPUS_EXPR = ("CASE l_suppkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' "
               "ELSE 'Online' END")
SCHEDULE_EXPR = ("CASE l_linenumber % 3 WHEN 0 THEN '9:30am' WHEN 1 THEN '11:45am' "
                 "ELSE '5:00pm' END")


def shipped_between(lineitem: DataFrame, since=None, until=None) -> DataFrame:
    """Line items of the weeks ending in [since, until]: a plain range on the stored
    column, so it reaches the scan and skips files and row groups."""
    if since is not None:
        lineitem = lineitem.where(F.col("l_shipdate") >= F.date_sub(as_date(since), 6))
    if until is not None:
        lineitem = lineitem.where(F.col("l_shipdate") < F.date_add(as_date(until), 1))
    return lineitem


def headcount_rows(spark: SparkSession, sf_dir: str, since=None, until=None) -> DataFrame:
    """Line items as headcount entries, before aggregation."""
    return shipped_between(table(spark, sf_dir, "lineitem"), since, until).select(
        week_ending_sunday(F.to_date("l_shipdate")).alias("sunday_date"),
        F.expr(CAMPUS_EXPR).alias("campus"), F.col("l_returnflag").alias("literal"),
        F.expr(SCHEDULE_EXPR).alias("schedule"), F.col("l_linenumber"),
        F.col("l_quantity").cast("bigint").alias("value"))


def headcount(spark: SparkSession, sf_dir: str, since=None, until=None) -> DataFrame:
    """hc(sunday_date, campus, literal, schedule, cnt)."""
    return (headcount_rows(spark, sf_dir, since, until)
            .groupBy("sunday_date", "campus", "literal", "schedule")
            .agg(F.sum("value").alias("cnt")))


def kept_headcount(spark: SparkSession, sf_dir: str, since=None, until=None) -> DataFrame:
    """The headcount for reports that read it more than once. It is a few rows per
    Sunday, so it is kept on the executors instead of scanning the line items again;
    a lost block is recomputed."""
    return headcount(spark, sf_dir, since, until).persist()


def with_slot(hc: DataFrame) -> DataFrame:
    from ..operators.headcount import service_slot

    return hc.withColumn("slot", service_slot("schedule"))


SLOT_SQL = ("CASE schedule WHEN '9:30am' THEN '9:30am Gathering' "
            "WHEN '11:45am' THEN '11:45am Gathering' END")


# --- bronze frames ----------------------------------------------------------------

PEOPLE_MAP = {
    "Id": "c_custkey", "Guid": "c_name", "PrimaryFamilyId": "c_nationkey",
    "PrimaryCampusId": "c_nationkey", "FirstName": "'Customer'",
    "NickName": "CASE WHEN c_acctbal > 5000 THEN c_mktsegment END",
    "LastName": "CASE WHEN c_acctbal >= 0 THEN c_name END",
    "BirthYear": "1940 + c_custkey % 70", "BirthMonth": "1 + c_custkey % 12",
    "BirthDay": "CASE WHEN c_custkey % 9 <> 0 THEN 1 + c_custkey % 28 END",
    "Gender": "c_nationkey % 3", "EmailPreference": "c_nationkey % 4",
    "MaritalStatusValueId": "c_nationkey", "RecordTypeValueId": "c_nationkey % 5",
    "RecordStatusValueId": "1 + c_custkey % 4",
    "ConnectionStatusValueId": "CASE WHEN c_acctbal > 0 THEN (c_nationkey + 7) % 30 END",
    "IsDeceased": "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal > 9500 END",
    "IsEmailActive": "c_acctbal > 1000"}
ALIAS_SQL = ("SELECT c_custkey * 2 + i AS Id, c_custkey AS PersonId, "
             "CASE WHEN i = 1 AND c_acctbal > 0 THEN c_custkey + 1 WHEN i = 0 THEN c_custkey END "
             "AS AliasPersonId FROM (SELECT *, unnest([0, 1]) AS i FROM customer)")
DEFINED_MAP = {"Id": "n_nationkey", "Value": "n_name", "DefinedTypeId": "n_regionkey",
               "IsActive": "n_nationkey <> 4"}
CAMPUS_MAP = {
    "Id": "n_nationkey", "Name": "n_name",
    "IsActive": "CASE WHEN n_nationkey = 7 THEN NULL ELSE n_nationkey <> 3 END",
    "OpenedDate": "CASE WHEN n_regionkey <> 0 THEN make_date(1985 + n_nationkey, 6, 4) END",
    "ClosedDate": "CASE WHEN n_regionkey = 1 THEN make_date(2000, 6, 1 + n_nationkey % 8) END",
    "TitheMetric": "n_nationkey * 1.5"}
GROUP_TYPE_MAP = {
    "Id": "CASE r_regionkey WHEN 0 THEN 34 WHEN 1 THEN 38 ELSE 20 + r_regionkey END",
    "Name": "r_name", "AttendanceCountsAsWeekendService": "r_regionkey = 2",
    "TakesAttendance": "r_regionkey <> 3"}
GROUP_MAP = {
    "Id": "s_suppkey", "Guid": "s_name", "ParentGroupId": "s_suppkey % 10", "Name": "s_name",
    "GroupTypeId": "CASE WHEN s_acctbal < 0 THEN NULL WHEN s_nationkey % 3 = 0 THEN 34 "
                   "WHEN s_nationkey % 3 = 1 THEN 38 ELSE 22 END",
    "CampusId": "s_nationkey", "IsActive": "s_acctbal > 500",
    "IsArchived": "CASE WHEN s_acctbal > 8000 THEN NULL ELSE s_acctbal < 1000 END",
    "IsSecurityRole": "s_acctbal > 9000"}
KIND = ("CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 "
        "WHEN 'signup' THEN 4 ELSE 5 END")
TEAM_MAP = {
    "Id": KIND, "Name": "event_type",
    "GroupTypeId": "CASE event_type WHEN 'view' THEN 34 WHEN 'click' THEN 34 "
                   "WHEN 'purchase' THEN 22 ELSE 38 END",
    "IsActive": "event_type <> 'error'", "IsArchived": "event_type = 'error'"}
MEMBER_MAP = {
    "Id": f"user_id * 10 + {KIND}", "PersonId": "user_id", "GroupId": KIND,
    "GroupRoleId": "user_id % 3", "GroupMemberStatus": f"(user_id + {KIND}) % 4",
    "IsArchived": "CASE WHEN user_id % 11 = 0 THEN NULL ELSE user_id % 7 = 0 END",
    "DateTimeAdded": "min(ts)"}
DAY_KEY = "(year(ts) * 10000 + month(ts) * 100 + day(ts))"
ATTENDANCE_MAP = {
    "Id": "event_id", "PersonAliasId": "user_id * 2 + event_id % 2",
    "OccurrenceId": f"{DAY_KEY} * 10 + {KIND}", "CampusId": "user_id % 4",
    "DidAttend": "CASE WHEN value < 2 THEN NULL ELSE value > 10 END",
    "IsFirstTime": "value > 200", "RSVP": "event_id % 5", "StartDateTime": "ts"}
OCCURRENCE_MAP = {
    "Id": f"{DAY_KEY} * 10 + {KIND}", "GroupId": KIND, "LocationId": f"{KIND} * 100",
    "ScheduleId": "day(ts) % 3", "OccurrenceDate": "CAST(ts AS DATE)",
    "DidNotOccur": "CASE WHEN day(ts) = 13 THEN NULL ELSE day(ts) % 10 = 0 END"}
REQUEST_MAP = {
    "Id": "o_orderkey", "PersonAliasId": "o_custkey * 2",
    "ConnectorPersonAliasId": "CASE WHEN o_orderkey % 50 = 0 THEN -1 "
                              "WHEN o_orderpriority = '5-LOW' THEN NULL "
                              "ELSE o_custkey * 2 + 1 END",
    "ConnectionOpportunityId": "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 60 "
                               "WHEN '2' THEN 68 WHEN '3' THEN 69 WHEN '4' THEN 70 ELSE 71 END",
    "ConnectionTypeId": "1", "CampusId": "o_custkey % 5",
    "ConnectionState": "CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 2 ELSE 3 END",
    "CreatedDateTime": "o_orderdate",
    "ConnectedDateTime": "CASE WHEN o_orderstatus = 'F' THEN first_ship END",
    "CreatedDateKey": "year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate)",
    "WasCompletedOnTime": "o_totalprice > 250000"}
REQUEST_SOURCE = ("(SELECT * FROM orders LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS "
                  "first_ship FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey)")
DETAIL_MAP = {
    "TransactionId": "l_orderkey", "AccountId": "l_partkey",
    "Amount": "CAST(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END "
              "AS DECIMAL(18,2))",
    "FeeAmount": "CASE WHEN l_tax > 0 THEN CAST(l_extendedprice AS DECIMAL(18,2)) "
                 "* CAST(l_tax AS DECIMAL(4,2)) END"}
HISTORY_MAP = {"Id": "o_orderkey", "PersonId": "o_custkey", "EffectiveDate":
               "CAST(o_orderdate AS DATE)", "CurrentJourneyGivingStage": "o_orderstatus"}

GROUP_BY_TEAM = "GROUP BY event_type"
GROUP_BY_MEMBER = "GROUP BY user_id, event_type"


def people_bronze(spark, sf_dir):
    return as_bronze(mapped(table(spark, sf_dir, "customer"), PEOPLE_MAP), S.PEOPLE)


def aliases_bronze(spark, sf_dir):
    """Each person's own alias, and a second one merged into them (some unresolved)."""
    both = table(spark, sf_dir, "customer").withColumn(
        "i", F.explode(F.array(F.lit(0), F.lit(1))))
    return as_bronze(mapped(both, {
        "Id": "c_custkey * 2 + i", "PersonId": "c_custkey",
        "AliasPersonId": "CASE WHEN i = 1 AND c_acctbal > 0 THEN c_custkey + 1 "
                         "WHEN i = 0 THEN c_custkey END"}), S.PERSON_ALIASES)


def defined_values_bronze(spark, sf_dir):
    return as_bronze(mapped(table(spark, sf_dir, "nation"), DEFINED_MAP), S.DEFINED_VALUES)


def campuses_bronze(spark, sf_dir):
    return as_bronze(mapped(table(spark, sf_dir, "nation"), CAMPUS_MAP), S.CAMPUSES)


def group_types_bronze(spark, sf_dir):
    return as_bronze(mapped(table(spark, sf_dir, "region"), GROUP_TYPE_MAP), S.GROUP_TYPES)


def groups_bronze(spark, sf_dir):
    return as_bronze(mapped(table(spark, sf_dir, "supplier"), GROUP_MAP), S.GROUPS)


def teams_bronze(spark, sf_dir):
    """One group per event type."""
    types = table(spark, sf_dir, "events").select("event_type").distinct()
    return as_bronze(mapped(types, TEAM_MAP), S.GROUPS)


def members_bronze(spark, sf_dir):
    first = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(
        F.min("ts").alias("first_ts"))
    return as_bronze(mapped(first, MEMBER_MAP | {"DateTimeAdded": "first_ts"}), S.GROUP_MEMBERS)


def attendance_bronze(spark, sf_dir):
    return as_bronze(mapped(table(spark, sf_dir, "events"), ATTENDANCE_MAP), S.ATTENDANCE)


def occurrences_bronze(spark, sf_dir):
    held = (table(spark, sf_dir, "events")
            .select(F.to_date("ts").alias("ts"), "event_type").distinct())
    return as_bronze(mapped(held, OCCURRENCE_MAP).withColumn(
        "SundayDate", week_ending_sunday("OccurrenceDate")), S.OCCURRENCES)


def requests_bronze(spark, sf_dir):
    ships = (table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
             .agg(F.min("l_shipdate").alias("first_ship")))
    orders = table(spark, sf_dir, "orders").join(ships, "o_orderkey", "left")
    return as_bronze(mapped(orders, REQUEST_MAP), S.CONNECTION_REQUESTS)


def opportunities_bronze(spark, sf_dir):
    kinds = table(spark, sf_dir, "orders").select("o_orderpriority").distinct()
    return as_bronze(mapped(kinds, {"Id": REQUEST_MAP["ConnectionOpportunityId"],
                                    "Name": "o_orderpriority"}), S.CONNECTION_OPPORTUNITIES)


def details_bronze(spark, sf_dir):
    return as_bronze(mapped(table(spark, sf_dir, "lineitem"), DETAIL_MAP), S.TRANSACTION_DETAILS)


def transactions_bronze(spark, sf_dir):
    return as_bronze(mapped(table(spark, sf_dir, "orders"), {
        "Id": "o_orderkey", "AuthorizedPersonAliasId": "o_custkey * 2",
        "TransactionDateTime": "o_orderdate",
        "IsSettled": "CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'false' END"}),
        S.FINANCIAL_TRANSACTIONS)


def order_history(spark, sf_dir):
    """Order status changes as an open-ended version history per customer."""
    from ..operators.journey import validity

    changes = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("person_id"), F.col("o_orderkey").alias("version_id"),
        F.to_date("o_orderdate").alias("effective_date"),
        F.col("o_orderstatus").alias("stage"))
    return validity(changes, "person_id", "effective_date", "version_id")


HISTORY_SQL = """history AS (
  SELECT o_custkey AS person_id, o_orderkey AS version_id,
         CAST(o_orderdate AS DATE) AS effective_date, o_orderstatus AS stage,
         coalesce(lead(CAST(o_orderdate AS DATE)) OVER (
           PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), DATE '9999-01-01')
           AS expire_date
  FROM orders)"""


def bronze(spark, sf_dir):
    """Bronze table by name, from the driver tables."""
    def of(mapping_table, mapping, model):
        return lambda: as_bronze(mapped(table(spark, sf_dir, mapping_table), mapping), model)

    makers = {
        "people": lambda: people_bronze(spark, sf_dir),
        "person_aliases": lambda: aliases_bronze(spark, sf_dir),
        "groups": lambda: teams_bronze(spark, sf_dir),
        "group_members": lambda: members_bronze(spark, sf_dir),
        "group_types": lambda: group_types_bronze(spark, sf_dir),
        "attendance": lambda: attendance_bronze(spark, sf_dir),
        "attendance_occurrences": lambda: occurrences_bronze(spark, sf_dir),
        "campuses": lambda: campuses_bronze(spark, sf_dir),
        "financial_accounts": of("part", {"Id": "p_partkey", "Name": "p_brand",
                                          "ParentAccountId": "p_partkey - p_size",
                                          "IsActive": "p_size > 10"}, S.FINANCIAL_ACCOUNTS),
        "financial_transactions": lambda: transactions_bronze(spark, sf_dir),
        "financial_transaction_details": lambda: details_bronze(spark, sf_dir),
        "connection_requests": lambda: requests_bronze(spark, sf_dir),
        "connection_opportunities": lambda: opportunities_bronze(spark, sf_dir),
        "defined_values": lambda: defined_values_bronze(spark, sf_dir),
        "analytics_dim_person_historical": of(
            "orders", HISTORY_MAP | {"CurrentRowIndicator": "o_orderstatus = 'O'"},
            S.PERSON_HISTORICAL)}
    return lambda name: makers[name]()
