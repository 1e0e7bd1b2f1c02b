"""Queries over the staging models, predicates and text columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import blank_concat, in_box, iso_timestamp, not_in
from ..operators import audience, camp, headcount, journey, lookup
from ..operators import staging as S
from . import inputs as I
from .registry import query


def _sub(source: str, mapping: dict[str, str], tail: str = "") -> str:
    return f"WITH b AS ({I.select_sql(source, mapping, tail)})"


@query("staging_people", f"""
    {_sub('customer', I.PEOPLE_MAP)}
    SELECT Id AS person_id, coalesce(NickName, FirstName) AS display_name,
           coalesce(NickName, FirstName) || ' ' || LastName AS full_name,
           CASE WHEN BirthDay IS NOT NULL THEN make_date(BirthYear, BirthMonth, BirthDay) END
             AS birth_date,
           CASE Gender WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' ELSE 'Unknown' END AS gender,
           CASE EmailPreference WHEN 0 THEN 'Email Allowed' WHEN 1 THEN 'No Mass Emails'
                WHEN 2 THEN 'Do Not Email' ELSE 'Unknown' END AS email_preference,
           coalesce(RecordStatusValueId = 3 AND NOT IsDeceased, false) AS is_active
    FROM b""")
def staging_people(spark, sf_dir):
    return S.people(I.people_bronze(spark, sf_dir)).select(
        "person_id", "display_name", "full_name", "birth_date", "gender", "email_preference",
        "is_active")


@query("staging_aliases", f"""
    SELECT Id AS person_alias_id, PersonId AS person_id, AliasPersonId AS alias_person_id,
           coalesce(AliasPersonId <> PersonId, false) AS is_merged_alias FROM ({I.ALIAS_SQL})""")
def staging_aliases(spark, sf_dir):
    return S.person_aliases(I.aliases_bronze(spark, sf_dir)).select(
        "person_alias_id", "person_id", "alias_person_id", "is_merged_alias")


@query("staging_groups", f"""
    {_sub('supplier', I.GROUP_MAP)}
    SELECT Id AS group_id, ParentGroupId AS parent_group_id, GroupTypeId AS group_type_id,
           IsActive AS is_active, IsArchived AS is_archived,
           IsActive AND NOT IsArchived AS is_currently_active FROM b""")
def staging_groups(spark, sf_dir):
    return S.groups(I.groups_bronze(spark, sf_dir)).select(
        "group_id", "parent_group_id", "group_type_id", "is_active", "is_archived",
        "is_currently_active")


@query("staging_group_members", f"""
    {_sub('events', I.MEMBER_MAP, I.GROUP_BY_MEMBER)}
    SELECT Id AS group_member_id, PersonId AS person_id, GroupId AS group_id,
           CASE GroupMemberStatus WHEN 0 THEN 'Inactive' WHEN 1 THEN 'Active'
                WHEN 2 THEN 'Pending' ELSE 'Unknown' END AS group_member_status,
           coalesce(GroupMemberStatus = 1 AND NOT coalesce(IsArchived, false), false)
             AS is_currently_active_member,
           CAST(DateTimeAdded AS DATE) AS added_on FROM b""")
def staging_group_members(spark, sf_dir):
    return S.group_members(I.members_bronze(spark, sf_dir)).select(
        "group_member_id", "person_id", "group_id", "group_member_status",
        "is_currently_active_member", F.to_date("added_at").alias("added_on"))


@query("staging_attendance", f"""
    {_sub('events', I.ATTENDANCE_MAP)}
    SELECT Id AS attendance_id, OccurrenceId AS occurrence_id, PersonAliasId AS person_alias_id,
           coalesce(DidAttend, false) AS did_attend, IsFirstTime AS is_first_time,
           CASE RSVP WHEN 1 THEN 'Yes' WHEN 2 THEN 'No' WHEN 3 THEN 'Maybe' ELSE 'Unknown' END
             AS rsvp
    FROM b""",
       wide=("occurrence_id",))
def staging_attendance(spark, sf_dir):
    return S.attendance(I.attendance_bronze(spark, sf_dir)).select(
        "attendance_id", "occurrence_id", "person_alias_id", "did_attend", "is_first_time",
        "rsvp")


_OCCURRENCE_SQL = I.select_sql(
    "events", I.OCCURRENCE_MAP | {"SundayDate": "CAST(date_trunc('week', ts) AS DATE) + 6"})


@query("staging_occurrences", f"""
    WITH b AS (SELECT DISTINCT * FROM ({_OCCURRENCE_SQL}))
    SELECT Id AS occurrence_id, GroupId AS group_id, OccurrenceDate AS occurrence_date,
           SundayDate AS sunday_date, NOT coalesce(DidNotOccur, false) AS did_occur FROM b""",
       wide=("occurrence_id",))
def staging_occurrences(spark, sf_dir):
    return S.occurrences(I.occurrences_bronze(spark, sf_dir)).select(
        "occurrence_id", "group_id", "occurrence_date", "sunday_date", "did_occur")


@query("staging_requests", f"""
    {_sub(I.REQUEST_SOURCE, I.REQUEST_MAP)}
    SELECT Id AS connection_request_id,
           CASE ConnectionState WHEN 0 THEN 'Active' WHEN 1 THEN 'Inactive'
                WHEN 2 THEN 'Future Follow-up' WHEN 3 THEN 'Connected' ELSE 'Unknown' END
             AS connection_state,
           coalesce(ConnectionState = 3, false) AS is_connected,
           datesub('day', CreatedDateTime, ConnectedDateTime) AS days_to_connect,
           WasCompletedOnTime AS was_completed_on_time
    FROM b""")
def staging_requests(spark, sf_dir):
    return S.connection_requests(I.requests_bronze(spark, sf_dir)).select(
        "connection_request_id", "connection_state", "is_connected", "days_to_connect",
        "was_completed_on_time")


@query("staging_person_history", """
    SELECT o_orderkey AS person_historical_id, o_custkey AS person_id,
           CAST(o_orderdate AS DATE) AS effective_date,
           o_orderstatus AS current_journey_giving_stage
    FROM orders WHERE o_orderstatus = 'O'""")
def staging_person_history(spark, sf_dir):
    rows = I.mapped(I.table(spark, sf_dir, "orders"),
                    I.HISTORY_MAP | {"CurrentRowIndicator": "o_orderstatus = 'O'"})
    current = S.person_current(S.person_historical(I.as_bronze(rows, S.PERSON_HISTORICAL)))
    return current.select("person_historical_id", "person_id", "effective_date",
                          "current_journey_giving_stage")


@query("staging_reference", f"""
    SELECT 'type' AS kind, Id AS id, Name AS name, AttendanceCountsAsWeekendService AS flag
    FROM ({I.select_sql('region', I.GROUP_TYPE_MAP)})
    UNION ALL SELECT 'value', Id, Value, IsActive FROM ({I.select_sql('nation', I.DEFINED_MAP)})
    UNION ALL SELECT DISTINCT 'opportunity', {I.REQUEST_MAP['ConnectionOpportunityId']},
                              o_orderpriority, CAST(NULL AS BOOLEAN) FROM orders""")
def staging_reference(spark, sf_dir):
    types = S.group_types(I.group_types_bronze(spark, sf_dir)).select(
        F.lit("type").alias("kind"), F.col("group_type_id").alias("id"), "name",
        F.col("attendance_counts_as_weekend_service").alias("flag"))
    values = S.defined_values(I.defined_values_bronze(spark, sf_dir)).select(
        F.lit("value").alias("kind"), F.col("defined_value_id").alias("id"),
        F.col("value").alias("name"), F.col("is_active").alias("flag"))
    opportunities = S.connection_opportunities(I.opportunities_bronze(spark, sf_dir)).select(
        F.lit("opportunity").alias("kind"), F.col("connection_opportunity_id").alias("id"),
        "name", F.col("is_active").alias("flag"))
    return types.unionByName(values).unionByName(opportunities)


@query("staging_campuses", f"""
    {_sub('nation', I.CAMPUS_MAP)}
    SELECT Id AS campus_id, CAST(TitheMetric AS DOUBLE) AS tithe_metric,
           coalesce(IsActive AND (OpenedDate IS NULL OR OpenedDate <= DATE '{I.AS_OF}')
                    AND (ClosedDate IS NULL OR ClosedDate > DATE '{I.AS_OF}'), false)
             AS is_currently_open
    FROM b""")
def staging_campuses(spark, sf_dir):
    return S.campuses(I.campuses_bronze(spark, sf_dir), I.AS_OF).select(
        "campus_id", F.col("tithe_metric").cast("double").alias("tithe_metric"),
        "is_currently_open")


_ACCOUNT_MAP = {
    "Id": "o_orderkey", "IsActive": "CASE o_orderstatus WHEN 'F' THEN true WHEN 'P' THEN false END",
    "StartDate": "CASE WHEN o_totalprice > 50000 THEN CAST(o_orderdate AS DATE) END",
    "EndDate": "CASE WHEN o_totalprice < 450000 THEN first_end END"}


@query("staging_validity_window", f"""
    WITH b AS (SELECT o_orderkey AS Id, CASE o_orderstatus WHEN 'F' THEN true
                      WHEN 'P' THEN false END AS IsActive,
                      CASE WHEN o_totalprice > 50000 THEN CAST(o_orderdate AS DATE) END AS s,
                      CASE WHEN o_totalprice < 450000 THEN CAST(o_orderdate AS DATE) + 90 END AS e
               FROM orders)
    SELECT Id AS financial_account_id,
           coalesce(IsActive AND (s IS NULL OR s <= DATE '{I.AS_OF}')
                    AND (e IS NULL OR e >= DATE '{I.AS_OF}'), false) AS is_currently_active
    FROM b""")
def staging_validity_window(spark, sf_dir):
    orders = I.table(spark, sf_dir, "orders").withColumn(
        "first_end", F.date_add(F.to_date("o_orderdate"), 90))
    accounts = I.as_bronze(I.mapped(orders, _ACCOUNT_MAP), S.FINANCIAL_ACCOUNTS)
    return S.financial_accounts(accounts, I.AS_OF).select("financial_account_id",
                                                         "is_currently_active")


@query("staging_money", f"""
    {_sub('lineitem', I.DETAIL_MAP)}
    SELECT DISTINCT TransactionId AS financial_transaction_id, AccountId AS financial_account_id,
           CAST(Amount AS DOUBLE) AS amount, CAST(FeeAmount AS DOUBLE) AS fee_amount,
           coalesce(Amount < 0, false) AS is_refund FROM b""")
def staging_money(spark, sf_dir):
    return S.financial_transaction_details(I.details_bronze(spark, sf_dir)).select(
        "financial_transaction_id", "financial_account_id",
        F.col("amount").cast("double").alias("amount"),
        F.col("fee_amount").cast("double").alias("fee_amount"), "is_refund").distinct()


@query("staging_transactions", """
    SELECT o_orderkey AS financial_transaction_id, o_custkey * 2 AS authorized_person_alias_id,
           CAST(o_orderdate AS DATE) AS transaction_date,
           CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS is_settled
    FROM orders""")
def staging_transactions(spark, sf_dir):
    return S.financial_transactions(I.transactions_bronze(spark, sf_dir)).select(
        "financial_transaction_id", "authorized_person_alias_id", "transaction_date",
        "is_settled")


# --- predicates ------------------------------------------------------------------

_SEGMENT = "CASE WHEN c_acctbal < 500 THEN NULL ELSE c_mktsegment END"
_PLACES = {"id": "c_custkey", "segment": _SEGMENT,
           "campus": "CASE WHEN c_nationkey = 9 THEN NULL ELSE c_nationkey % 6 END"}


@query("predicate_not_in", f"""
    SELECT * FROM ({I.select_sql('customer', _PLACES)})
    WHERE (segment IS NULL OR segment NOT IN ('BUILDING', 'MACHINERY'))
      AND campus IS DISTINCT FROM 5""")
def predicate_not_in(spark, sf_dir):
    """Excluded type names and campus; missing values are kept."""
    rows = I.mapped(I.table(spark, sf_dir, "customer"), _PLACES)
    return camp.listed_groups(
        rows.withColumnsRenamed({"id": "group_id", "segment": "group_type_name",
                                 "campus": "campus_id"}),
        ["BUILDING", "MACHINERY"]).withColumnsRenamed(
        {"group_id": "id", "group_type_name": "segment", "campus_id": "campus"})


_PART_NAME = ("CASE p_size WHEN 1 THEN 'Test ' || p_name WHEN 2 THEN 'my test' "
              "WHEN 3 THEN 'TESTED' WHEN 4 THEN 'tEst' WHEN 5 THEN NULL ELSE p_name END")


@query("predicate_test_names", f"""
    SELECT id, name FROM (SELECT p_partkey AS id, {_PART_NAME} AS name FROM part)
    WHERE coalesce(name, '') NOT LIKE '%Test%' AND coalesce(name, '') NOT LIKE '%TEST%'
      AND coalesce(name, '') NOT LIKE '%test%'""")
def predicate_test_names(spark, sf_dir):
    return camp.real_groups(I.mapped(I.table(spark, sf_dir, "part"),
                                     {"id": "p_partkey", "name": _PART_NAME}))


_TYPED = {"type_id": "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 8 WHEN '2' THEN 69 "
                     "WHEN '3' THEN 307 END", "status": "o_orderstatus"}


@query("predicate_single_category", f"""
    SELECT type_id, status, count(*) AS n FROM ({I.select_sql('orders', _TYPED)})
    WHERE type_id IN (8, 69, 307) GROUP BY type_id, status""")
def predicate_single_category(spark, sf_dir):
    """Connection, step and workflow facts keep one category each (8, 69, 307)."""
    rows = I.mapped(I.table(spark, sf_dir, "orders"), _TYPED)
    return (rows.where(F.col("type_id").isin(8, 69, 307)).groupBy("type_id", "status")
            .agg(F.count("*").alias("n")))


_COORDS = {"id": "c_custkey", "lat": "CASE WHEN c_acctbal < 0 THEN NULL WHEN c_nationkey = 3 "
                                     "THEN 0.0 ELSE 33.0 + c_custkey % 20 * 0.1 END",
           "lng": "-85.5 + c_nationkey * 0.1"}


@query("predicate_box", f"""
    SELECT id FROM ({I.select_sql('customer', _COORDS)})
    WHERE lat <> 0 AND lng <> 0 AND lat BETWEEN 33.25 AND 34.55
      AND lng BETWEEN -85.25 AND -83.75""")
def predicate_box(spark, sf_dir):
    rows = I.mapped(I.table(spark, sf_dir, "customer"), _COORDS)
    return rows.where(in_box("lat", "lng", 33.25, 34.55, -85.25, -83.75)).select("id")


_MINISTRIES = {"p": ("purchase",), "b": ("signup",), "d": ("view", "click")}


@query("ministry_codes", """
    SELECT event_type, CASE event_type WHEN 'purchase' THEN 'p' WHEN 'signup' THEN 'b'
             WHEN 'view' THEN 'd' WHEN 'click' THEN 'd' END AS code, count(*) AS n
    FROM events GROUP BY 1, 2""")
def ministry_codes(spark, sf_dir):
    rows = I.table(spark, sf_dir, "events")
    code = journey.ministry_code("event_type", _MINISTRIES)
    return rows.groupBy("event_type", code.alias("code")).agg(F.count("*").alias("n"))


@query("sunday_only_groups", """
    WITH seen AS (SELECT l_orderkey, bool_or(l_quantity > 20) AS r,
                         count(*) FILTER (dayofweek(l_shipdate) <> 0) AS other
                  FROM lineitem GROUP BY l_orderkey)
    SELECT o_orderkey AS group_id, CASE WHEN r AND other = 0 THEN 1 ELSE 0 END
             AS has_sunday_checkins
    FROM orders LEFT JOIN seen ON l_orderkey = o_orderkey""")
def sunday_only_groups(spark, sf_dir):
    """Orders as groups and their lines as check-ins on the ship date."""
    check_ins = I.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("group_id"), F.to_date("l_shipdate").alias("occurrence_date"),
        (F.col("l_quantity") > 20).alias("requested"))
    groups = I.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("group_id"))
    return lookup.sunday_only_groups(groups, check_ins)


_HC_ORDERS_SQL = f"""
    WITH {I.HC_SQL}
    SELECT sunday_date, campus, literal, schedule, cnt, {I.SLOT_SQL} AS slot,
           CASE WHEN campus = 'C' THEN 'Far' ELSE 'Home' END AS city_label,
           CASE schedule WHEN '9:30am' THEN 1 WHEN '11:45am' THEN 3 ELSE 5 END AS schedule_order,
           CASE campus WHEN 'A' THEN 1 WHEN 'B' THEN 2 WHEN 'C' THEN 3 ELSE 4 END AS campus_order,
           CASE literal WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 99 END AS literal_order,
           CASE schedule WHEN '9:30am' THEN 5 WHEN '11:45am' THEN 10 ELSE 19 END AS schedule_sort
    FROM hc"""


@query("service_slot", _HC_ORDERS_SQL)
def service_slot(spark, sf_dir):
    hc = I.with_slot(I.headcount(spark, sf_dir))
    out = headcount.with_sort_orders(hc, I.CAMPUSES, ["A", "N"])
    return out.withColumn("city_label", headcount.city_label("campus", "C", "Far", "Home"))


_FOLD = "CASE WHEN p_size % 2 = 0 THEN upper(p_name) ELSE p_name END"


@query("name_folding", f"""
    SELECT CASE WHEN lower(name) LIKE '%widget%' THEN 'widget' ELSE name END AS group_name,
           coalesce(brand, '') || ', ' || coalesce(kind, '') AS address, count(*) AS n
    FROM (SELECT {_FOLD} AS name, CASE WHEN p_size > 40 THEN NULL ELSE p_brand END AS brand,
                 CASE WHEN p_size < 5 THEN NULL ELSE p_type END AS kind FROM part)
    GROUP BY 1, 2""")
def name_folding(spark, sf_dir):
    from ..functions.columns import contains_fold

    rows = I.mapped(I.table(spark, sf_dir, "part"), {
        "name": _FOLD, "brand": "CASE WHEN p_size > 40 THEN NULL ELSE p_brand END",
        "kind": "CASE WHEN p_size < 5 THEN NULL ELSE p_type END"})
    folded = F.when(contains_fold("name", "Widget"), "widget").otherwise(F.col("name"))
    return rows.groupBy(folded.alias("group_name"),
                        blank_concat("brand", F.lit(", "), "kind").alias("address")).agg(
        F.count("*").alias("n"))


_VIDEO = {"video_id": "event_id",
          "title": "CASE event_type WHEN 'view' THEN 'Sunday Gathering // 9:30am ' "
                   "WHEN 'click' THEN 'A FULL GATHERING' ELSE 'Clip - Speaker' END",
          "was_live": "event_type IN ('view', 'click')",
          "stream_date": "CASE WHEN event_type IN ('view', 'click') THEN CAST(ts AS DATE) END",
          "published_on": "CAST(ts AS DATE)",
          "publish_at": "CASE WHEN value > 200 THEN ts END",
          "live_views": "CASE WHEN value > 80 THEN NULL WHEN value < 5 THEN 0 "
                        "ELSE CAST(floor(value) AS BIGINT) END",
          "total_views": "CAST(floor(value * 10) AS BIGINT)"}


@query("live_vs_total", f"""
    WITH v AS ({I.select_sql('events', _VIDEO)})
    SELECT video_id,
           CASE WHEN was_live AND live_views > 0 THEN live_views ELSE total_views END AS views,
           CASE WHEN NOT was_live THEN 'data_api_total'
                WHEN live_views > 0 THEN 'analytics_live'
                ELSE 'data_api_total_provisional' END AS views_source
    FROM v WHERE publish_at IS NULL
      AND ((was_live AND stream_date = DATE '{I.EVENTS_AS_OF}')
           OR (NOT was_live AND published_on BETWEEN DATE '{I.EVENTS_AS_OF}'
                                                 AND DATE '{I.EVENTS_AS_OF}' + 1))""")
def live_vs_total(spark, sf_dir):
    videos = audience.released(I.mapped(I.table(spark, sf_dir, "events"), _VIDEO))
    live = audience.live_on(videos, I.EVENTS_AS_OF)
    other = audience.uploads_near(videos, I.EVENTS_AS_OF)
    return audience.with_live_views(live.unionByName(other)).select(
        "video_id", "views", "views_source")


@query("backfill_ids", """
    SELECT DISTINCT user_id AS video_id FROM events WHERE event_type = 'view'""")
def backfill_ids(spark, sf_dir):
    rows = I.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("video_id"), (F.col("event_type") == "view").alias("was_live"))
    return audience.backfill_ids(rows)


@query("title_split", """
    SELECT doc_id, CASE WHEN instr(text, '. ') > 0
                        THEN trim(regexp_replace(substr(text, 1, instr(text, '. ') - 1),
                                                 ' +', ' ', 'g'), ' ') ELSE text END
                     AS sermon_title,
           CASE WHEN instr(text, '. ') > 0
                THEN trim(regexp_replace(substr(text, instr(text, '. ') + 2), ' +', ' ', 'g'), ' ')
                END AS speaker,
           'https://img.youtube.com/vi/' || doc_id || '/maxresdefault.jpg' AS thumbnail_url
    FROM documents""")
def title_split(spark, sf_dir):
    docs = I.table(spark, sf_dir, "documents").select("doc_id", "text")
    return audience.title_parts(docs, "text", ". ").select(
        "doc_id", "sermon_title", "speaker",
        audience.thumbnail(F.col("doc_id").cast("string")).alias("thumbnail_url"))


@query("platform_sundays", """
    SELECT event_id, 'early' AS gathering, CAST(ts - INTERVAL 5 HOUR AS DATE) AS sunday_date
    FROM events WHERE event_type IN ('view', 'click')
      AND CAST(ts - INTERVAL 5 HOUR AS DATE) IN (DATE '2024-01-28', DATE '2024-01-21')""")
def platform_sundays(spark, sf_dir):
    """Broadcasts of the last two Sundays by local date, seen from a Wednesday."""
    videos = I.table(spark, sf_dir, "events").select(
        "event_id", iso_timestamp(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
                                           F.lit("Z"))).alias("broadcast_start_time"),
        F.when(F.col("event_type").isin("view", "click"), "Sunday Gathering // early ")
        .otherwise("Rehearsal // early").alias("title"))
    return audience.platform_sundays(videos, "2024-01-31").select(
        "event_id", "gathering", "sunday_date")


@query("gathering_titles", """
    SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE event_type || ' 9:30' END
             AS gathering,
           strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d') AS local_day
    FROM events""")
def gathering_titles(spark, sf_dir):
    """Titles after '//', and the local date of an ISO start time."""
    from ..functions.dates import local_date

    title = F.when(F.col("event_type") == "error", F.lit("Rehearsal // x")).otherwise(
        F.concat(F.lit("Sunday Gathering // "), "event_type", F.lit(" 9:30 ")))
    start = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.when(
        F.col("value") > 20, "+0000").when(F.col("value") > 10, "+00:00").otherwise("Z"))
    rows = I.table(spark, sf_dir, "events").select(
        "event_id", title.alias("title"), start.alias("start"))
    return rows.select("event_id", audience.gathering_of("title").alias("gathering"),
                       local_date(iso_timestamp("start"), audience.LOCAL_ZONE)
                       .cast("string").alias("local_day"))
