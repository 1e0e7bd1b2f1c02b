"""Queries over gold dimensions, facts, marts, lookups and the giving extract."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import giving, gold, journey, lookup
from ..operators import staging as S
from ..operators.calendar import literal_axis
from . import inputs as I
from .registry import query


def _groups(spark, sf_dir):
    return S.groups(I.groups_bronze(spark, sf_dir))


def _campuses(spark, sf_dir):
    return S.campuses(I.campuses_bronze(spark, sf_dir), I.AS_OF)


def _people(spark, sf_dir):
    return gold.dim_person(S.people(I.people_bronze(spark, sf_dir)),
                           S.defined_values(I.defined_values_bronze(spark, sf_dir)),
                           _campuses(spark, sf_dir))


def _aliases(spark, sf_dir):
    return S.person_aliases(I.aliases_bronze(spark, sf_dir))


def _occurrences(spark, sf_dir):
    return S.occurrences(I.occurrences_bronze(spark, sf_dir))


def _requests(spark, sf_dir):
    return gold.fct_connection_request(
        S.connection_requests(I.requests_bronze(spark, sf_dir)), _aliases(spark, sf_dir),
        S.connection_opportunities(I.opportunities_bronze(spark, sf_dir)))


def _team_groups(spark, sf_dir):
    return gold.dim_group(S.groups(I.teams_bronze(spark, sf_dir)),
                          S.group_types(I.group_types_bronze(spark, sf_dir)),
                          _campuses(spark, sf_dir))


@query("dim_group", f"""
    WITH g AS ({I.select_sql('supplier', I.GROUP_MAP)}),
         t AS ({I.select_sql('region', I.GROUP_TYPE_MAP)})
    SELECT g.Id AS group_id, false AS key_is_null, g.GroupTypeId AS group_type_id,
           t.Name AS group_type_name, n_name AS campus_name,
           coalesce(g.GroupTypeId = 34, false) AS is_door_holder_team,
           coalesce(g.GroupTypeId = 38, false) AS is_connect_group,
           IsActive AND NOT IsArchived AS is_currently_active
    FROM g LEFT JOIN t ON t.Id = g.GroupTypeId LEFT JOIN nation ON n_nationkey = g.CampusId""")
def dim_group(spark, sf_dir):
    out = gold.dim_group(_groups(spark, sf_dir),
                         S.group_types(I.group_types_bronze(spark, sf_dir)),
                         _campuses(spark, sf_dir))
    return out.select("group_id", F.col("group_key").isNull().alias("key_is_null"),
                      "group_type_id", "group_type_name", "campus_name", "is_door_holder_team",
                      "is_connect_group", "is_currently_active")


@query("dim_person", f"""
    WITH p AS ({I.select_sql('customer', I.PEOPLE_MAP)})
    SELECT p.Id AS person_id, m.n_name AS marital_status, t.n_name AS record_type,
           s.n_name AS record_status, c.n_name AS connection_status, k.n_name AS campus_name,
           PrimaryFamilyId AS primary_family_id
    FROM p LEFT JOIN nation m ON m.n_nationkey = MaritalStatusValueId
           LEFT JOIN nation t ON t.n_nationkey = RecordTypeValueId
           LEFT JOIN nation s ON s.n_nationkey = RecordStatusValueId
           LEFT JOIN nation c ON c.n_nationkey = ConnectionStatusValueId
           LEFT JOIN nation k ON k.n_nationkey = PrimaryCampusId""")
def dim_person(spark, sf_dir):
    return _people(spark, sf_dir).select("person_id", *gold.PERSON_ROLES, "campus_name",
                                         "primary_family_id")


@query("alias_resolution", f"""
    WITH a AS ({I.ALIAS_SQL}), r AS ({I.select_sql(I.REQUEST_SOURCE, I.REQUEST_MAP)})
    SELECT r.Id AS request_id, p.PersonId AS person_id, q.PersonId AS connector_person_id
    FROM r LEFT JOIN a p ON p.Id = r.PersonAliasId
           LEFT JOIN a q ON q.Id = r.ConnectorPersonAliasId""")
def alias_resolution(spark, sf_dir):
    requests = S.connection_requests(I.requests_bronze(spark, sf_dir))
    aliases = _aliases(spark, sf_dir)
    out = gold.resolve_alias(requests, aliases, "person_alias_id", "person_id")
    out = gold.resolve_alias(out, aliases, "connector_person_alias_id", "connector_person_id")
    return out.select(F.col("connection_request_id").alias("request_id"), "person_id",
                      "connector_person_id")


_OCC = I.select_sql(
    "events", I.OCCURRENCE_MAP | {"SundayDate": "CAST(date_trunc('week', ts) AS DATE) + 6"})
_ATT_SQL = f"""
    a AS ({I.select_sql('events', I.ATTENDANCE_MAP)}), al AS ({I.ALIAS_SQL}),
    o AS (SELECT DISTINCT * FROM ({_OCC}))"""


@query("fact_check_in", f"""
    WITH {_ATT_SQL}
    SELECT a.Id AS attendance_id, al.PersonId IS NULL AS person_is_null,
           year(OccurrenceDate) * 10000 + month(OccurrenceDate) * 100 + day(OccurrenceDate)
             AS date_key,
           SundayDate AS sunday_date, coalesce(DidAttend, false) AS did_attend,
           coalesce(coalesce(DidAttend, false) AND NOT coalesce(DidNotOccur, false), false)
             AS is_check_in
    FROM a LEFT JOIN al ON al.Id = a.PersonAliasId LEFT JOIN o ON o.Id = a.OccurrenceId""")
def fact_check_in(spark, sf_dir):
    fact = gold.fct_attendance(S.attendance(I.attendance_bronze(spark, sf_dir)),
                               _aliases(spark, sf_dir), _occurrences(spark, sf_dir))
    return fact.select("attendance_id", F.col("person_key").isNull().alias("person_is_null"),
                       "date_key", "sunday_date", "did_attend", "is_check_in")


@query("fact_membership", f"""
    WITH b AS ({I.select_sql('events', I.MEMBER_MAP, I.GROUP_BY_MEMBER)})
    SELECT Id AS group_member_id, GroupRoleId AS group_role_id,
           year(DateTimeAdded) * 10000 + month(DateTimeAdded) * 100 + day(DateTimeAdded)
             AS added_date_key,
           coalesce(GroupMemberStatus = 1 AND NOT coalesce(IsArchived, false), false)
             AS is_currently_active_member
    FROM b""")
def fact_membership(spark, sf_dir):
    return gold.fct_group_membership(S.group_members(I.members_bronze(spark, sf_dir))).select(
        "group_member_id", "group_role_id", "added_date_key", "is_currently_active_member")


@query("fact_request_category", f"""
    WITH r AS ({I.select_sql(I.REQUEST_SOURCE, I.REQUEST_MAP | {'priority': 'o_orderpriority'})})
    SELECT Id AS connection_request_id, priority AS opportunity_name,
           CASE WHEN ConnectionOpportunityId = 60 THEN 'Door Holder'
                WHEN ConnectionOpportunityId IN (68, 69) THEN 'Connect Group'
                ELSE 'Other' END AS request_category,
           CreatedDateKey AS created_date_key,
           year(ConnectedDateTime) * 10000 + month(ConnectedDateTime) * 100
             + day(ConnectedDateTime) AS connected_date_key,
           datesub('day', CreatedDateTime, ConnectedDateTime) AS days_to_connect
    FROM r""",
       wide=("created_date_key",))
def fact_request_category(spark, sf_dir):
    return _requests(spark, sf_dir).select(
        "connection_request_id", "opportunity_name", "request_category", "created_date_key",
        "connected_date_key", "days_to_connect")


_ENGAGEMENT_SQL = f"""
    WITH {_ATT_SQL},
    m AS ({I.select_sql('events', I.MEMBER_MAP, I.GROUP_BY_MEMBER)}),
    g AS (SELECT DISTINCT * FROM ({I.select_sql('events', I.TEAM_MAP)})),
    t AS ({I.select_sql('region', I.GROUP_TYPE_MAP)}),
    p AS ({I.select_sql('customer', I.PEOPLE_MAP)}),
    r AS ({I.select_sql(I.REQUEST_SOURCE, I.REQUEST_MAP)}),
    ms AS (SELECT m.PersonId, CAST(m.DateTimeAdded AS DATE) AS added, GroupTypeId = 34 AS dh,
                  GroupTypeId = 38 AS cg,
                  coalesce(GroupMemberStatus = 1 AND NOT coalesce(m.IsArchived, false), false)
                    AND (g.IsActive AND NOT g.IsArchived) AS act
           FROM m JOIN g ON g.Id = m.GroupId),
    dh AS (SELECT PersonId, bool_or(act) AS active, count(*) FILTER (act) AS teams,
                  min(added) AS first_added
           FROM ms WHERE dh GROUP BY PersonId),
    cg AS (SELECT PersonId, count(*) FILTER (act) AS n FROM ms WHERE cg GROUP BY PersonId),
    rq AS (SELECT al.PersonId, count(*) AS n, min(CAST(CreatedDateTime AS DATE)) AS first_request,
                  bool_or(ConnectionState = 3) AS connected
           FROM r JOIN al ON al.Id = r.PersonAliasId
           WHERE ConnectionOpportunityId = 60 GROUP BY al.PersonId),
    ci AS (SELECT al.PersonId, OccurrenceDate AS d, SundayDate AS s, GroupTypeId = 34 AS dh,
                  coalesce(t.AttendanceCountsAsWeekendService, false) AS ws
           FROM a JOIN al ON al.Id = a.PersonAliasId JOIN dh ON dh.PersonId = al.PersonId
                JOIN o ON o.Id = a.OccurrenceId LEFT JOIN g ON g.Id = o.GroupId
                LEFT JOIN t ON t.Id = g.GroupTypeId
           WHERE DidAttend AND NOT coalesce(DidNotOccur, false)),
    ch AS (SELECT PersonId, count(*) AS n, min(d) AS first_d, max(d) AS last_d,
                  count(*) FILTER (d >= DATE '{{on}}' - 90) AS n90,
                  count(*) FILTER (d >= CAST(DATE '{{on}}' - INTERVAL 12 MONTH AS DATE)) AS n12,
                  count(DISTINCT CASE WHEN d >= CAST(DATE '{{on}}' - INTERVAL 12 MONTH AS DATE)
                                      THEN s END) AS w12,
                  count(*) FILTER (ws AND d >= CAST(DATE '{{on}}' - INTERVAL 12 MONTH AS DATE))
                    AS ws12,
                  count(*) FILTER (dh AND d >= CAST(DATE '{{on}}' - INTERVAL 12 MONTH AS DATE))
                    AS dh12
           FROM ci GROUP BY PersonId)
    SELECT p.Id AS person_id, coalesce(p.NickName, p.FirstName) || ' ' || p.LastName AS full_name,
           n_name AS campus_name,
           CASE WHEN p.BirthDay IS NOT NULL THEN year(DATE '{{on}}') - p.BirthYear
             - CASE WHEN strftime(DATE '{{on}}', '%m%d')
                         < strftime(make_date(BirthYear, BirthMonth, BirthDay), '%m%d')
                    THEN 1 ELSE 0 END END AS age,
           coalesce(dh.active, false) AS is_active_door_holder, teams AS
             active_door_holder_team_count, first_added AS first_door_holder_added_date,
           DATE '{{on}}' - first_added AS days_since_first_joined,
           coalesce(ch.n, 0) AS check_ins_total, first_d AS first_check_in_date,
           last_d AS last_check_in_date, DATE '{{on}}' - last_d AS days_since_last_check_in,
           coalesce(n90, 0) AS check_ins_last_90_days,
           coalesce(n12, 0) AS check_ins_last_12_months,
           coalesce(w12, 0) AS weeks_checked_in_last_12_months,
           coalesce(ws12, 0) AS weekend_service_check_ins_last_12_months,
           coalesce(dh12, 0) AS serving_check_ins_last_12_months,
           coalesce(cg.n, 0) > 0 AS is_in_connect_group,
           coalesce(cg.n, 0) AS active_connect_group_count,
           coalesce(rq.n, 0) AS door_holder_request_count,
           first_request AS first_door_holder_request_date,
           coalesce(rq.connected, false) AS has_connected_door_holder_request
    FROM dh JOIN p ON p.Id = dh.PersonId LEFT JOIN nation ON n_nationkey = p.PrimaryCampusId
         LEFT JOIN ch ON ch.PersonId = dh.PersonId LEFT JOIN cg ON cg.PersonId = dh.PersonId
         LEFT JOIN rq ON rq.PersonId = dh.PersonId""".replace("{on}", I.EVENTS_AS_OF)


def _engagement(spark, sf_dir):
    return gold.door_holder_engagement(
        gold.fct_group_membership(S.group_members(I.members_bronze(spark, sf_dir))),
        _team_groups(spark, sf_dir), _people(spark, sf_dir), _requests(spark, sf_dir),
        S.attendance(I.attendance_bronze(spark, sf_dir)), _aliases(spark, sf_dir),
        _occurrences(spark, sf_dir), S.group_types(I.group_types_bronze(spark, sf_dir)),
        I.EVENTS_AS_OF)


@query("engagement_mart", _ENGAGEMENT_SQL,
       wide=("age", "days_since_first_joined", "days_since_last_check_in"))
def engagement_mart(spark, sf_dir):
    return _engagement(spark, sf_dir).drop("person_key", "gender", "marital_status",
                                           "campus_id", "is_person_active")


@query("giving_mart", f"""
    WITH dh AS (SELECT DISTINCT user_id FROM events WHERE event_type IN ('view', 'click')),
    h AS (SELECT o_custkey, o_orderstatus, o_orderdate FROM orders
          QUALIFY row_number() OVER (PARTITION BY o_custkey
                                     ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
    SELECT o_orderstatus AS current_journey_giving_stage, count(*) AS door_holders
    FROM dh JOIN customer ON c_custkey = user_id LEFT JOIN h ON o_custkey = user_id
    GROUP BY 1""")
def giving_mart(spark, sf_dir):
    """Each door holder's current stage, taken from the open version of the history."""
    history = I.order_history(spark, sf_dir).select(
        F.col("version_id").alias("Id"), F.col("person_id").alias("PersonId"),
        (F.col("expire_date") == F.lit(journey.OPEN_END).cast("date"))
        .alias("CurrentRowIndicator"),
        F.col("stage").alias("CurrentJourneyGivingStage"))
    current = S.person_current(S.person_historical(I.as_bronze(history, S.PERSON_HISTORICAL)))
    return (gold.door_holder_giving(_engagement(spark, sf_dir), current)
            .groupBy("current_journey_giving_stage").agg(F.count("*").alias("door_holders")))


# --- giving extract ------------------------------------------------------------------

_GIVING_SQL = """
    WITH phones AS (SELECT user_id, 'tel-' || event_id AS phone_number FROM events
                    WHERE event_type IN ('view', 'click')
                    QUALIFY row_number() OVER (PARTITION BY user_id
                                               ORDER BY ts DESC, event_id DESC) = 1),
    homes AS (SELECT s_nationkey AS family_id, s_name AS city FROM supplier WHERE s_acctbal > 0
              QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey DESC) = 1),
    refunds AS (SELECT l_orderkey, min(l_suppkey) % 25 AS reason FROM lineitem
                WHERE l_returnflag = 'R' GROUP BY l_orderkey)
    SELECT DISTINCT p_brand AS fund_name, o_orderkey AS transaction_id, c_custkey AS person_id,
           c_nationkey AS family_id, c_name || ' Family' AS family_name,
           c_mktsegment AS first_name, c_name AS last_name, 'e' || c_custkey AS email,
           phone_number, city, ct.n_name AS currency_type, cc.n_name AS credit_card_type,
           CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS amount,
           CAST(o_orderdate AS DATE) AS transaction_day, s_name AS batch_name,
           rr.n_name AS refund_reason
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
         JOIN customer ON c_custkey = o_custkey
         LEFT JOIN supplier ON s_suppkey = o_custkey
         LEFT JOIN refunds ON refunds.l_orderkey = o_orderkey
         LEFT JOIN nation ct ON ct.n_nationkey = o_custkey % 25 AND ct.n_regionkey = 0
         LEFT JOIN nation cc ON cc.n_nationkey = o_orderkey % 25 AND cc.n_regionkey = 1
         LEFT JOIN nation rr ON rr.n_nationkey = reason AND rr.n_regionkey = 2
         LEFT JOIN phones ON user_id = c_custkey
         LEFT JOIN homes ON family_id = c_nationkey
    WHERE o_orderdate >= TIMESTAMP '1997-07-01' AND o_orderdate < TIMESTAMP '1998-03-01'
      AND o_orderstatus <> 'P'"""


@query("giving_extract", _GIVING_SQL)
def giving_extract(spark, sf_dir):
    def t(name):
        return I.table(spark, sf_dir, name)

    transactions = I.mapped(t("orders"), {
        "transaction_id": "o_orderkey", "transaction_at": "o_orderdate",
        "payment_id": "o_orderkey", "batch_id": "o_custkey",
        "authorized_alias_id": "o_custkey * 2",
        "source_type_value_id": "CASE o_orderstatus WHEN 'P' THEN 2521 WHEN 'F' THEN 10 END"})
    details = I.mapped(t("lineitem"), {
        "transaction_id": "l_orderkey", "account_id": "l_partkey",
        "amount": "CAST(l_extendedprice AS DECIMAL(18,2))"})
    payments = I.mapped(t("orders"), {"payment_id": "o_orderkey",
                                      "currency_value_id": "o_custkey % 25",
                                      "card_value_id": "o_orderkey % 25"})
    refunds = t("lineitem").where("l_returnflag = 'R'").groupBy(
        F.col("l_orderkey").alias("transaction_id")).agg(
        F.pmod(F.min("l_suppkey"), F.lit(25)).alias("refund_value_id"))
    values = I.mapped(t("nation"), {
        "defined_value_id": "n_nationkey", "value": "n_name",
        "defined_type_id": "CASE n_regionkey WHEN 0 THEN 10 WHEN 1 THEN 11 WHEN 2 THEN 37 END"})
    people = I.mapped(t("customer"), {
        "person_id": "c_custkey", "family_id": "c_nationkey", "first_name": "c_mktsegment",
        "last_name": "c_name", "email": "concat('e', c_custkey)"})
    numbers = I.mapped(t("events"), {
        "person_id": "user_id", "created_at": "ts", "id": "event_id",
        "number_type": "CASE WHEN event_type IN ('view', 'click') THEN 12 ELSE 11 END",
        "phone_number": "concat('tel-', event_id)"})
    places = I.mapped(t("supplier"), {
        "family_id": "s_nationkey", "id": "s_suppkey", "location_id": "s_suppkey",
        "location_type": "CASE WHEN s_acctbal > 0 THEN 19 ELSE 20 END"})
    locations = I.mapped(t("supplier"), {"location_id": "s_suppkey", "city": "s_name"})
    out = giving.giving_extract(
        transactions, details,
        I.mapped(t("part"), {"account_id": "p_partkey", "fund_name": "p_brand"}), payments,
        I.mapped(t("supplier"), {"batch_id": "s_suppkey", "batch_name": "s_name"}), refunds,
        values, _aliases(spark, sf_dir), people, giving.latest_phones(numbers),
        giving.home_locations(places, locations).select("family_id", "city"),
        "1997-07-01", "1998-03-01")
    return (out.withColumn("amount", F.col("amount").cast("double"))
            .withColumn("transaction_day", F.to_date("transaction_at")).drop("transaction_at"))


@query("latest_home_and_phone", """
    SELECT s_nationkey AS family_id, max(s_suppkey) AS location_id
    FROM supplier WHERE s_acctbal > 0 GROUP BY s_nationkey""")
def latest_home_and_phone(spark, sf_dir):
    places = I.mapped(I.table(spark, sf_dir, "supplier"), {
        "family_id": "s_nationkey", "id": "s_suppkey", "location_id": "s_suppkey",
        "location_type": "CASE WHEN s_acctbal > 0 THEN 19 ELSE 20 END"})
    locations = I.mapped(I.table(spark, sf_dir, "supplier"), {"location_id": "s_suppkey"})
    return giving.home_locations(places, locations).select("family_id", "location_id")


# --- lookups ---------------------------------------------------------------------------

_CONTEXT_SQL = """context AS (
      SELECT CAST(date_trunc('week', o_orderdate) AS DATE) + 6 AS sunday_date,
             CASE o_custkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C'
                  ELSE 'Online' END AS campus,
             max(o_totalprice) > 490000 AS rained, max(o_orderpriority) AS break_name,
             count(*) AS storms
      FROM orders GROUP BY 1, 2)"""


def _context(spark, sf_dir):
    from ..functions.dates import week_ending_sunday

    campus = ("CASE o_custkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' "
              "ELSE 'Online' END")
    return (I.table(spark, sf_dir, "orders")
            .groupBy(week_ending_sunday(F.to_date("o_orderdate")).alias("sunday_date"),
                     F.expr(campus).alias("campus"))
            .agg((F.max("o_totalprice") > 490000).alias("rained"),
                 F.max("o_orderpriority").alias("break_name"), F.count("*").alias("storms")))


@query("context_lookup", f"""
    WITH {I.HC_SQL}, {_CONTEXT_SQL}
    SELECT sunday_date, campus, sum(cnt)::BIGINT AS total, any_value(rained) AS rained,
           any_value(break_name) AS break_name, any_value(storms) AS storms
    FROM hc LEFT JOIN context USING (sunday_date, campus) GROUP BY sunday_date, campus""")
def context_lookup(spark, sf_dir):
    """Attendance beside its weather and school-break context; one column is looked
    up with the single-value check."""
    daily = I.headcount(spark, sf_dir).groupBy("sunday_date", "campus").agg(
        F.sum("cnt").alias("total"))
    context = _context(spark, sf_dir)
    out = lookup.with_context(daily, context, ["sunday_date", "campus"],
                              ["rained", "break_name"])
    return lookup.lookup_value(out, context, {"sunday_date": "sunday_date", "campus": "campus"},
                               "storms", "storms")


@query("axis_grid", f"""
    WITH {I.HC_SQL},
    axis AS (SELECT l AS literal, c AS campus, s AS schedule
             FROM unnest(['A', 'N', 'R', 'X']) a(l), unnest(['A', 'B', 'C']) b(c),
                  unnest(['9:30am', '11:45am', '5:00pm']) d(s))
    SELECT literal, campus, schedule, coalesce(sum(cnt), 0)::BIGINT AS total
    FROM axis LEFT JOIN hc USING (literal, campus, schedule)
    GROUP BY literal, campus, schedule""")
def axis_grid(spark, sf_dir):
    keys = ["literal", "campus", "schedule"]
    axis = literal_axis(spark, literal=("A", "N", "R", "X"), campus=I.CAMPUSES,
                        schedule=I.SERVICES).select(*keys)
    totals = I.headcount(spark, sf_dir).groupBy(*keys).agg(F.sum("cnt").alias("total"))
    return axis.join(totals, keys, "left").withColumn("total", F.coalesce("total", F.lit(0)))


@query("event_group_hotel", """
    SELECT r_regionkey AS event_id, r_name AS event_name, n_nationkey AS group_id,
           n_name AS group_name, s_suppkey AS hotel_id, s_name AS hotel_name
    FROM region JOIN nation ON n_regionkey = r_regionkey
         JOIN supplier ON s_nationkey % 5 = r_regionkey""")
def event_group_hotel(spark, sf_dir):
    def t(name, mapping):
        return I.mapped(I.table(spark, sf_dir, name), mapping)

    return lookup.event_group_hotels(
        t("region", {"id": "r_regionkey", "name": "r_name"}),
        t("nation", {"event_id": "n_regionkey", "group_id": "n_nationkey"}),
        t("supplier", {"event_id": "s_nationkey % 5", "hotel_id": "s_suppkey"}),
        t("nation", {"id": "n_nationkey", "name": "n_name"}),
        t("supplier", {"id": "s_suppkey", "name": "s_name"}))


@query("chained_lookup", """
    SELECT o_orderkey AS order_id, h.n_name AS hotel_name, r_name AS event_name,
           g.n_name AS group_name
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey
         LEFT JOIN nation h ON h.n_nationkey = c_nationkey
         LEFT JOIN region ON r_regionkey = c_nationkey % 6
         LEFT JOIN nation g ON g.n_nationkey = c_nationkey
    WHERE o_orderstatus = 'F' AND o_totalprice <= 400000""")
def chained_lookup(spark, sf_dir):
    from ..operators.camp import item_type

    def t(name, mapping):
        return I.mapped(I.table(spark, sf_dir, name), mapping)

    orders = t("orders", {
        "id": "o_orderkey", "orderable_id": "o_custkey", "event_group_id": "o_custkey",
        "orderable_type": "CASE o_orderstatus WHEN 'F' THEN r'App\\Models\\EventHotel' "
                          "ELSE r'App\\Models\\EventPackage' END",
        "deleted_at": "CASE WHEN o_totalprice > 400000 THEN o_orderdate END"})
    out = lookup.order_hotels(
        orders.withColumn("item_type", item_type("orderable_type")),
        t("customer", {"id": "c_custkey", "hotel_id": "c_nationkey",
                       "event_id": "c_nationkey % 6"}),
        t("nation", {"id": "n_nationkey", "name": "n_name"}),
        t("region", {"id": "r_regionkey", "name": "r_name"}),
        t("customer", {"id": "c_custkey", "group_id": "c_nationkey"}),
        t("nation", {"id": "n_nationkey", "name": "n_name"}))
    return out.select("order_id", "hotel_name", "event_name", "group_name")


@query("members_per_group", """
    SELECT p_partkey AS group_id, count(DISTINCT l_suppkey) AS member_count
    FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey
    HAVING count(l_suppkey) > 0
    UNION ALL SELECT p_partkey, NULL FROM part
    WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem)""")
def members_per_group(spark, sf_dir):
    groups = I.mapped(I.table(spark, sf_dir, "part"), {"group_id": "p_partkey"})
    members = I.mapped(I.table(spark, sf_dir, "lineitem"),
                       {"group_id": "l_partkey", "person_id": "l_suppkey"})
    return lookup.people_per_group(groups, members)


@query("max_chained_lookup", """
    WITH a AS (SELECT o_custkey, max(o_orderkey) AS o FROM orders GROUP BY 1),
         b AS (SELECT l_orderkey, max(l_partkey) AS p FROM lineitem GROUP BY 1),
         c AS (SELECT p_partkey, max(p_name) AS n FROM part GROUP BY 1)
    SELECT c_custkey AS group_id, n AS hotel_name
    FROM customer LEFT JOIN a ON o_custkey = c_custkey LEFT JOIN b ON l_orderkey = o
         LEFT JOIN c ON p_partkey = p""")
def max_chained_lookup(spark, sf_dir):
    def t(name, mapping):
        return I.mapped(I.table(spark, sf_dir, name), mapping)

    out = lookup.max_chain(
        t("customer", {"group_id": "c_custkey"}),
        (t("orders", {"group_id": "o_custkey", "event_id": "o_orderkey"}), "group_id",
         "event_id"),
        (t("lineitem", {"event_id": "l_orderkey", "hotel_id": "l_partkey"}), "event_id",
         "hotel_id"),
        (t("part", {"hotel_id": "p_partkey", "hotel_name": "p_name"}), "hotel_id",
         "hotel_name"))
    return out.select("group_id", "hotel_name")


@query("semi_anti", f"""
    SELECT c_custkey, 'semi' AS side FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 490000)
    UNION ALL SELECT c_custkey, 'anti' FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 490000)""")
def semi_anti(spark, sf_dir):
    customers = I.table(spark, sf_dir, "customer").select("c_custkey")
    large = (I.table(spark, sf_dir, "orders").where("o_totalprice > 490000")
             .select(F.col("o_custkey").alias("c_custkey")).distinct())
    kept = customers.join(large, "c_custkey", "left_semi").withColumn("side", F.lit("semi"))
    rest = customers.join(large, "c_custkey", "left_anti").withColumn("side", F.lit("anti"))
    return kept.unionByName(rest)


# --- giving stages ---------------------------------------------------------------------

_RANKS = {"F": 1, "O": 2, "P": 3}
_CODES = {"O": 1, "F": 2, "P": 3}


@query("asof_stage", f"""
    WITH {I.HISTORY_SQL},
    valid AS (SELECT c_nationkey AS family_id,
                     min(CASE stage WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 3 END) AS best
              FROM customer JOIN history ON person_id = c_custkey
              WHERE effective_date <= DATE '{I.AS_OF}' AND expire_date > DATE '{I.AS_OF}'
              GROUP BY c_nationkey)
    SELECT DISTINCT c_nationkey AS family_id, best AS stage_rank,
           coalesce(CASE best WHEN 1 THEN 2 WHEN 2 THEN 1 WHEN 3 THEN 3 END, 0) AS giving_code
    FROM customer LEFT JOIN valid ON family_id = c_nationkey""")
def asof_stage(spark, sf_dir):
    people = I.mapped(I.table(spark, sf_dir, "customer"),
                      {"person_id": "c_custkey", "family_id": "c_nationkey"})
    return journey.family_stage(people, I.order_history(spark, sf_dir), I.AS_OF,
                                ranks=_RANKS, codes=_CODES)


@query("history_validity", f"""
    WITH {I.HISTORY_SQL} SELECT * FROM history""")
def history_validity(spark, sf_dir):
    return I.order_history(spark, sf_dir)


@query("asof_join", f"""
    WITH {I.HISTORY_SQL}
    SELECT o.o_orderkey AS order_id, CAST(o.o_orderdate AS DATE) - 100 AS asked_on,
           h.stage, h.effective_date
    FROM orders o LEFT JOIN history h
      ON h.person_id = o.o_custkey AND h.effective_date <= CAST(o.o_orderdate AS DATE) - 100
     AND h.expire_date > CAST(o.o_orderdate AS DATE) - 100""")
def asof_join(spark, sf_dir):
    """The stage each customer was in 100 days before each of their orders."""
    facts = I.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("person_id"), F.col("o_orderkey").alias("order_id"),
        F.date_sub(F.to_date("o_orderdate"), 100).alias("asked_on"))
    out = journey.as_of_join(facts, I.order_history(spark, sf_dir), "person_id", "asked_on",
                             "version_id")
    return out.select("order_id", "asked_on", "stage", "effective_date")


_MIN = {"p": ("purchase",), "b": ("signup",), "d": ("view", "click")}
_CHECK_IN = {"person_id": "user_id", "sunday": "CAST(ts AS DATE)",
             "campus_id": "CASE user_id % 4 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 13 ELSE 5 END",
             "type_name": "event_type", "did_attend": "value > 10"}
_HOME = {"person_id": "c_custkey",
         "family_id": "CASE WHEN c_acctbal > 9000 THEN NULL ELSE c_custkey % 60 END",
         "lat": "CASE WHEN c_acctbal < 0 THEN NULL "
                "ELSE CAST(33.05 + c_nationkey * 0.1 AS DOUBLE) END",
         "lng": "CAST(-85.05 + c_nationkey * 0.05 AS DOUBLE)"}
_FAMILY_SQL = f"""
    ci AS (SELECT *, sunday AS day, CAST(date_trunc('week', sunday) AS DATE) + 6 AS sunday_date
           FROM ({I.select_sql('events', _CHECK_IN)})),
    pe AS ({I.select_sql('customer', _HOME)}),
    gifts AS (SELECT family_id, max(CAST(o_orderdate AS DATE)) AS last_gift_date,
                     max(CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END)
                       AS prev_gift_date
              FROM orders JOIN pe ON person_id = o_custkey GROUP BY family_id),
    mapped AS (SELECT sunday_date, family_id, lat, lng,
                      CASE campus_id WHEN 2 THEN '5' WHEN 3 THEN 'C' ELSE 'T' END AS cc,
                      CASE type_name WHEN 'purchase' THEN 'p' WHEN 'signup' THEN 'b'
                           ELSE 'd' END AS mc
               FROM ci JOIN pe USING (person_id)
               WHERE did_attend AND campus_id IN (2, 3, 13) AND type_name <> 'error'
                 AND lat BETWEEN 33.3 AND 34.5 AND lat <> 0 AND lng BETWEEN -85.2 AND -83.8
                 AND family_id IS NOT NULL),
    fam AS (SELECT sunday_date, family_id, lat, lng,
                   string_agg(DISTINCT cc, '' ORDER BY cc) AS campus_list,
                   string_agg(DISTINCT mc, '' ORDER BY mc) AS min_list, count(*) AS headcount
            FROM mapped GROUP BY 1, 2, 3, 4)"""


def _family_weeks(spark, sf_dir):
    from ..functions.dates import week_ending_sunday

    check_ins = I.mapped(I.table(spark, sf_dir, "events"), _CHECK_IN).withColumn(
        "sunday_date", week_ending_sunday("sunday"))
    people = I.mapped(I.table(spark, sf_dir, "customer"), _HOME)
    signals = I.mapped(I.table(spark, sf_dir, "orders"), {
        "person_id": "o_custkey", "last_gift_date": "CAST(o_orderdate AS DATE)",
        "prev_gift_date": "CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END"})
    per_person = signals.groupBy("person_id").agg(
        F.max("last_gift_date").alias("last_gift_date"),
        F.max("prev_gift_date").alias("prev_gift_date"))
    gifts = journey.gift_dates(per_person.join(people.select("person_id", "family_id"),
                                               "person_id"))
    return journey.family_week(journey.map_check_ins(check_ins, people, _MIN), gifts)


@query("family_rollup", f"""
    WITH {_FAMILY_SQL}
    SELECT fam.*, last_gift_date, prev_gift_date FROM fam LEFT JOIN gifts USING (family_id)""")
def family_rollup(spark, sf_dir):
    return _family_weeks(spark, sf_dir)


@query("family_map_rows", f"""
    WITH {I.HISTORY_SQL}, {_FAMILY_SQL},
    best AS (SELECT family_id,
                    min(CASE stage WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 3 END) AS b
             FROM pe JOIN history USING (person_id)
             WHERE effective_date <= DATE '{I.EVENTS_AS_OF}'
               AND expire_date > DATE '{I.EVENTS_AS_OF}' GROUP BY family_id)
    SELECT family_id, lat, lng, campus_list, min_list, headcount,
           coalesce(CASE b WHEN 1 THEN 2 WHEN 2 THEN 1 WHEN 3 THEN 3 END, 0) AS giving_code
    FROM fam LEFT JOIN best USING (family_id) WHERE sunday_date = DATE '{I.EVENTS_AS_OF}'""")
def family_map_rows(spark, sf_dir):
    people = I.mapped(I.table(spark, sf_dir, "customer"), _HOME)
    stages = journey.family_stage(people, I.order_history(spark, sf_dir), I.EVENTS_AS_OF,
                                  ranks=_RANKS, codes=_CODES)
    return journey.map_rows(_family_weeks(spark, sf_dir), stages.select(
        "family_id", "giving_code"), I.EVENTS_AS_OF).select(
        "family_id", "lat", "lng", "campus_list", "min_list", "headcount", "giving_code")
