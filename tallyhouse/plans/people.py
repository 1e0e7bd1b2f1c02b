"""Queries over engagement, signups and online audience."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import shared_folder
from ..functions.dates import month_day_number, week_ending_sunday
from ..operators import audience, bitmaps, engagement, lookup, signups
from ..operators.calendar import date_spine
from . import inputs as I
from .registry import query

DAY = f"DATE '{I.EVENTS_AS_OF}'"
AT = f"TIMESTAMP '{I.EVENTS_AS_OF} 00:00:00'"
AS_OF_TS = f"{I.EVENTS_AS_OF} 00:00:00"
ON = f"DATE '{I.AS_OF}'"
ORDERS_AT = f"TIMESTAMP '{I.AS_OF} 00:00:00'"
ORDERS_TS = f"{I.AS_OF} 00:00:00"


@query("period_distinct_people", f"""
    SELECT c_nationkey AS campus_id, o_orderpriority AS step_name,
           count(DISTINCT o_custkey) FILTER (o_orderdate >= {ORDERS_AT} - INTERVAL 90 DAY)
             AS past_90,
           count(DISTINCT o_custkey) FILTER (year(o_orderdate) = 2000) AS year_to_date,
           count(DISTINCT o_custkey) FILTER (o_orderdate >= {ORDERS_AT} - INTERVAL 365 DAY)
             AS past_365
    FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2""")
def period_distinct_people(spark, sf_dir):
    steps = I.mapped(I.table(spark, sf_dir, "orders"), {
        "step_name": "o_orderpriority", "person_id": "o_custkey", "started_at": "o_orderdate"})
    homes = I.mapped(I.table(spark, sf_dir, "customer"),
                     {"person_id": "c_custkey", "campus_id": "c_nationkey"})
    return engagement.launch_events(steps, ORDERS_TS, homes=homes)


# Three periods: whole weeks, a year that starts and ends within one, and days of one week.
_PERIODS = {"spring": ("2000-03-06", "2000-06-04"), "past_year": ("1999-06-05", "2000-06-03"),
            "midweek": ("2000-05-30", "2000-06-02")}
_BLANK = "CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_custkey END"


def _people_sql(first: str, last: str) -> str:
    within = f"CAST(o_orderdate AS DATE) BETWEEN DATE '{first}' AND DATE '{last}'"
    return (f"count(DISTINCT {_BLANK}) FILTER ({within}) + "
            f"CAST(bool_or({within} AND o_orderkey % 50 = 0) AS BIGINT)")


@query("period_people_bitmaps", f"""
    SELECT o_orderpriority AS step_name, {", ".join(
        f"{_people_sql(*days)} AS {name}" for name, days in _PERIODS.items())}
    FROM orders GROUP BY 1""")
def period_people_bitmaps(spark, sf_dir):
    """Distinct people per step in three periods, from weekly bitmaps that were kept; orders
    without a person count as one."""
    steps = I.mapped(I.table(spark, sf_dir, "orders"), {
        "step_name": "o_orderpriority", "person_id": _BLANK,
        "started": "CAST(o_orderdate AS DATE)"})
    folder = shared_folder(spark, "people-bitmaps")
    bitmaps.weekly_bitmaps(steps, ["step_name"], "person_id", "started").write.parquet(folder)
    return bitmaps.distinct_in_periods(steps, spark.read.parquet(folder), ["step_name"],
                                       "person_id", "started", _PERIODS)


@query("requests_completions", f"""
    SELECT o_custkey % 5 AS campus_id, o_orderpriority AS opportunity_name,
           count(*) FILTER (o_orderdate >= {ORDERS_AT} - INTERVAL 90 DAY) AS requests_90,
           count(*) FILTER (o_orderdate >= {ORDERS_AT} - INTERVAL 365 DAY) AS requests_365,
           count(*) FILTER (o_orderdate >= {ORDERS_AT} - INTERVAL 90 DAY
                            AND o_orderstatus = 'F') AS completed_90,
           count(*) FILTER (o_orderdate >= {ORDERS_AT} - INTERVAL 365 DAY
                            AND o_orderstatus = 'F') AS completed_365
    FROM orders GROUP BY 1, 2""")
def requests_completions(spark, sf_dir):
    requests = I.mapped(I.table(spark, sf_dir, "orders"), {
        "campus_id": "o_custkey % 5", "opportunity_name": "o_orderpriority",
        "created_at": "o_orderdate", "updated_at": "o_orderdate", "status": "o_orderstatus"})
    return engagement.requests_and_completions(requests, ORDERS_TS, "F")


_CHECK_INS = {"campus_id": "user_id % 4", "person_id": "user_id", "type_id": I.KIND,
              "occurrence_date": "CAST(ts AS DATE)", "did_attend": "value > 10",
              "is_first_time": "CASE WHEN value < 2 THEN NULL ELSE value > 100 END"}


def _check_ins(spark, sf_dir):
    return I.mapped(I.table(spark, sf_dir, "events"), _CHECK_INS)


_SUMMARY = f"""
    c AS ({I.select_sql('events', _CHECK_INS)}),
    summary AS (SELECT campus_id, occurrence_date,
                       count(DISTINCT person_id) FILTER (did_attend) AS check_ins,
                       count(DISTINCT person_id) FILTER (is_first_time) AS first_time
                FROM c WHERE type_id IN (1, 2) AND dayofweek(occurrence_date) = 0
                GROUP BY 1, 2)"""


@query("sunday_summary", f"WITH {_SUMMARY} SELECT * FROM summary")
def sunday_summary(spark, sf_dir):
    return engagement.sunday_summary(_check_ins(spark, sf_dir), (1, 2))


@query("serving_averages", f"""
    WITH {_SUMMARY},
    act AS (SELECT count(DISTINCT user_id) AS n FROM events WHERE event_type = 'view'),
    b AS (SELECT sum(check_ins) FILTER (occurrence_date >= {DAY} - 36) AS s,
                 count(DISTINCT occurrence_date) FILTER (occurrence_date >= {DAY} - 36) AS d,
                 (sum(first_time) FILTER (occurrence_date >= {DAY} - 36))::BIGINT AS new_recent,
                 (sum(first_time) FILTER (year(occurrence_date) = 2024))::BIGINT AS new_this_year
          FROM summary)
    SELECT n AS active_members, CAST(ceil(s / d::DOUBLE) AS BIGINT) AS serving,
           greatest(0, n - CAST(ceil(s / d::DOUBLE) AS BIGINT)) AS not_serving,
           new_recent, new_this_year FROM b, act""")
def serving_averages(spark, sf_dir):
    members = I.mapped(I.table(spark, sf_dir, "events"),
                       {"person_id": "user_id", "group_id": I.KIND, "type_id": I.KIND})
    active = engagement.active_members(members, 1).select("active_people").scalar()
    return engagement.serving_averages(
        engagement.sunday_summary(_check_ins(spark, sf_dir), (1, 2)), active, I.EVENTS_AS_OF)


@query("check_in_counts", f"""
    WITH c AS ({I.select_sql('events', _CHECK_INS)}),
    k AS (SELECT * FROM c WHERE did_attend AND type_id IN (3, 4))
    SELECT count(*) FILTER (occurrence_date > {DAY} - 35) AS check_ins_5_weeks,
           count(*) FILTER (year(occurrence_date) = 2024) AS check_ins_year,
           count(*) FILTER (occurrence_date > {DAY} - 35 AND is_first_time) AS new_5_weeks,
           count(*) FILTER (year(occurrence_date) = 2024 AND is_first_time) AS new_year
    FROM k""")
def check_in_counts(spark, sf_dir):
    return engagement.check_in_counts(_check_ins(spark, sf_dir), I.EVENTS_AS_OF, (3, 4))


_MEMBERS = {"person_id": "user_id", "group_id": "user_id % 12", "type_id": I.KIND,
            "created_at": "ts"}


def _members(spark, sf_dir):
    return I.mapped(I.table(spark, sf_dir, "events"), _MEMBERS)


@query("group_metrics", f"""
    WITH m AS ({I.select_sql('events', _MEMBERS)})
    SELECT type_id, count(*) FILTER (created_at >= {AT} - INTERVAL 7 DAY) AS past_7,
           count(*) FILTER (created_at >= {AT} - INTERVAL 90 DAY) AS past_90,
           count(*) FILTER (year(created_at) = 2024) AS year_to_date,
           count(*) FILTER (created_at >= {AT} - INTERVAL 365 DAY) AS past_365
    FROM m GROUP BY type_id""")
def group_metrics(spark, sf_dir):
    return engagement.new_members(_members(spark, sf_dir), AS_OF_TS)


@query("active_members", f"""
    WITH m AS ({I.select_sql('events', _MEMBERS)})
    SELECT count(DISTINCT person_id) AS active_people, count(DISTINCT group_id) AS active_groups
    FROM m WHERE type_id = 2""")
def active_members(spark, sf_dir):
    return engagement.active_members(_members(spark, sf_dir), 2)


@query("social_signups", f"""
    SELECT count(DISTINCT user_id) AS signups FROM events
    WHERE event_type = 'signup' AND ts >= {AT} - INTERVAL 35 DAY""")
def social_signups(spark, sf_dir):
    return engagement.social_signups(_members(spark, sf_dir), AS_OF_TS, 4)


@query("latest_check_in_label", f"""
    SELECT coalesce('Last Checkin - ' || strftime(max(CAST(ts AS DATE)), '%m/%d'), '-')
             AS latest_check_in FROM events WHERE event_type = 'purchase'""")
def latest_check_in_label(spark, sf_dir):
    return engagement.latest_check_in_label(_check_ins(spark, sf_dir), 3)


_ANSWERS = {"created_at": "o_orderdate", "value": "CASE o_orderstatus WHEN 'F' THEN 'YES' "
                                                  "WHEN 'O' THEN 'yes' ELSE 'no' END"}
_WINDOW_COUNTS = f"""
    count(*) FILTER (d >= {ORDERS_AT} - INTERVAL 365 DAY) AS past_365,
    count(*) FILTER (year(d) = 2000) AS year_to_date,
    count(*) FILTER (d >= {ORDERS_AT} - INTERVAL 90 DAY) AS past_90"""


@query("answer_counts", f"""
    SELECT {_WINDOW_COUNTS} FROM (SELECT o_orderdate AS d FROM orders
                                  WHERE o_orderstatus IN ('F', 'O'))""")
def answer_counts(spark, sf_dir):
    return engagement.answers(I.mapped(I.table(spark, sf_dir, "orders"), _ANSWERS), ORDERS_TS)


@query("comparison_unpivot", f"""
    WITH w AS (SELECT 'Yes' AS class, {_WINDOW_COUNTS} FROM (
                 SELECT o_orderdate AS d FROM orders WHERE o_orderstatus IN ('F', 'O'))
               UNION ALL
               SELECT o_orderpriority, {_WINDOW_COUNTS} FROM (
                 SELECT o_orderpriority, o_orderdate AS d FROM orders) GROUP BY o_orderpriority)
    SELECT class, 'Past 365 Days' AS time_period, 1 AS sort_order, past_365 AS value FROM w
    UNION ALL SELECT class, 'Year To Date', 2, year_to_date FROM w
    UNION ALL SELECT class, 'Past 90 Days', 3, past_90 FROM w""")
def comparison_unpivot(spark, sf_dir):
    orders = I.table(spark, sf_dir, "orders")
    yes = engagement.answers(I.mapped(orders, _ANSWERS), ORDERS_TS).withColumn(
        "class", F.lit("Yes"))
    members = engagement.new_members(
        orders.select(F.col("o_orderpriority").alias("class"),
                      F.col("o_orderdate").alias("created_at")), ORDERS_TS, ["class"])
    return engagement.comparison(yes.unionByName(members.drop("past_7")), "class")


# --- report visuals ------------------------------------------------------------------------

@query("team_table", """
    SELECT p_brand AS group_name, sum(m)::BIGINT AS members
    FROM part JOIN (SELECT l_partkey, count(DISTINCT l_suppkey) AS m FROM lineitem GROUP BY 1)
      ON l_partkey = p_partkey
    WHERE p_type = 'PROMO' GROUP BY 1""")
def team_table(spark, sf_dir):
    """Parts as groups, their suppliers as members."""
    groups = I.mapped(I.table(spark, sf_dir, "part"), {
        "group_id": "p_partkey", "group_name": "p_brand", "type_id": "p_type"})
    members = I.mapped(I.table(spark, sf_dir, "lineitem"),
                       {"group_id": "l_partkey", "person_id": "l_suppkey"})
    return engagement.team_table(lookup.people_per_group(groups, members), "PROMO")


_LINES = {"group_id": "l_partkey", "type_id": "l_returnflag",
          "occurrence_date": "CAST(l_shipdate AS DATE)", "did_attend": "l_quantity > 5",
          "is_first_time": "CASE WHEN l_tax > 0.07 THEN NULL ELSE l_discount < 0.03 END"}


@query("check_in_matrix", f"""
    WITH c AS ({I.select_sql('lineitem', _LINES)})
    SELECT p_name AS group_name,
           count(*) FILTER (occurrence_date > {ON} - 35 AND is_first_time) AS new_5_weeks,
           count(*) FILTER (occurrence_date > {ON} - 35) AS check_ins_5_weeks,
           count(*) FILTER (year(occurrence_date) = 2000 AND is_first_time) AS new_year,
           count(*) FILTER (year(occurrence_date) = 2000) AS check_ins_year
    FROM c JOIN part ON p_partkey = group_id
    WHERE did_attend AND type_id IN ('A', 'N') AND p_size <= 45
      AND p_type IN ('PROMO', 'SMALL', 'LARGE') GROUP BY p_name""")
def check_in_matrix(spark, sf_dir):
    groups = I.mapped(I.table(spark, sf_dir, "part"), {
        "group_id": "p_partkey", "group_name": "p_name", "type_name": "p_type",
        "is_archived": "p_size > 45"})
    return engagement.check_in_matrix(I.mapped(I.table(spark, sf_dir, "lineitem"), _LINES), groups,
                                      I.AS_OF, ("PROMO", "SMALL", "LARGE"), ("A", "N"))


@query("sunday_trend", f"""
    WITH {_SUMMARY}
    SELECT occurrence_date, sum(check_ins)::BIGINT AS check_ins,
           sum(first_time)::BIGINT AS first_time
    FROM summary WHERE occurrence_date BETWEEN {DAY} - 34 AND {DAY} GROUP BY 1""")
def sunday_trend(spark, sf_dir):
    return engagement.sunday_trend(
        engagement.sunday_summary(_check_ins(spark, sf_dir), (1, 2)), I.EVENTS_AS_OF)


@query("request_chart", f"""
    SELECT count(*) FILTER (o_orderdate >= {ORDERS_AT} - INTERVAL 365 DAY)
             AS requests_365,
           count(*) FILTER (o_orderdate >= {ORDERS_AT} - INTERVAL 365 DAY AND o_orderstatus = 'F')
             AS completed_365
    FROM orders""")
def request_chart(spark, sf_dir):
    return engagement.chart_sums(requests_completions(spark, sf_dir),
                                 ["requests_365", "completed_365"])


@query("launch_chart", f"""
    SELECT step_name, sum(past_365)::BIGINT AS past_365, sum(past_90)::BIGINT AS past_90 FROM (
      SELECT c_nationkey, o_orderpriority AS step_name,
             count(DISTINCT o_custkey) FILTER (o_orderdate >= {ORDERS_AT} - INTERVAL 365 DAY)
               AS past_365,
             count(DISTINCT o_custkey) FILTER (o_orderdate >= {ORDERS_AT} - INTERVAL 90 DAY)
               AS past_90
      FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2) GROUP BY 1""")
def launch_chart(spark, sf_dir):
    return engagement.chart_sums(period_distinct_people(spark, sf_dir),
                                 ["past_365", "past_90"], "step_name")


# --- signups -----------------------------------------------------------------------------

_SIGNUPS = {"event": "o_orderpriority", "signed_up": "CAST(o_orderdate AS DATE)",
            "project": "o_custkey", "person": "o_orderkey"}


@query("cumulative_by_series", """
    WITH c AS (SELECT o_orderpriority AS event,
                      month(o_orderdate) * 100 + day(o_orderdate) AS month_day, count(*) AS n
               FROM orders GROUP BY 1, 2),
    axis AS (SELECT * FROM (SELECT DISTINCT event FROM c), (SELECT DISTINCT month_day FROM c))
    SELECT event, month_day, CASE WHEN month_day <= 618 THEN
             (sum(coalesce(n, 0)) OVER (PARTITION BY event ORDER BY month_day))::BIGINT END
             AS cumulative
    FROM axis LEFT JOIN c USING (event, month_day)""",
       wide=("month_day",))
def cumulative_by_series(spark, sf_dir):
    rows = I.mapped(I.table(spark, sf_dir, "orders"), _SIGNUPS)
    return signups.cumulative(rows, "event", "signed_up", until=618)


@query("cumulative_on_axis", """
    WITH c AS (SELECT o_orderpriority AS event, o_orderdate AS d FROM orders),
    axis AS (SELECT month(x) * 100 + day(x) AS month_day
             FROM (SELECT unnest(range(DATE '2001-04-21', DATE '2001-06-19', INTERVAL 1 DAY)) AS x))
    SELECT event, month_day,
           count(*) FILTER (month(d) * 100 + day(d) <= month_day) AS cumulative
    FROM c, axis GROUP BY event, month_day""", wide=("month_day",))
def cumulative_on_axis(spark, sf_dir):
    """The report's own axis, April 21 to June 18."""
    axis = date_spine(spark, "2001-04-21", "2001-06-18").select(
        month_day_number("date_day").alias("month_day"))
    rows = I.mapped(I.table(spark, sf_dir, "orders"), _SIGNUPS)
    return signups.cumulative(rows, "event", "signed_up", axis=axis)


@query("signups_on_day", """
    SELECT count(DISTINCT user_id) AS signups, count(DISTINCT event_type) AS projects,
           count(DISTINCT user_id) FILTER (month(ts) = 1 AND day(ts) = 14) AS signups_on_day,
           max(dayname(ts)) FILTER (month(ts) = 1 AND day(ts) = 14) AS day_of_week
    FROM events""")
def signups_on_day(spark, sf_dir):
    rows = I.mapped(I.table(spark, sf_dir, "events"), {
        "day": "CAST(ts AS DATE)", "person": "user_id", "project": "event_type"})
    return signups.on_day(rows, "day", 114, "person", "project")


@query("signup_map", """
    SELECT c_nationkey AS place, min(c_name) AS address,
           count(DISTINCT o_orderpriority) AS projects, count(DISTINCT o_custkey) AS signups
    FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1""")
def signup_map(spark, sf_dir):
    customers = I.mapped(I.table(spark, sf_dir, "customer"), {
        "person": "c_custkey", "place": "c_nationkey", "address": "c_name"})
    pairs = I.mapped(I.table(spark, sf_dir, "orders"), {
        "person": "o_custkey", "project": "o_orderpriority"}).distinct()
    rows = pairs.join(customers, "person")
    return signups.by_place(rows, "place", "address", "project", "person")


# --- audience ----------------------------------------------------------------------------

_WEEK = "CAST(date_trunc('week', o_orderdate) AS DATE) + 6"
_ONLINE_SQL = f"""
    v AS (SELECT {_WEEK} AS sunday_date, o_orderstatus AS s,
                 CAST(floor(o_totalprice / 1000) AS BIGINT) AS views, o_orderdate FROM orders),
    p AS (SELECT sunday_date,
                 (sum(CAST(round(views * 1.94::DOUBLE) AS BIGINT))
                    FILTER (s = 'O' AND o_orderdate >= TIMESTAMP '1998-01-01'))::BIGINT AS a,
                 (sum(CAST(round(views * 1.94::DOUBLE) AS BIGINT)) FILTER (s = 'P'))::BIGINT AS b,
                 (sum(views) FILTER (s = 'F' OR (s = 'O' AND o_orderdate < TIMESTAMP '1998-01-01')))
                   ::BIGINT AS old
          FROM v GROUP BY 1),
    weekly AS (SELECT sunday_date, CASE WHEN a > 0 THEN a + coalesce(b, 0) ELSE old END AS online,
                      CASE WHEN a > 0 THEN a ELSE old END AS online_one_platform FROM p)"""


def _weekly_online(spark, sf_dir):
    rows = I.table(spark, sf_dir, "orders").select(
        week_ending_sunday(F.to_date("o_orderdate")).alias("sunday_date"), "o_orderstatus",
        "o_orderdate", F.floor(F.col("o_totalprice") / 1000).alias("views"))
    # Open orders are counted by hand until platform A starts in 1998.
    started = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    is_open = F.col("o_orderstatus") == "O"
    a = rows.where(is_open & started)
    return audience.weekly_online(
        a.withColumnRenamed("views", "total_views"),
        rows.where("o_orderstatus = 'P'").withColumnRenamed("views", "one_minute_views"),
        rows.where((F.col("o_orderstatus") == "F") | (is_open & ~started))
        .withColumnRenamed("views", "cnt"))


@query("audience_online", f"""
    WITH {_ONLINE_SQL}
    SELECT w.*, q.online AS prior_year FROM weekly w
    LEFT JOIN weekly q ON q.sunday_date = w.sunday_date - 364""")
def audience_online(spark, sf_dir):
    return audience.online_history(_weekly_online(spark, sf_dir))


@query("audience_card", f"""
    WITH {_ONLINE_SQL},
    m AS (SELECT round(avg(online)) AS five FROM (
            SELECT online FROM weekly WHERE online > 0 AND sunday_date <= {ON}
              AND sunday_date >= {ON} - 63 ORDER BY sunday_date DESC LIMIT 5)),
    c AS (SELECT (SELECT online FROM weekly WHERE sunday_date = {ON}) AS current,
                 (SELECT online_one_platform FROM weekly WHERE sunday_date = {ON} - 7)
                   AS previous_week,
                 (SELECT online FROM weekly WHERE sunday_date = {ON} - 364) AS prior_year, five
                   AS five_week_average FROM m)
    SELECT *, round((current - previous_week) / previous_week::DOUBLE, 6) AS wow,
           round((current - prior_year) / prior_year::DOUBLE, 6) AS yoy,
           round((current - five_week_average) / five_week_average, 6) AS against_average
    FROM c""")
def audience_card(spark, sf_dir):
    return audience.online_card(_weekly_online(spark, sf_dir), I.AS_OF)


@query("first_time_week", f"""
    WITH f AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS d FROM orders GROUP BY 1),
    axis AS (SELECT DATE '1995-06-04' - (7 * k)::INTEGER AS week_end
             FROM unnest(range(0, 5)) t(k))
    SELECT week_end, count(o_custkey) AS people
    FROM axis LEFT JOIN f ON d BETWEEN week_end - 6 AND week_end GROUP BY week_end""")
def first_time_week(spark, sf_dir):
    first = I.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("person_id")).agg(
        F.min(F.to_date("o_orderdate")).alias("first_date"))
    return audience.first_time_by_week(first, "1995-06-04")


@query("single_value_or_null", """
    WITH s AS (SELECT l_orderkey, l_returnflag AS literal,
                      nullif(l_linestatus, 'O') AS schedule FROM lineitem)
    SELECT l_orderkey,
           CASE WHEN count(DISTINCT schedule) + CAST(count(*) > count(schedule) AS INT) = 1
                THEN max(schedule) END AS only_schedule,
           coalesce(CASE WHEN count(DISTINCT literal) = 1 THEN max(literal) END, 'All Ministries')
             AS title
    FROM s GROUP BY l_orderkey""")
def single_value_or_null(spark, sf_dir):
    """The one schedule and ministry of each order's lines; a blank is a value too."""
    rows = I.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_returnflag").alias("literal"),
        F.nullif("l_linestatus", F.lit("O")).alias("schedule"))
    return rows.groupBy("l_orderkey").agg(
        audience.single_value("schedule").alias("only_schedule"),
        F.coalesce(audience.single_value("literal"), F.lit("All Ministries")).alias("title"))


_CLIPS = {"video_id": "CAST(user_id AS STRING)", "title": "concat('Talk - ', user_id)",
          "total_views": "CAST(floor(value * 10) AS BIGINT)", "published_on": "CAST(ts AS DATE)"}


@query("weekly_sermon", f"""
    WITH c AS (SELECT 'Talk - ' || user_id AS title, CAST(user_id AS VARCHAR) AS video_id,
                      CAST(floor(value * 10) AS BIGINT) AS views FROM events
               WHERE CAST(ts AS DATE) BETWEEN {DAY} AND {DAY} + 1),
    one AS (SELECT CASE WHEN count(DISTINCT title) = 1 THEN max(title) END AS raw_title,
                   sum(views)::BIGINT AS views,
                   CASE WHEN count(DISTINCT video_id) = 1 THEN max(video_id) END AS video_id FROM c)
    SELECT raw_title, views, video_id,
           CASE WHEN raw_title IS NOT NULL THEN 'Talk' END AS sermon_title,
           substr(raw_title, 8) AS speaker,
           'https://img.youtube.com/vi/' || video_id || '/maxresdefault.jpg' AS thumbnail_url
    FROM one""")
def weekly_sermon(spark, sf_dir):
    """The clips of one Sunday and Monday: blank unless exactly one title was released."""
    clips = I.mapped(I.table(spark, sf_dir, "events"), _CLIPS)
    return audience.weekly_sermon(clips, I.EVENTS_AS_OF)
