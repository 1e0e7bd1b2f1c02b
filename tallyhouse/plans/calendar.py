"""Queries over calendars, date arithmetic and display formats."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import dates as D
from ..operators import calendar, engagement
from . import inputs as I
from .registry import query

ON = f"DATE '{I.AS_OF}'"
WEEK = "((dayofyear({0}) + dayofweek(CAST(date_trunc('year', {0}) AS DATE)) - 1) // 7 + 1)"


@query("date_dimension", """
    WITH days AS (SELECT unnest(range(DATE '1995-01-01', max(CAST(o_orderdate AS DATE)) + 1,
                                      INTERVAL 1 DAY))::DATE AS d FROM orders),
    n AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS orders FROM orders GROUP BY 1)
    SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, d AS date_day,
           year(d) AS calendar_year, quarter(d) AS calendar_quarter, month(d) AS month_number,
           monthname(d) AS month_name, CAST(date_trunc('month', d) AS DATE) AS month_start_date,
           dayofweek(d) + 1 AS day_of_week_number, dayname(d) AS day_of_week_name,
           dayofweek(d) IN (0, 6) AS is_weekend,
           CAST(date_trunc('week', d) AS DATE) + 6 AS sunday_date, coalesce(orders, 0) AS orders
    FROM days LEFT JOIN n USING (d)""",
       wide=("calendar_year", "calendar_quarter", "month_number", "day_of_week_number"))
def date_dimension(spark, sf_dir):
    """The date dimension from a fixed start to the newest order, with daily orders."""
    orders = I.table(spark, sf_dir, "orders")
    dim = calendar.date_attributes(
        calendar.spine_to_max(orders, "o_orderdate", "1995-01-01"), "date_day")
    daily = orders.groupBy(F.to_date("o_orderdate").alias("date_day")).agg(
        F.count("*").alias("orders"))
    return dim.join(daily, "date_day", "left").withColumn(
        "orders", F.coalesce("orders", F.lit(0)))


@query("auto_calendar", """
    WITH b AS (SELECT make_date(min(year(l_shipdate)), 1, 1) AS a,
                      make_date(max(year(l_shipdate)), 12, 31) AS z FROM lineitem),
    days AS (SELECT unnest(range(a, z + 1, INTERVAL 1 DAY))::DATE AS d FROM b)
    SELECT d AS date_day, year(d) AS year, month(d) AS month_no, monthname(d) AS month,
           quarter(d) AS quarter_no, 'Qtr ' || quarter(d) AS quarter, day(d) AS day FROM days""",
       wide=("year", "month_no", "quarter_no", "day"))
def auto_calendar(spark, sf_dir):
    return calendar.auto_calendar(I.table(spark, sf_dir, "lineitem"), "l_shipdate")


@query("report_calendar", f"""
    WITH d AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date_day FROM lineitem)
    SELECT date_day, strftime(date_day, '%b %y') AS formatted_date,
           year(date_day) % 100 * 100 + month(date_day) AS year_month_number,
           strftime(date_day, '%Y%m%d') AS day_sort, strftime(date_day, '%y%m%d') AS
             short_day_sort,
           {WEEK.format('date_day')} AS week_number,
           year(date_day) || lpad(CAST({WEEK.format('date_day')} AS VARCHAR), 2, '0')
             AS rolling_week_sort,
           date_day - CAST(dayofweek(date_day) AS INTEGER) AS week_start_date,
           CAST(date_trunc('month', date_day) AS DATE) AS month_start_date,
           strftime(date_day, '%Y-%m') AS year_month,
           year(date_day) || '-Q' || quarter(date_day) AS year_quarter
    FROM d""",
       wide=("year_month_number", "week_number"))
def report_calendar(spark, sf_dir):
    days = calendar.fact_dates(I.table(spark, sf_dir, "lineitem"), "l_shipdate")
    return calendar.report_attributes(days, "date_day")


@query("us_week_number", f"""
    WITH {I.HC_SQL}
    SELECT sunday_date, {WEEK.format('sunday_date')} AS week_number,
           year(sunday_date) % 100 * 100 + month(sunday_date) AS yymm, sum(cnt)::BIGINT AS total
    FROM hc GROUP BY 1, 2, 3""",
       wide=("week_number", "yymm"))
def us_week_number(spark, sf_dir):
    per_date = I.headcount(spark, sf_dir).groupBy("sunday_date").agg(F.sum("cnt").alias("total"))
    return per_date.select(
        "sunday_date", D.us_week_number("sunday_date").alias("week_number"),
        D.yymm_number("sunday_date").alias("yymm"), "total")


@query("day_axis", """
    WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events),
    r AS (SELECT day, day - min(day) OVER () AS date_rank FROM d)
    SELECT day, strftime(day, '%m/%d') AS display_date,
           month(day) * 100 + day(day) AS month_day_number,
           make_date(2000, month(day), day(day)) AS normalized_date, date_rank,
           CASE WHEN date_rank % 2 = 0 THEN strftime(day, '%m/%d') ELSE chr(8203) END
             AS axis_label,
           dayname(day) AS day_of_week_name
    FROM r""",
       wide=("month_day_number", "date_rank"))
def day_axis(spark, sf_dir):
    days = calendar.fact_dates(I.table(spark, sf_dir, "events"), "ts", "day")
    return calendar.day_axis(days, "day")


@query("age_years", f"""
    SELECT o_orderkey, year({ON}) - year(o_orderdate)
           - CASE WHEN strftime({ON}, '%m%d') < strftime(o_orderdate, '%m%d') THEN 1 ELSE 0 END
             AS age
    FROM orders""",
       wide=("age",))
def age_years(spark, sf_dir):
    return I.table(spark, sf_dir, "orders").select(
        "o_orderkey", D.age_years(F.to_date("o_orderdate"), I.AS_OF).alias("age"))


@query("prior_year_dates", """
    WITH d AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem),
    p AS (SELECT d, CAST(make_date(year(d) - 1, month(d), 1) + (day(d) - 1)::INTEGER AS DATE) AS p
          FROM d)
    SELECT d AS day, p AS year_before,
           CAST(p + CASE isodow(p) WHEN 1 THEN 0 WHEN 2 THEN -1 WHEN 3 THEN -2 WHEN 4 THEN -3
                         WHEN 5 THEN 2 WHEN 6 THEN 1 ELSE 0 END AS DATE) AS snapped,
           CAST(d - CAST(dayofweek(d) AS INTEGER) AS DATE) AS last_sunday
    FROM p""")
def prior_year_dates(spark, sf_dir):
    days = calendar.fact_dates(I.table(spark, sf_dir, "lineitem"), "l_shipdate", "day")
    return days.select("day", D.year_before("day").alias("year_before"),
                       D.snapped_year_before("day").alias("snapped"),
                       D.last_sunday("day").alias("last_sunday"))


@query("recent_sunday", f"""
    WITH s AS (SELECT CAST(DATE '{I.EVENTS_AS_OF}' + 3
                 - CAST(dayofweek(DATE '{I.EVENTS_AS_OF}' + 3) AS INTEGER) AS DATE) AS sunday)
    SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events, s
    WHERE CAST(ts AS DATE) IN (sunday, sunday + 1, sunday - 7) GROUP BY 1, 2""")
def recent_sunday(spark, sf_dir):
    """Events of the newest Sunday up to a Wednesday, its Monday, and the Sunday before."""
    sunday = D.last_sunday(F.date_add(D.as_date(I.EVENTS_AS_OF), 3))
    day = F.to_date("ts")
    wanted = [sunday, F.date_add(sunday, 1), F.date_sub(sunday, 7)]
    return (I.table(spark, sf_dir, "events").where(day.isin(*wanted))
            .groupBy(day.alias("day"), "event_type").agg(F.count("*").alias("n")))


_RHYTHM = {"group_id": "c_custkey", "meeting_rhythm":
           "CASE c_mktsegment WHEN 'BUILDING' THEN 'once' WHEN 'MACHINERY' THEN 'weekly' "
           "WHEN 'FURNITURE' THEN 'every other week' WHEN 'HOUSEHOLD' THEN 'monthly' "
           "ELSE 'never' END"}
_RHYTHM["start_date"] = ("CASE WHEN c_acctbal < 0 THEN NULL ELSE make_date(1999 + c_custkey % 2, "
                         "1 + c_nationkey % 12, CASE WHEN c_nationkey % 12 = 1 THEN 28 "
                         "WHEN c_nationkey % 12 IN (0, 2, 4, 6, 7, 9, 11) THEN 31 "
                         "ELSE 30 - c_custkey % 20 END) END")


@query("recurrence_count", f"""
    WITH g AS ({I.select_sql('customer', _RHYTHM)}),
    k AS (SELECT *, unnest(range(0, 80)) AS k FROM g),
    m AS (SELECT group_id, meeting_rhythm,
                 CASE meeting_rhythm WHEN 'once' THEN CASE WHEN k = 0 THEN start_date END
                      WHEN 'weekly' THEN start_date + (7 * k)::INTEGER
                      WHEN 'every other week' THEN start_date + (14 * k)::INTEGER
                      WHEN 'monthly' THEN CAST(start_date + to_months(k::INTEGER) AS DATE) END AS d
          FROM k)
    SELECT group_id, meeting_rhythm,
           count(*) FILTER (d BETWEEN {ON} - 35 AND {ON}) AS meetings
    FROM m GROUP BY group_id, meeting_rhythm""")
def recurrence_count(spark, sf_dir):
    groups = I.mapped(I.table(spark, sf_dir, "customer"), _RHYTHM)
    return groups.select("group_id", "meeting_rhythm", D.meetings_in_period(
        "start_date", "meeting_rhythm", I.AS_OF).alias("meetings"))


@query("meetings_held", f"""
    WITH g AS ({I.select_sql('customer', _RHYTHM)}),
    k AS (SELECT *, unnest(range(0, 80)) AS k FROM g),
    m AS (SELECT meeting_rhythm,
                 CASE meeting_rhythm WHEN 'once' THEN CASE WHEN k = 0 THEN start_date END
                      WHEN 'weekly' THEN start_date + (7 * k)::INTEGER
                      WHEN 'every other week' THEN start_date + (14 * k)::INTEGER
                      WHEN 'monthly' THEN CAST(start_date + to_months(k::INTEGER) AS DATE) END AS d
          FROM k)
    SELECT meeting_rhythm, count(*) FILTER (d BETWEEN {ON} - 35 AND {ON}) AS meetings
    FROM m GROUP BY meeting_rhythm""")
def meetings_held(spark, sf_dir):
    return engagement.meetings_held(I.mapped(I.table(spark, sf_dir, "customer"), _RHYTHM),
                                    I.AS_OF)


@query("display_formats", f"""
    WITH r AS (SELECT *, o_totalprice / 300000 - 0.8 AS ratio, CAST(o_orderdate AS DATE) AS d
               FROM orders),
    q AS (SELECT *, CAST(round(CAST(o_totalprice AS DECIMAL(18,2))) AS BIGINT) AS whole,
                 CAST(round((o_custkey - 700) / 7.0::DOUBLE * 1000) AS BIGINT) AS tenths FROM r)
    SELECT o_orderkey, false AS key_is_null,
           CAST(round((o_custkey - 700) / 7.0::DOUBLE * 100) AS BIGINT) || '%' AS percent,
           CASE WHEN tenths > 0 THEN '+' WHEN tenths < 0 THEN '-' ELSE '' END
             || abs(tenths) // 10 || '.' || abs(tenths) % 10 || '%' AS signed,
           format('{{:,}}', whole) AS thousands, strftime(d, '%b %y') AS month_year,
           strftime(d, '%m/%d') AS month_day,
           month(d) || '/' || day(d) || '/' || year(d) AS short_date,
           CASE WHEN o_orderstatus = 'F' THEN '-' ELSE CAST(o_custkey AS VARCHAR) END AS display,
           lpad(CAST(month(d) AS VARCHAR), 2, '0') AS padded,
           CASE WHEN o_custkey - 700 >= 0 THEN '▲' ELSE '▼' END AS arrow,
           '04/30 - 06/04' AS period
    FROM q ORDER BY o_orderstatus DESC, o_orderkey""")
def display_formats(spark, sf_dir):
    ratio = (F.col("o_custkey") - 700) / F.lit(7.0)
    day = F.to_date("o_orderdate")
    return (I.table(spark, sf_dir, "orders")
            .orderBy(F.desc("o_orderstatus"), F.asc("o_orderkey"))
            .select("o_orderkey", C.surrogate_key("o_orderkey").isNull().alias("key_is_null"),
                    C.percent_text(ratio).alias("percent"),
                    C.signed_percent_text(ratio).alias("signed"),
                    C.thousands_text(C.exact("o_totalprice")).alias("thousands"),
                    C.month_year_text(day).alias("month_year"),
                    C.month_day_text(day).alias("month_day"),
                    C.short_date_text(day).alias("short_date"),
                    C.dash_if_null(F.when(F.col("o_orderstatus") != "F", F.col("o_custkey")))
                    .alias("display"),
                    C.pad2(F.month(day)).alias("padded"), C.trend_arrow(ratio).alias("arrow"),
                    engagement.date_range_label(I.AS_OF).alias("period")))


@query("refresh_stamp", """
    SELECT 'Last updated: ' || strftime(max(ts) - INTERVAL 4 HOUR, '%b %-d, %Y %-I:%M %p')
             AS last_refreshed FROM events""")
def refresh_stamp(spark, sf_dir):
    """The newest load time in a fixed UTC-4 offset, as text."""
    local = F.from_utc_timestamp(F.max("ts"), "-04:00")
    return I.table(spark, sf_dir, "events").agg(F.concat(
        F.lit("Last updated: "), F.date_format(local, "MMM d, yyyy h:mm a")).alias(
        "last_refreshed"))


@query("selected_date", """
    SELECT CAST(max(o_orderdate) AS DATE) AS chosen, DATE '2021-03-07' AS kept FROM orders""")
def selected_date(spark, sf_dir):
    """A selection before 2020 falls back to the newest date; a later one is kept."""
    days = I.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"))
    return days.agg(F.max("day")).select(
        calendar.selected_or_latest(days, "day", "2011-01-01").alias("chosen"),
        calendar.selected_or_latest(days, "day", "2021-03-07").alias("kept"))


@query("rounding", """
    SELECT c_custkey, CAST(CASE WHEN c_acctbal >= 0 THEN ceil(c_acctbal) ELSE floor(c_acctbal) END
                           AS BIGINT) AS up,
           CAST(CASE WHEN c_acctbal >= 0 THEN floor(c_acctbal) ELSE ceil(c_acctbal) END AS BIGINT)
             AS down,
           CAST(round(c_acctbal) AS BIGINT) AS nearest
    FROM customer""")
def rounding(spark, sf_dir):
    return I.table(spark, sf_dir, "customer").select(
        "c_custkey", C.round_up("c_acctbal").alias("up"), C.round_down("c_acctbal").alias("down"),
        F.round("c_acctbal").cast("bigint").alias("nearest"))
