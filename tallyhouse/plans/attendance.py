"""Queries over the weekly headcount: totals, comparisons, averages, series, grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import as_date, easter
from ..operators import calendar, headcount, holidays, metrics
from . import inputs as I
from .registry import query

ON = f"DATE '{I.AS_OF}'"
DAILY = "daily AS (SELECT campus, sunday_date, sum(cnt)::BIGINT AS total FROM hc GROUP BY 1, 2)"
WEEK = "((dayofyear({0}) + dayofweek(CAST(date_trunc('year', {0}) AS DATE)) - 1) // 7 + 1)"
HOME = "campus IN ('A', 'B', 'C')"


def _hc(spark, sf_dir, since=None, until=None):
    return I.headcount(spark, sf_dir, since, until)


def _kept(spark, sf_dir, since=None, until=None):
    return I.kept_headcount(spark, sf_dir, since, until)


@query("feed_union_regroup", """
    WITH rows AS (
      SELECT CAST(date_trunc('week', l_shipdate) AS DATE) + 6 AS sunday_date,
             CASE l_suppkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C'
                  ELSE 'Online' END AS campus,
             l_returnflag, l_linenumber, CAST(l_quantity AS BIGINT) AS v FROM lineitem)
    SELECT sunday_date, campus,
           CASE WHEN l_returnflag = 'R' THEN NULL WHEN l_linenumber % 3 = 0 THEN '9:30am'
                WHEN l_linenumber % 3 = 1 THEN '11:45am' ELSE '5:00pm' END AS schedule,
           CASE l_returnflag WHEN 'A' THEN 'Adults' WHEN 'N' THEN 'Door Holder' ELSE 'MS' END
             AS literal, sum(v)::BIGINT AS cnt
    FROM rows GROUP BY 1, 2, 3, 4""")
def feed_union_regroup(spark, sf_dir):
    """Three feeds, one of them without a schedule, united by name and regrouped."""
    rows = I.headcount_rows(spark, sf_dir)

    def feed(flag, literal, *drop):
        return headcount.feed(rows.where(F.col("literal") == flag).drop("literal", *drop), literal)

    return headcount.regroup(headcount.union_feeds([
        feed("A", "Adults"), feed("N", "Door Holder"), feed("R", "MS", "schedule")])).select(
        "sunday_date", "campus", "schedule", "literal", "cnt")


_EVENT = "CASE WHEN l_linenumber = 7 THEN 'Easter' ELSE 'Sunday Gathering' END"
_CITY = "CASE WHEN campus = 'C' THEN 'South' ELSE 'North' END"
_FEEDS_SQL = f"""
    rows AS (SELECT *, {_CITY} AS city FROM (
      SELECT CAST(date_trunc('week', l_shipdate) AS DATE) + 6 AS sunday_date,
             CASE l_suppkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C'
                  ELSE 'Online' END AS campus,
             CASE l_linenumber % 3 WHEN 0 THEN '9:30am' WHEN 1 THEN '11:45am'
                  ELSE '5:00pm' END AS schedule,
             CASE l_returnflag WHEN 'A' THEN 'Adults' WHEN 'N' THEN 'Door Holder'
                  ELSE 'MS' END AS literal,
             {_EVENT} AS event, CAST(l_quantity AS BIGINT) AS v FROM lineitem)),
    grouped AS (SELECT sunday_date, campus, schedule, literal, city, event,
                       sum(v)::BIGINT AS cnt FROM rows GROUP BY ALL)"""


def _grouped(spark, sf_dir):
    """Three feeds with a city and an event, united and regrouped."""
    rows = (I.headcount_rows(spark, sf_dir).withColumn("event", F.expr(_EVENT))
            .withColumn("city", F.expr(_CITY)))
    feeds = [headcount.feed(rows.where(F.col("literal") == flag).drop("literal"), name)
             for flag, name in (("A", "Adults"), ("N", "Door Holder"), ("R", "MS"))]
    return headcount.regroup(headcount.union_feeds(feeds))


@query("regular_sundays", f"""
    WITH {_FEEDS_SQL},
    i AS (SELECT *, dense_rank() OVER (ORDER BY sunday_date DESC) AS date_index FROM grouped
          WHERE campus <> 'Online')
    SELECT sunday_date, campus, schedule, literal, cnt, date_index,
           CASE schedule WHEN '9:30am' THEN 1 WHEN '11:45am' THEN 3 ELSE 5 END AS schedule_order,
           CASE literal WHEN 'Adults' THEN 1 WHEN 'Door Holder' THEN 2 ELSE 4 END
             AS literal_order,
           {WEEK.format('sunday_date')} AS week_of_year
    FROM i WHERE event = 'Sunday Gathering' AND city = 'North'
      AND sunday_date <> DATE '1995-12-24'""", wide=("date_index", "week_of_year"))
def regular_sundays(spark, sf_dir):
    out = headcount.regular_sundays(_grouped(spark, sf_dir).persist(), "North", I.CAMPUSES,
                                    ["1995-12-24"])
    return out.select("sunday_date", "campus", "schedule", "literal", "cnt", "date_index",
                      "schedule_order", "literal_order", "week_of_year")


@query("online_sundays", f"""
    WITH {_FEEDS_SQL},
    p AS (SELECT *, row_number() OVER w - 1 AS row_index, lag(cnt, 7) OVER w AS prev_week
          FROM grouped
          WINDOW w AS (ORDER BY literal, sunday_date, campus, schedule, city, event))
    SELECT sunday_date, schedule, literal, event, cnt, row_index, prev_week,
           round((cnt - prev_week) / nullif(prev_week, 0)::DOUBLE, 6) AS wow,
           {WEEK.format('sunday_date')} AS week_of_year
    FROM p WHERE campus = 'Online' AND city = 'North' AND sunday_date <> DATE '1995-12-24'""",
       wide=("row_index", "week_of_year"))
def online_sundays(spark, sf_dir):
    out = headcount.online_sundays(_grouped(spark, sf_dir), "North", I.ONLINE, ["1995-12-24"])
    return out.select("sunday_date", "schedule", "literal", "event", "cnt", "row_index",
                      "prev_week", "wow", "week_of_year")


@query("monthly_gatherings", f"""
    WITH {_FEEDS_SQL}
    SELECT sunday_date, campus, schedule, literal, event, cnt,
           CASE schedule WHEN '9:30am' THEN 5 WHEN '11:45am' THEN 10 ELSE 19 END
             AS schedule_sort
    FROM grouped WHERE campus <> 'Online' AND city = 'North'""")
def monthly_gatherings(spark, sf_dir):
    out = headcount.monthly_gatherings(_grouped(spark, sf_dir), "North", I.CAMPUSES)
    return out.select("sunday_date", "campus", "schedule", "literal", "event", "cnt",
                      "schedule_sort")


@query("in_person_rows", f"""
    WITH {I.HC_SQL}
    SELECT * FROM hc WHERE campus <> 'Online' AND sunday_date <> DATE '1995-12-24'""")
def in_person_rows(spark, sf_dir):
    return headcount.in_person(_hc(spark, sf_dir), I.ONLINE, skip_dates=["1995-12-24"])


@query("dense_date_index", f"""
    WITH {I.HC_SQL}
    SELECT *, dense_rank() OVER (ORDER BY sunday_date DESC) AS date_index FROM hc""",
       wide=("date_index",))
def dense_date_index(spark, sf_dir):
    return headcount.date_index(_kept(spark, sf_dir))


@query("positional_lag7", f"""
    WITH {I.HC_SQL},
    p AS (SELECT *, row_number() OVER w - 1 AS row_index, lag(cnt, 7) OVER w AS prev_week
          FROM hc WINDOW w AS (ORDER BY literal, sunday_date, campus, schedule))
    SELECT *, round((cnt - prev_week) / nullif(prev_week, 0)::DOUBLE, 6) AS wow FROM p""",
       wide=("row_index",))
def positional_lag7(spark, sf_dir):
    return headcount.positional_previous(
        _hc(spark, sf_dir), ["literal", "sunday_date", "campus", "schedule"])


@query("adhoc_two_dates", f"""
    WITH {I.HC_SQL}
    SELECT literal, sunday_date, campus, sum(cnt)::BIGINT AS count_new FROM hc
    WHERE sunday_date IN ({ON}, DATE '2000-05-21') AND {HOME}
    GROUP BY ALL ORDER BY literal, sunday_date, campus""")
def adhoc_two_dates(spark, sf_dir):
    hc = _hc(spark, sf_dir, "2000-05-21", I.AS_OF)
    dates = [as_date(d) for d in (I.AS_OF, "2000-05-21")]
    return (hc.where(F.col("sunday_date").isin(*dates) & F.col("campus").isin(list(I.CAMPUSES)))
            .groupBy("literal", "sunday_date", "campus").agg(F.sum("cnt").alias("count_new"))
            .orderBy("literal", "sunday_date", "campus"))


# --- totals ----------------------------------------------------------------------------

@query("totals_by_campus", f"""
    WITH {I.HC_SQL} SELECT campus, sum(cnt)::BIGINT AS total FROM hc GROUP BY campus""")
def totals_by_campus(spark, sf_dir):
    return metrics.totals(_hc(spark, sf_dir), ["campus"])


@query("count_on_date", f"""
    WITH {I.HC_SQL}
    SELECT campus, literal, coalesce(sum(cnt) FILTER (sunday_date = {ON}), 0)::BIGINT AS count_on
    FROM hc GROUP BY campus, literal""")
def count_on_date(spark, sf_dir):
    return metrics.count_on(_hc(spark, sf_dir), I.AS_OF, ["campus", "literal"])


@query("latest_totals", f"""
    WITH {I.HC_SQL}
    SELECT sunday_date AS latest_date, sum(cnt)::BIGINT AS total,
           (sum(cnt) FILTER (campus = 'Online'))::BIGINT AS online
    FROM hc WHERE sunday_date = (SELECT max(sunday_date) FROM hc) GROUP BY sunday_date""")
def latest_totals(spark, sf_dir):
    return metrics.latest_totals(_hc(spark, sf_dir))


@query("campus_series", f"""
    WITH {I.HC_SQL}
    SELECT sunday_date, campus, sum(cnt)::BIGINT AS total FROM hc WHERE campus <> 'C'
    GROUP BY sunday_date, campus""")
def campus_series(spark, sf_dir):
    return metrics.series(_hc(spark, sf_dir), exclude=["C"])


# --- previous periods --------------------------------------------------------------------

def _wow_sql(keys: str) -> str:
    using = f"USING ({keys})" if keys else "ON true"
    by = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return f"""
    WITH {I.HC_SQL}, d AS (SELECT {by}sunday_date, sum(cnt)::BIGINT AS total FROM hc GROUP BY ALL),
    cur AS (SELECT {by}coalesce(sum(total) FILTER (sunday_date = {ON}), 0)::BIGINT AS current
            FROM d {group}),
    prev AS (SELECT {by}max(sunday_date) AS previous_date FROM d
             WHERE sunday_date < {ON} AND total <> 0 AND isodow(sunday_date) = 7 {group}),
    both_ AS (SELECT cur.*, previous_date FROM cur LEFT JOIN prev {using})
    SELECT b.*, d.total AS previous,
           coalesce(round((current - d.total) / nullif(d.total, 0)::DOUBLE, 6), 0) AS wow,
           CASE WHEN coalesce(round((current - d.total) / nullif(d.total, 0)::DOUBLE, 6), 0) >= 0
                THEN '▲' ELSE '▼' END AS arrow
    FROM both_ b LEFT JOIN d ON d.sunday_date = previous_date
    {' '.join(f'AND d.{k.strip()} = b.{k.strip()}' for k in keys.split(',') if k)}"""


@query("wow", _wow_sql("campus"))
def wow(spark, sf_dir):
    return metrics.week_over_week(_hc(spark, sf_dir, until=I.AS_OF), I.AS_OF, ["campus"])


@query("wow_overall", _wow_sql(""))
def wow_overall(spark, sf_dir):
    return metrics.week_over_week(_hc(spark, sf_dir, until=I.AS_OF), I.AS_OF)


@query("wow_by_literal", _wow_sql("campus, literal"))
def wow_by_literal(spark, sf_dir):
    return metrics.week_over_week(_hc(spark, sf_dir, until=I.AS_OF), I.AS_OF,
                                  ["campus", "literal"])


@query("date_labels", f"""
    WITH {I.HC_SQL}, d AS (SELECT sunday_date, sum(cnt) AS total FROM hc GROUP BY 1),
    x AS (SELECT max(sunday_date) FILTER (sunday_date < {ON} AND total <> 0
                                          AND isodow(sunday_date) = 7) AS p,
                 max(sunday_date) FILTER (sunday_date < {ON} AND total <> 0) AS g,
                 max(sunday_date) AS m FROM d)
    SELECT {ON} AS selected, {ON} - 35 AS five_weeks_before, p AS previous_sunday,
           strftime(p, '%m/%d/%Y') AS previous_sunday_label,
           strftime(g, '%Y-%m') AS previous_month_label,
           month(m) || '/' || day(m) || '/' || year(m) AS latest_label FROM x""")
def date_labels(spark, sf_dir):
    return metrics.date_labels(_hc(spark, sf_dir), I.AS_OF)


@query("prev_gathered", f"""
    WITH {I.HC_SQL}, {DAILY}
    SELECT campus, sunday_date, total,
           lag(sunday_date) OVER w AS previous_date, lag(total) OVER w AS previous
    FROM daily WHERE total <> 0 AND isodow(sunday_date) = 7
    WINDOW w AS (PARTITION BY campus ORDER BY sunday_date)""")
def prev_gathered(spark, sf_dir):
    return metrics.previous_gathered(_hc(spark, sf_dir), ["campus"])


@query("card_previous", f"""
    WITH {I.HC_SQL}
    SELECT campus, coalesce(nullif(sum(cnt) FILTER (sunday_date = {ON} - 7), 0),
                            sum(cnt) FILTER (sunday_date = {ON} - 21))::BIGINT AS previous_card
    FROM hc GROUP BY campus""")
def card_previous(spark, sf_dir):
    return metrics.card_previous(_hc(spark, sf_dir, "2000-01-01", I.AS_OF), I.AS_OF, ["campus"])


@query("yoy_snapped", f"""
    WITH {I.HC_SQL},
    prior AS (SELECT make_date(1999, 6, 1) + 3 AS p),
    snap AS (SELECT CAST(p + CASE isodow(p) WHEN 1 THEN 0 WHEN 2 THEN -1 WHEN 3 THEN -2
                                  WHEN 4 THEN -3 WHEN 5 THEN 2 WHEN 6 THEN 1 ELSE 0 END AS DATE)
                    AS d FROM prior),
    x AS (SELECT campus, coalesce(sum(cnt) FILTER (sunday_date = {ON}), 0)::BIGINT AS current,
                 (sum(cnt) FILTER (sunday_date = d))::BIGINT AS prior_year,
                 any_value(d) AS prior_date
          FROM hc, snap GROUP BY campus)
    SELECT *, coalesce(round((current - coalesce(prior_year, 0)) / nullif(prior_year, 0)::DOUBLE,
                             6), 0) AS yoy,
           CASE WHEN coalesce((current - coalesce(prior_year, 0)) / nullif(prior_year, 0)::DOUBLE,
                              0) >= 0 THEN '▲' ELSE '▼' END AS arrow FROM x""")
def yoy_snapped(spark, sf_dir):
    return metrics.year_over_year(_hc(spark, sf_dir, "1999-05-01", I.AS_OF), I.AS_OF, ["campus"])


@query("yoy_364", f"""
    WITH {I.HC_SQL}, {DAILY}
    SELECT d.campus, d.sunday_date, d.total, p.total AS prior_year,
           round((d.total - p.total) / nullif(p.total, 0)::DOUBLE, 6) AS yoy
    FROM daily d LEFT JOIN daily p ON p.campus = d.campus
                                  AND p.sunday_date = d.sunday_date - 364""")
def yoy_364(spark, sf_dir):
    return metrics.year_over_year_364(_hc(spark, sf_dir), ["campus"])


# --- averages ------------------------------------------------------------------------------


@query("five_week_avg", f"""
    WITH {I.HC_SQL},
    w AS (SELECT {WEEK.format('sunday_date')} AS wk, sum(cnt) AS s, count(cnt) AS n FROM hc
          GROUP BY 1),
    p AS (SELECT avg(s) AS s, avg(n) AS n FROM w
          WHERE wk > {WEEK.format(ON)} - 5 AND wk <= {WEEK.format(ON)})
    SELECT round(s, 6) AS average_sum, round(n, 6) AS average_rows,
           round(s / nullif(n, 0), 6) AS five_week_average FROM p""")
def five_week_avg(spark, sf_dir):
    return metrics.five_week_average(_hc(spark, sf_dir), I.AS_OF)


@query("five_week_avg_dates", f"""
    WITH {I.HC_SQL}, {DAILY},
    x AS (SELECT campus, count(*) FILTER (sunday_date BETWEEN {ON} - 34 AND {ON}) AS dates,
                 coalesce(sum(total) FILTER (sunday_date BETWEEN {ON} - 34 AND {ON}), 0) AS s35,
                 coalesce(sum(total) FILTER (sunday_date BETWEEN {ON} - 48 AND {ON}), 0) AS s49
          FROM daily GROUP BY campus)
    SELECT campus, dates, round(CASE WHEN dates = 5 THEN s35 ELSE s49 END / 5, 6)
             AS five_week_average FROM x""")
def five_week_avg_dates(spark, sf_dir):
    return metrics.five_week_average_dates(_hc(spark, sf_dir), I.AS_OF, ["campus"])


@query("trailing_35_365", f"""
    WITH {I.HC_SQL}, {DAILY}
    SELECT campus, sunday_date, total,
           (sum(total) OVER (PARTITION BY campus ORDER BY sunday_date
              RANGE BETWEEN INTERVAL 34 DAY PRECEDING AND CURRENT ROW))::BIGINT AS trailing_35,
           (sum(total) OVER (PARTITION BY campus ORDER BY sunday_date
              RANGE BETWEEN INTERVAL 364 DAY PRECEDING AND CURRENT ROW))::BIGINT AS trailing_365
    FROM daily""")
def trailing_35_365(spark, sf_dir):
    return metrics.trailing_sums(_hc(spark, sf_dir), ["campus"])


EASTERS = {1995: "04-16", 1996: "04-07", 1997: "03-30", 1998: "04-12", 1999: "04-04",
           2000: "04-23", 2001: "04-15"}  # Fixed values, for the checks only.
EASTER_SQL = ("(VALUES " + ", ".join(f"({y}, DATE '{y}-{d}')" for y, d in EASTERS.items())
              + ") e(year, easter)")
HOLIDAY_SQL = f"""hol AS (
      SELECT year, 'Easter' AS event, easter AS holiday_date, easter AS sunday_date
      FROM {EASTER_SQL}
      UNION ALL SELECT year, 'Christmas', make_date(year, 12, 24),
                       CAST(date_trunc('week', make_date(year, 12, 24)) AS DATE) + 6
      FROM {EASTER_SQL})"""


def _holidays(spark, first=1990, last=2040):
    return calendar.holiday_sundays(calendar.year_range(spark, first, last))


_PAST_YEAR_SQL = f"""
    WITH {I.HC_SQL}, {HOLIDAY_SQL},
    kept AS (SELECT campus, sunday_date, sum(cnt) AS total FROM hc
             WHERE sunday_date BETWEEN DATE '1999-06-04' AND {ON} AND cnt <> 0
               AND sunday_date NOT IN (SELECT sunday_date FROM hol) GROUP BY ALL),
    avgs AS (SELECT campus, sum(total)::BIGINT AS year_total, count(*) AS dates,
                    round(sum(total) / count(*)::DOUBLE, 6) AS past_year_average
             FROM kept GROUP BY campus)"""


@query("past_year_avg_excl", f"{_PAST_YEAR_SQL} SELECT * FROM avgs")
def past_year_avg_excl(spark, sf_dir):
    return metrics.past_year_average(_hc(spark, sf_dir, "1999-06-01", I.AS_OF), I.AS_OF,
                                     _holidays(spark, 1999, 2000), ["campus"])


@query("share_of_past_year", f"""{_PAST_YEAR_SQL},
    cur AS (SELECT campus, coalesce(sum(cnt) FILTER (sunday_date = {ON}), 0)::BIGINT AS current
            FROM hc GROUP BY campus)
    SELECT cur.*, year_total, dates, past_year_average,
           coalesce(round(current / past_year_average, 6), 0) AS share,
           CAST(round(coalesce(round(current / past_year_average, 6), 0) * 100) AS BIGINT)
             || '% of Avg' AS share_text,
           coalesce(CAST(CAST(round(past_year_average) AS BIGINT) AS VARCHAR), '-')
             AS average_text
    FROM cur LEFT JOIN avgs USING (campus)""")
def share_of_past_year(spark, sf_dir):
    return metrics.share_of_past_year(_kept(spark, sf_dir, "1999-06-01", I.AS_OF), I.AS_OF,
                                      _holidays(spark, 1999, 2000), ["campus"])


def _monthly(spark, sf_dir, since=None, until=None):
    """The monthly-gathering feed: the 5 pm service."""
    return _kept(spark, sf_dir, since, until).where("schedule = '5:00pm'")


_MONTHLY = f"{I.HC_SQL}, m AS (SELECT * FROM hc WHERE schedule = '5:00pm')"


@query("ytd_per_gathering", f"""
    WITH {_MONTHLY},
    n AS (SELECT count(DISTINCT sunday_date) FILTER (year(sunday_date) = 2000
                   AND sunday_date <= {ON}) AS cur,
                 count(DISTINCT sunday_date) FILTER (year(sunday_date) = 1999
                   AND sunday_date <= DATE '1999-06-04') AS last FROM m),
    s AS (SELECT campus,
                 round(coalesce(avg(cnt) FILTER (year(sunday_date) = 2000), 0), 6) AS year_mean,
                 round(coalesce(avg(cnt) FILTER (year(sunday_date) = 1999), 0), 6)
                   AS last_year_mean,
                 round(coalesce(avg(cnt) FILTER (year(sunday_date) = 2000
                   AND month(sunday_date) <= 6), 0), 6) AS year_to_month_mean,
                 (sum(cnt) FILTER (year(sunday_date) = 2000 AND sunday_date <= {ON}))::BIGINT
                   AS year_total,
                 (sum(cnt) FILTER (year(sunday_date) = 1999
                    AND sunday_date <= DATE '1999-06-04'))::BIGINT AS last_year_to_date_total,
                 (sum(cnt) FILTER (year(sunday_date) = 1999))::BIGINT AS last_year_total
          FROM m GROUP BY campus),
    r AS (SELECT s.*, round(year_total / cur::DOUBLE, 6) AS per_gathering,
                 round(last_year_to_date_total / last::DOUBLE, 6) AS last_year_per_gathering
          FROM s, n)
    SELECT *, coalesce(round((per_gathering - last_year_per_gathering)
                             / nullif(last_year_per_gathering, 0), 6), 0) AS yoy FROM r""")
def ytd_per_gathering(spark, sf_dir):
    hc = _monthly(spark, sf_dir, "1999-01-01", "2000-12-31")
    return metrics.gathering_averages(hc, I.AS_OF, ["campus"])


# --- series --------------------------------------------------------------------------------

WIDE = (f"(sum(cnt) FILTER ({HOME}))::BIGINT AS all_campuses, "
        + ", ".join(f"(sum(cnt) FILTER (campus = '{c}'))::BIGINT AS campus_{c}"
                    for c in I.CAMPUSES))


@query("series_month", f"""
    WITH {I.HC_SQL}
    SELECT year(sunday_date) % 100 * 100 + month(sunday_date) AS yymm,
           strftime(min(sunday_date), '%b %y') AS label, {WIDE}
    FROM hc WHERE sunday_date BETWEEN DATE '1999-06-01' AND DATE '2000-06-30' GROUP BY 1""",
       wide=("yymm",))
def series_month(spark, sf_dir):
    return metrics.monthly_series(_hc(spark, sf_dir, "1999-06-01", "2000-06-30"), I.AS_OF,
                                  I.CAMPUSES)


_WW = f"year(sunday_date) || lpad(CAST({WEEK.format('sunday_date')} AS VARCHAR), 2, '0')"


@query("series_week", f"""
    WITH {I.HC_SQL}
    SELECT {_WW} AS week, strftime(min(sunday_date), '%b %y') AS label, {WIDE}
    FROM hc
    WHERE {_WW} BETWEEN '1999' || lpad(CAST({WEEK.format(ON)} AS VARCHAR), 2, '0')
                    AND '2000' || lpad(CAST({WEEK.format(ON)} AS VARCHAR), 2, '0')
    GROUP BY 1""")
def series_week(spark, sf_dir):
    return metrics.weekly_series(_hc(spark, sf_dir, "1999-01-01", "2000-12-31"), I.AS_OF,
                                 I.CAMPUSES)


YEARS = ", ".join(f"(sum(cnt) FILTER (year(sunday_date) = {y}))::BIGINT AS y{y}"
                  for y in range(1996, 2001))


@query("series_multi_year", f"""
    WITH {I.HC_SQL}
    SELECT {WEEK.format('sunday_date')} AS week, {YEARS} FROM hc WHERE campus = 'A' GROUP BY 1""",
       wide=("week",))
def series_multi_year(spark, sf_dir):
    return metrics.multi_year(_hc(spark, sf_dir), 2000, "A")


@query("series_multi_year_month", f"""
    WITH {I.HC_SQL}
    SELECT m AS month, {YEARS}
    FROM unnest(range(1, 13)) t(m) LEFT JOIN hc ON month(sunday_date) = m AND campus = 'A'
    GROUP BY 1""",
       wide=("month",))
def series_multi_year_month(spark, sf_dir):
    return metrics.multi_year(_hc(spark, sf_dir), 2000, "A", "month")


@query("top5_gathered", f"""
    WITH {I.HC_SQL},
    g AS (SELECT sunday_date FROM hc WHERE {HOME} AND isodow(sunday_date) = 7
            AND sunday_date <= {ON}
          GROUP BY 1 HAVING sum(cnt) > 0 ORDER BY 1 DESC LIMIT 5)
    SELECT sunday_date, {WIDE} FROM hc WHERE {HOME} AND sunday_date IN (SELECT * FROM g)
    GROUP BY 1""")
def top5_gathered(spark, sf_dir):
    return metrics.last_gathered_by_campus(_kept(spark, sf_dir, until=I.AS_OF), I.AS_OF,
                                           I.CAMPUSES)


@query("literal_prev_current", f"""
    WITH {I.HC_SQL},
    prev AS (SELECT max(sunday_date) AS d FROM (
               SELECT sunday_date FROM hc WHERE {HOME} AND isodow(sunday_date) = 7
                 AND sunday_date < {ON} GROUP BY 1 HAVING sum(cnt) > 0)),
    axis AS (SELECT scope, literal FROM (SELECT DISTINCT literal FROM hc),
                    unnest(['All', 'A', 'B', 'C']) s(scope))
    SELECT scope, axis.literal,
           CASE axis.literal WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 99 END AS sort,
           coalesce(sum(cnt) FILTER (sunday_date = d), 0)::BIGINT AS previous,
           coalesce(sum(cnt) FILTER (sunday_date = {ON}), 0)::BIGINT AS current
    FROM axis CROSS JOIN prev LEFT JOIN hc
      ON hc.literal = axis.literal AND {HOME} AND (scope = 'All' OR campus = scope)
    GROUP BY 1, 2, 3""")
def literal_prev_current(spark, sf_dir):
    return metrics.by_literal(_kept(spark, sf_dir, until=I.AS_OF), I.AS_OF, I.CAMPUSES, ["A", "N"])


_SLOTTED = f"s AS (SELECT *, {I.SLOT_SQL} AS slot FROM hc WHERE {HOME})"
_SLOT_AXIS = "unnest(['All', '9:30am Gathering', '11:45am Gathering']) k(slot)"


@query("last_gathered_grid", f"""
    WITH {I.HC_SQL}, {_SLOTTED},
    g AS (SELECT sunday_date, lag(sunday_date) OVER (ORDER BY sunday_date) AS prior_date FROM (
            SELECT sunday_date FROM s WHERE isodow(sunday_date) = 7
            GROUP BY 1 HAVING sum(cnt) > 0)),
    picked AS (SELECT *, sunday_date - 364 AS last_year_date FROM g WHERE sunday_date <= {ON}
               ORDER BY sunday_date DESC LIMIT 5),
    axis AS (SELECT * FROM picked, unnest(['A', 'B', 'C']) c(campus), {_SLOT_AXIS})
    SELECT a.sunday_date, prior_date, last_year_date, a.campus, a.slot,
           (sum(cnt) FILTER (s.sunday_date = a.sunday_date))::BIGINT AS current,
           (sum(cnt) FILTER (s.sunday_date = prior_date))::BIGINT AS prior,
           (sum(cnt) FILTER (s.sunday_date = last_year_date))::BIGINT AS last_year
    FROM axis a LEFT JOIN s ON s.campus = a.campus AND (a.slot = 'All' OR s.slot = a.slot)
    GROUP BY ALL""")
def last_gathered_grid(spark, sf_dir):
    hc = I.with_slot(_kept(spark, sf_dir, until=I.AS_OF))
    return metrics.last_gathered_grid(hc, I.AS_OF, I.CAMPUSES, I.SLOTS)


@query("lag_7_364_grid", f"""
    WITH {I.HC_SQL}, {_SLOTTED},
    dates AS (SELECT DISTINCT sunday_date FROM hc
              WHERE sunday_date > {ON} - 364 AND sunday_date <= {ON}),
    axis AS (SELECT * FROM dates, unnest(['All', 'A', 'B', 'C']) c(campus), {_SLOT_AXIS})
    SELECT a.sunday_date, a.campus, a.slot,
           (sum(cnt) FILTER (s.sunday_date = a.sunday_date))::BIGINT AS total,
           (sum(cnt) FILTER (s.sunday_date = a.sunday_date - 7))::BIGINT AS previous_week,
           (sum(cnt) FILTER (s.sunday_date = a.sunday_date - 364))::BIGINT AS previous_year
    FROM axis a LEFT JOIN s ON (a.campus = 'All' OR s.campus = a.campus)
                           AND (a.slot = 'All' OR s.slot = a.slot)
    GROUP BY ALL""")
def lag_7_364_grid(spark, sf_dir):
    hc = I.with_slot(_kept(spark, sf_dir, "1998-06-01", I.AS_OF))
    return metrics.lagged_grid(hc, I.AS_OF, I.CAMPUSES, I.SLOTS)


@query("regular_grid", f"""
    WITH {I.HC_SQL},
    h AS (SELECT * FROM hc WHERE schedule IN ('9:30am', '11:45am')),
    b AS (SELECT max(sunday_date) FILTER (sunday_date = {ON}) AS c,
                 max(sunday_date) FILTER (sunday_date < {ON}) AS p,
                 max(sunday_date) FILTER (sunday_date <= {ON} - 364) AS y FROM h),
    l5 AS (SELECT DISTINCT sunday_date FROM h WHERE sunday_date <= {ON}
           ORDER BY 1 DESC LIMIT 5),
    axis AS (SELECT * FROM unnest(['A', 'N', 'X']) l(literal), unnest(['A', 'B', 'C']) c(campus),
                    unnest(['9:30am', '11:45am']) s(schedule)),
    cells AS (SELECT literal, campus, schedule, sunday_date, sum(cnt) AS v FROM h GROUP BY ALL)
    SELECT a.literal, a.campus, a.schedule,
           (sum(v) FILTER (sunday_date = c))::BIGINT AS current,
           (sum(v) FILTER (sunday_date = p))::BIGINT AS previous,
           (sum(v) FILTER (sunday_date = y))::BIGINT AS prior_year,
           round(avg(v) FILTER (sunday_date IN (SELECT * FROM l5)), 6) AS five_date_average
    FROM axis a CROSS JOIN b LEFT JOIN cells USING (literal, campus, schedule)
    WHERE c IS NOT NULL GROUP BY ALL""")
def regular_grid(spark, sf_dir):
    return metrics.regular_grid(_kept(spark, sf_dir, until=I.AS_OF), I.AS_OF, ("A", "N", "X"),
                                I.CAMPUSES, ("9:30am", "11:45am"))


# --- monthly gatherings ------------------------------------------------------------------

@query("gathering_rolling_year", f"""
    WITH {_MONTHLY}
    SELECT sunday_date, sum(cnt)::BIGINT AS total, strftime(sunday_date, '%b %y') AS label
    FROM m WHERE campus = 'A' AND sunday_date BETWEEN DATE '1999-06-04' AND {ON}
    GROUP BY sunday_date HAVING sum(cnt) > 0""")
def gathering_rolling_year(spark, sf_dir):
    return metrics.rolling_year(_monthly(spark, sf_dir, "1999-06-01", I.AS_OF), I.AS_OF, "A")


@query("year_totals", f"""
    WITH {_MONTHLY},
    d AS (SELECT sunday_date, sum(cnt) AS total FROM m
          WHERE campus = 'A' AND year(sunday_date) BETWEEN 1994 AND 2000
          GROUP BY 1 HAVING max(cnt) > 100)
    SELECT year(sunday_date) AS year, sum(total)::BIGINT AS total FROM d GROUP BY 1""",
       wide=("year",))
def year_totals(spark, sf_dir):
    return metrics.yearly_totals(_monthly(spark, sf_dir), I.AS_OF, "A")


@query("gathering_over_gathering", f"""
    WITH {_MONTHLY},
    p AS (SELECT max(sunday_date) AS previous_date FROM m WHERE sunday_date < {ON}),
    s AS (SELECT campus, literal,
                 coalesce(sum(cnt) FILTER (sunday_date = {ON}), 0)::BIGINT AS current,
                 coalesce(sum(cnt) FILTER (sunday_date = previous_date), 0)::BIGINT AS previous,
                 any_value(previous_date) AS previous_date
          FROM m, p GROUP BY campus, literal),
    r AS (SELECT *, coalesce(round((current - previous) / nullif(previous, 0)::DOUBLE, 6), 0)
                      AS change FROM s)
    SELECT *, CASE WHEN change >= 0 THEN '▲' ELSE '▼' END AS arrow FROM r""")
def gathering_over_gathering(spark, sf_dir):
    return metrics.gathering_over_gathering(_monthly(spark, sf_dir, until=I.AS_OF), I.AS_OF,
                                            ["campus", "literal"])


@query("gathering_month_table", f"""
    WITH {_MONTHLY},
    p AS (SELECT (SELECT max(sunday_date) FROM (SELECT sunday_date FROM m
                  WHERE sunday_date < {ON} GROUP BY 1 HAVING sum(cnt) > 0)) AS prev,
                 (SELECT max(sunday_date) FROM m WHERE year(sunday_date) = 1999) AS prior),
    c AS (SELECT literal, coalesce(sum(cnt) FILTER (sunday_date = {ON}), 0)::BIGINT AS current,
                 coalesce(sum(cnt) FILTER (sunday_date = prev), 0)::BIGINT AS previous,
                 coalesce(sum(cnt) FILTER (sunday_date = prior), 0)::BIGINT AS prior_year
          FROM m, p WHERE campus = 'A' GROUP BY literal),
    t AS (SELECT max(greatest(current, previous)) AS top FROM c)
    SELECT c.*,
           coalesce(round((current - previous) / nullif(previous, 0)::DOUBLE, 6), 0)
             AS month_over_month,
           coalesce(round((current - prior_year) / nullif(prior_year, 0)::DOUBLE, 6), 0)
             AS year_over_year,
           coalesce(round(current / nullif(top, 0)::DOUBLE, 6), 0) AS current_share,
           coalesce(round(previous / nullif(top, 0)::DOUBLE, 6), 0) AS previous_share
    FROM c, t""")
def gathering_month_table(spark, sf_dir):
    return metrics.gathering_month_table(_monthly(spark, sf_dir, until=I.AS_OF), I.AS_OF, "A")


# --- holidays ----------------------------------------------------------------------------

def _special(spark, sf_dir):
    """Special-Sunday counts: seven services a day, named by line number. Two services
    share a sort number, so ties occur. Ordinary Sundays leave before the aggregate."""
    rows = calendar.special_sundays(I.headcount_rows(spark, sf_dir), _holidays(spark))
    line = F.col("l_linenumber")
    return (rows.groupBy("year", "event", "campus", "literal", "l_linenumber")
            .agg(F.sum("value").alias("cnt"))
            .select("year", "event", "campus", "literal",
                    F.concat(F.lit("svc"), line.cast("string")).alias("schedule"),
                    F.when(line > 2, line - 1).otherwise(line).alias("schedule_sort"), "cnt")
            .persist())


_SPECIAL_SQL = f"""{HOLIDAY_SQL},
    spl AS (SELECT year, event, campus, literal, 'svc' || l_linenumber AS schedule,
                   CASE WHEN l_linenumber > 2 THEN l_linenumber - 1 ELSE l_linenumber END
                     AS schedule_sort, sum(v)::BIGINT AS cnt
            FROM (SELECT CAST(date_trunc('week', l_shipdate) AS DATE) + 6 AS sunday_date,
                         CASE l_suppkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C'
                              ELSE 'Online' END AS campus, l_returnflag AS literal,
                         l_linenumber, CAST(l_quantity AS BIGINT) AS v FROM lineitem)
                 JOIN hol USING (sunday_date)
            GROUP BY ALL)"""


def _comparison_sql(event: str, year: int) -> str:
    return f"""
    WITH {_SPECIAL_SQL},
    src AS (SELECT * FROM spl WHERE event = '{event}' AND year IN ({year}, {year - 1}) AND {HOME}),
    base AS (SELECT scope, literal, year, schedule, schedule_sort, sum(cnt) AS v
             FROM (SELECT campus AS scope, * FROM src UNION ALL SELECT 'All', * FROM src)
             GROUP BY ALL),
    ranked AS (SELECT b.*, (SELECT count(*) FROM base o
                            WHERE o.scope = b.scope AND o.literal = b.literal AND o.year = b.year
                              AND o.schedule_sort <= b.schedule_sort) AS rank FROM base b),
    axis AS (SELECT t.scope, literal, unnest(range(0, top + 1)) AS rank
             FROM (SELECT scope, max(rank) AS top FROM ranked GROUP BY 1) t
                  JOIN (SELECT DISTINCT scope, literal FROM ranked) l ON l.scope = t.scope),
    x AS (SELECT a.scope, a.literal, a.rank,
                 (sum(v) FILTER (year = {year}))::BIGINT AS current,
                 (sum(v) FILTER (year = {year - 1}))::BIGINT AS previous,
                 CASE WHEN a.rank = 0 THEN '' ELSE coalesce(string_agg(schedule, ' / '
                   ORDER BY schedule_sort, schedule) FILTER (year = {year}), '') END AS service,
                 CASE WHEN a.rank = 0 THEN '' ELSE coalesce(string_agg(schedule, ' / '
                   ORDER BY schedule_sort, schedule) FILTER (year = {year - 1}), '') END
                   AS previous_service
          FROM axis a LEFT JOIN ranked r ON r.scope = a.scope AND r.literal = a.literal
                                        AND (a.rank = 0 OR r.rank = a.rank)
          GROUP BY 1, 2, 3),
    st AS (SELECT *, CASE WHEN coalesce(current, 0) = 0 AND coalesce(previous, 0) = 0 THEN 'empty'
                          WHEN coalesce(previous, 0) = 0 THEN 'new'
                          WHEN coalesce(current, 0) = 0 THEN 'gone' ELSE 'ok' END AS state FROM x),
    ra AS (SELECT *, CASE WHEN state = 'ok'
                          THEN round((current - previous) / previous::DOUBLE, 6) END AS ratio
           FROM st)
    SELECT *, CASE WHEN state = 'ok'
                   THEN least(100, CAST(round(abs(ratio) / 0.5 * 100) AS INTEGER))
                   ELSE 0 END AS bar FROM ra"""


@query("holiday_comparison", _comparison_sql("Easter", 2000),
       wide=("rank",))
def holiday_comparison(spark, sf_dir):
    return holidays.holiday_comparison(_special(spark, sf_dir), "Easter", 2000, I.CAMPUSES)


@query("holiday_comparison_christmas", _comparison_sql("Christmas", 2000),
       wide=("rank",))
def holiday_comparison_christmas(spark, sf_dir):
    return holidays.holiday_comparison(_special(spark, sf_dir), "Christmas", 2000, I.CAMPUSES)


@query("holiday_totals", f"""
    WITH {_SPECIAL_SQL},
    t AS (SELECT event, campus, (sum(cnt) FILTER (year = 2000))::BIGINT AS current,
                 (sum(cnt) FILTER (year = 1999))::BIGINT AS previous FROM spl GROUP BY 1, 2)
    SELECT *, coalesce(round((coalesce(current, 0) - coalesce(previous, 0))
                             / nullif(previous, 0)::DOUBLE, 6), 0) AS yoy FROM t""")
def holiday_totals(spark, sf_dir):
    return holidays.holiday_totals(_special(spark, sf_dir), 2000, ["event", "campus"])


@query("holiday_series", f"""
    WITH {_SPECIAL_SQL}
    SELECT event, year,
           coalesce(sum(cnt) FILTER ({HOME}), 0)::BIGINT AS all_campuses,
           coalesce(sum(cnt) FILTER (campus = 'A'), 0)::BIGINT AS campus_A,
           coalesce(sum(cnt) FILTER (campus = 'B'), 0)::BIGINT AS campus_B,
           coalesce(sum(cnt) FILTER (campus = 'C'), 0)::BIGINT AS campus_C,
           any_value(a) AS first_year, any_value(b) AS last_year
    FROM spl JOIN (SELECT event, min(year) AS a, max(year) AS b FROM spl GROUP BY 1)
      USING (event)
    WHERE year BETWEEN 1996 AND 2000 GROUP BY event, year""")
def holiday_series(spark, sf_dir):
    return holidays.holiday_series(_special(spark, sf_dir), 2000, I.CAMPUSES)


@query("schedule_rank", f"""
    WITH {_SPECIAL_SQL},
    b AS (SELECT event, literal, year, schedule, schedule_sort, sum(cnt)::BIGINT AS v FROM spl
          GROUP BY ALL)
    SELECT event, literal, year, schedule, v,
           (SELECT count(*) FROM b o WHERE o.event = b.event AND o.literal = b.literal
              AND o.year = b.year AND o.schedule_sort <= b.schedule_sort) AS rank FROM b""")
def schedule_rank(spark, sf_dir):
    """Running rank of services within (holiday, ministry, year); ties share the higher rank."""
    from pyspark.sql import Window

    base = (_special(spark, sf_dir).groupBy("event", "literal", "year", "schedule", "schedule_sort")
            .agg(F.sum("cnt").alias("v")))
    upto = Window.partitionBy("event", "literal", "year").orderBy("schedule_sort").rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    return base.select("event", "literal", "year", "schedule", "v",
                       F.count("*").over(upto).alias("rank"))


@query("easter_dates", f"""
    SELECT e.year, easter, make_date(e.year, 12, 24) AS christmas_eve, count(*) AS orders
    FROM orders JOIN {EASTER_SQL} ON e.year = year(o_orderdate) GROUP BY 1, 2, 3""")
def easter_dates(spark, sf_dir):
    from ..functions.dates import christmas_eve

    return (I.table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year"))
            .agg(F.count("*").alias("orders"))
            .select("year", easter("year").alias("easter"),
                    christmas_eve("year").alias("christmas_eve"), "orders"))


@query("holiday_status", f"""
    WITH {_SPECIAL_SQL}, found AS (SELECT DISTINCT year, event FROM spl)
    SELECT h.year, h.event, holiday_date, h.sunday_date,
           CASE WHEN f.year IS NOT NULL THEN 'Show' WHEN {ON} < holiday_date THEN 'Upcoming'
                WHEN {ON} <= holiday_date + 14 THEN 'Processing' ELSE 'Show' END AS status,
           holiday_date - {ON} AS days_to_holiday
    FROM hol h LEFT JOIN found f ON f.year = h.year AND f.event = h.event""",
       wide=("days_to_holiday",))
def holiday_status(spark, sf_dir):
    rows = I.headcount_rows(spark, sf_dir).select("sunday_date")
    years = I.table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("year")).distinct()
    return calendar.holiday_state(calendar.holiday_sundays(years),
                                  calendar.special_sundays(rows, _holidays(spark)), I.AS_OF)
