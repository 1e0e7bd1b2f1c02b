"""Report metrics over the weekly headcount: metric(hc, as_of, by=[...]) -> DataFrame.

Filter context is explicit: `as_of` is the selected Sunday and `by` the group keys.
Each metric first sums the fact to (by, date). Comparisons with other dates are
conditional aggregates or windows over that small frame, never per-cell rescans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import (change_ratio, dash_if_null, percent_text, rank_in,
                                 safe_divide, short_date_text, trend_arrow)
from ..functions.dates import (as_date, is_sunday, month_start,
                               snapped_year_before, trailing, us_week_number, year_before,
                               yymm_number, yyyyww_text)
from .calendar import literal_axis

DATE = "sunday_date"


def daily(hc: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return hc.groupBy(*by, DATE).agg(F.sum("cnt").alias("total"))


def _sum_when(condition: Column, value: str = "total") -> Column:
    return F.sum(F.when(condition, F.col(value)))


def _or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def _day_number(date: str = DATE) -> Column:
    return F.datediff(F.col(date), F.lit("1970-01-01").cast("date"))


# --- totals ------------------------------------------------------------------

def totals(hc: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return hc.groupBy(*by).agg(F.sum("cnt").alias("total"))


def count_on(hc: DataFrame, as_of, by: Sequence[str] = (), name: str = "count_on") -> DataFrame:
    """Count on the selected date; 0 for a group without rows that day."""
    on = as_date(as_of)
    return hc.groupBy(*by).agg(_or_zero(_sum_when(F.col(DATE) == on, "cnt")).alias(name))


def latest_totals(hc: DataFrame, online: str = "Online") -> DataFrame:
    """Totals on the newest date of all: everyone, and online only."""
    per_date = hc.groupBy(DATE).agg(
        F.sum("cnt").alias("total"),
        F.sum(F.when(F.col("campus") == online, F.col("cnt"))).alias("online"))
    return per_date.agg(F.max(DATE).alias("latest_date"),
                        F.max_by("total", DATE).alias("total"),
                        F.max_by("online", DATE).alias("online"))


def series(hc: DataFrame, campuses: Sequence[str] | None = None,
           exclude: Sequence[str] = ()) -> DataFrame:
    """Totals by date and campus over the whole range."""
    rows = hc.where(F.col("campus").isin(list(campuses))) if campuses else hc
    rows = rows.where(~F.col("campus").isin(list(exclude))) if exclude else rows
    return daily(rows, ["campus"])


# --- previous periods ----------------------------------------------------------

def current_and_previous(hc: DataFrame, as_of, by: Sequence[str] = (),
                         sundays_only: bool = True) -> DataFrame:
    """Count on the selected date, and the last earlier date with a non-zero count.
    One aggregate: the previous date and its count travel together."""
    on = as_date(as_of)
    earlier = (F.col(DATE) < on) & (F.col("total") != 0)
    if sundays_only:
        earlier = earlier & is_sunday(DATE)
    before = F.max(F.when(earlier, F.struct(DATE, "total"))).alias("_before")
    return (daily(hc, by).groupBy(*by)
            .agg(_or_zero(_sum_when(F.col(DATE) == on)).alias("current"), before)
            .select(*by, "current", F.col(f"_before.{DATE}").alias("previous_date"),
                    F.col("_before.total").alias("previous")))


def previous_gathered(hc: DataFrame, by: Sequence[str] = (),
                      sundays_only: bool = True) -> DataFrame:
    """For every date that gathered, the gathered date before it."""
    dates = daily(hc, by).where(F.col("total") != 0)
    if sundays_only:
        dates = dates.where(is_sunday(DATE))
    w = Window.partitionBy(*by).orderBy(DATE)
    return dates.withColumns({"previous_date": F.lag(DATE).over(w),
                              "previous": F.lag("total").over(w)})


def date_labels(hc: DataFrame, as_of) -> DataFrame:
    """The dates a report names: the selected one, five weeks before it, the last
    gathered Sunday before it, the last gathering of any weekday with its month, and
    the newest date with data."""
    on, d = as_date(as_of), F.col(DATE)
    earlier = (d < on) & (F.col("total") != 0)
    dates = daily(hc).agg(
        F.max(F.when(earlier & is_sunday(DATE), d)).alias("previous_sunday"),
        F.max(F.when(earlier, d)).alias("previous_gathering"), F.max(d).alias("latest"))
    return dates.select(
        on.alias("selected"), F.date_sub(on, 35).alias("five_weeks_before"), "previous_sunday",
        F.date_format("previous_sunday", "MM/dd/yyyy").alias("previous_sunday_label"),
        F.date_format("previous_gathering", "yyyy-MM").alias("previous_month_label"),
        short_date_text("latest").alias("latest_label"))


def card_previous(hc: DataFrame, as_of, by: Sequence[str] = ()) -> DataFrame:
    """The count seven days ago, or 21 days ago when that is zero or missing."""
    on = as_date(as_of)
    week = _sum_when(F.col(DATE) == F.date_sub(on, 7), "cnt")
    three = _sum_when(F.col(DATE) == F.date_sub(on, 21), "cnt")
    return hc.groupBy(*by).agg(F.coalesce(F.nullif(week, F.lit(0)), three).alias("previous_card"))


def week_over_week(hc: DataFrame, as_of, by: Sequence[str] = (),
                   sundays_only: bool = True) -> DataFrame:
    """Change against the previous gathered date; 0 when there is nothing to compare."""
    ratio = change_ratio("current", "previous", 0)
    return (current_and_previous(hc, as_of, by, sundays_only)
            .withColumn("wow", ratio).withColumn("arrow", trend_arrow("wow")))


def gathering_over_gathering(hc: DataFrame, as_of, by: Sequence[str] = ()) -> DataFrame:
    """Change against the gathering date before the selected one. That date is the
    same for every group, and a group that missed it counts 0 there."""
    on, d = as_date(as_of), F.col(DATE)
    before = hc.where(d < on).agg(F.max(DATE).alias("d")).scalar()
    sums = hc.groupBy(*by).agg(_or_zero(_sum_when(d == on, "cnt")).alias("current"),
                               _or_zero(_sum_when(d == before, "cnt")).alias("previous"))
    return (sums.withColumn("previous_date", before)
            .withColumn("change", change_ratio("current", "previous", 0))
            .withColumn("arrow", trend_arrow("change")))


def year_over_year(hc: DataFrame, as_of, by: Sequence[str] = ()) -> DataFrame:
    """Change against last year's date snapped to its week; 0 when missing."""
    on = as_date(as_of)
    prior = snapped_year_before(on)
    return (hc.groupBy(*by)
            .agg(_or_zero(_sum_when(F.col(DATE) == on, "cnt")).alias("current"),
                 _sum_when(F.col(DATE) == prior, "cnt").alias("prior_year"))
            .select("*", prior.alias("prior_date"))
            .withColumn("yoy", change_ratio("current", "prior_year", 0))
            .withColumn("arrow", trend_arrow("yoy")))


def year_over_year_364(hc: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Every date against the same weekday 52 weeks earlier; null without one. A
    value-range window stands in for the shifted self-join."""
    w = Window.partitionBy(*by).orderBy(_day_number())
    return (daily(hc, by)
            .withColumn("prior_year", F.sum("total").over(w.rangeBetween(-364, -364)))
            .withColumn("yoy", F.round(safe_divide(
                F.col("total") - F.col("prior_year"), "prior_year"), 6)))


# --- averages ------------------------------------------------------------------

def five_week_average(hc: DataFrame, as_of) -> DataFrame:
    """By week number over all years: the mean weekly sum divided by the mean
    weekly row count, for the five week numbers ending at the selected date's."""
    week = us_week_number(as_date(as_of))
    weekly = (hc.withColumn("_week", us_week_number(DATE))
              .where((F.col("_week") > week - 5) & (F.col("_week") <= week))
              .groupBy("_week").agg(F.sum("cnt").alias("s"), F.count("cnt").alias("n")))
    return weekly.agg(F.avg("s").alias("s"), F.avg("n").alias("n")).select(
        F.round("s", 6).alias("average_sum"), F.round("n", 6).alias("average_rows"),
        F.round(safe_divide("s", "n"), 6).alias("five_week_average"))


def five_week_average_dates(hc: DataFrame, as_of, by: Sequence[str] = ()) -> DataFrame:
    """A fifth of the 35-day sum when those days hold exactly five dates, else a
    fifth of the 49-day sum."""
    near, far = trailing(DATE, as_of, 35), trailing(DATE, as_of, 49)
    return (daily(hc, by).groupBy(*by)
            .agg(F.count_if(near).alias("dates"), _or_zero(_sum_when(near)).alias("sum_35"),
                 _or_zero(_sum_when(far)).alias("sum_49"))
            .select(*by, "dates", F.round(
                F.when(F.col("dates") == 5, F.col("sum_35")).otherwise(F.col("sum_49")) / 5, 6)
                .alias("five_week_average")))


def trailing_sums(hc: DataFrame, by: Sequence[str] = (),
                  spans: Sequence[int] = (35, 365)) -> DataFrame:
    """For every date, the sums of the periods of `spans` days that end on it."""
    w = Window.partitionBy(*by).orderBy(_day_number())
    return daily(hc, by).withColumns({
        f"trailing_{n}": F.sum("total").over(w.rangeBetween(-(n - 1), 0)) for n in spans})


def past_year_average(hc: DataFrame, as_of, holidays: DataFrame,
                      by: Sequence[str] = ()) -> DataFrame:
    """Mean count per date over the year to the selected date, holidays left out.
    Zero counts do not count as data. `holidays` has one row per holiday date."""
    on = as_date(as_of)
    rows = hc.where(F.col(DATE).between(year_before(on), on) & (F.col("cnt") != 0))
    kept = daily(rows, by).join(holidays.select(DATE).distinct(), DATE, "left_anti")
    return kept.groupBy(*by).agg(
        F.sum("total").alias("year_total"), F.count("*").alias("dates"),
        F.round(safe_divide(F.sum("total"), F.count("*")), 6).alias("past_year_average"))


def share_of_past_year(hc: DataFrame, as_of, holidays: DataFrame,
                       by: Sequence[str]) -> DataFrame:
    """The selected date's count as a share of the past-year average, with the texts of
    the share and of the average ('-' without one)."""
    current = count_on(hc, as_of, by, "current")
    average = past_year_average(hc, as_of, holidays, by)
    share = F.round(safe_divide("current", "past_year_average", 0), 6)
    return (current.join(average, list(by), "left").withColumn("share", share)
            .withColumn("share_text", F.concat(percent_text("share"), F.lit(" of Avg")))
            .withColumn("average_text", dash_if_null(
                F.round("past_year_average").cast("bigint"))))


def gathering_averages(hc: DataFrame, as_of, by: Sequence[str] = ()) -> DataFrame:
    """Monthly-gathering averages: simple row means of both years, sums per
    gathering date for both years to date, and last year's total. Gathering dates
    are counted over all groups."""
    on = as_date(as_of)
    last = year_before(on)
    this_year, last_year = F.year(DATE) == F.year(on), F.year(DATE) == F.year(on) - 1
    ytd, ly_ytd = this_year & (F.col(DATE) <= on), last_year & (F.col(DATE) <= last)
    dates = hc.select(DATE).distinct()
    held = dates.where(ytd).agg(F.count("*").alias("n")).scalar()
    held_last = dates.where(ly_ytd).agg(F.count("*").alias("n")).scalar()

    def mean(condition: Column) -> Column:
        return F.round(F.coalesce(F.avg(F.when(condition, F.col("cnt"))), F.lit(0.0)), 6)

    sums = hc.groupBy(*by).agg(
        mean(this_year).alias("year_mean"), mean(last_year).alias("last_year_mean"),
        mean(this_year & (F.month(DATE) <= F.month(on))).alias("year_to_month_mean"),
        _sum_when(ytd, "cnt").alias("year_total"),
        _sum_when(ly_ytd, "cnt").alias("last_year_to_date_total"),
        _sum_when(last_year, "cnt").alias("last_year_total"))
    return (sums.withColumn("per_gathering", F.round(safe_divide("year_total", held), 6))
            .withColumn("last_year_per_gathering", F.round(
                safe_divide("last_year_to_date_total", held_last), 6))
            .withColumn("yoy", change_ratio("per_gathering", "last_year_per_gathering", 0)))


# --- series ----------------------------------------------------------------------

def _campus_columns(campuses: Sequence[str]) -> list[Column]:
    """One sum per campus and their total: a pivot with listed values, in one aggregate."""
    cols = [F.sum(F.when(F.col("campus").isin(list(campuses)), F.col("cnt"))).alias("all_campuses")]
    return cols + [_sum_when(F.col("campus") == c, "cnt").alias(f"campus_{c}") for c in campuses]


def monthly_series(hc: DataFrame, as_of, campuses: Sequence[str]) -> DataFrame:
    """Months from the same month last year to the selected one, a column per campus."""
    on = as_date(as_of)
    start = month_start(year_before(month_start(on)))
    rows = hc.where(F.col(DATE).between(start, F.last_day(on)))
    return rows.groupBy(yymm_number(DATE).alias("yymm")).agg(
        F.date_format(F.min(DATE), "MMM yy").alias("label"), *_campus_columns(campuses))


def weekly_series(hc: DataFrame, as_of, campuses: Sequence[str]) -> DataFrame:
    """Weeks (US numbering) from last year's same week number to the selected one."""
    on = as_date(as_of)
    ending = yyyyww_text(on)
    starting = F.concat((F.year(on) - 1).cast("string"), F.substring(ending, 5, 2))
    rows = (hc.where(F.year(DATE).between(F.year(on) - 1, F.year(on)))
            .withColumn("week", yyyyww_text(DATE))
            .where(F.col("week").between(starting, ending)))
    return rows.groupBy("week").agg(
        F.date_format(F.min(DATE), "MMM yy").alias("label"), *_campus_columns(campuses))


def multi_year(hc: DataFrame, as_of_year: int, campus: str, grain: str = "week",
               years: int = 5) -> DataFrame:
    """Week-of-year or month rows with a column per year, for one campus. Weeks are
    those the campus ever had; months are all twelve."""
    rows = hc.where(F.col("campus") == campus)
    unit = us_week_number(DATE) if grain == "week" else F.month(DATE)
    span = range(as_of_year - years + 1, as_of_year + 1)
    out = rows.groupBy(unit.alias(grain)).agg(*[
        _sum_when(F.year(DATE) == y, "cnt").alias(f"y{y}") for y in span])
    if grain == "week":
        return out
    axis = hc.sparkSession.range(1, 13).select(F.col("id").cast("int").alias(grain))
    return axis.join(out, grain, "left")


def gathered_sundays(hc: DataFrame, campuses: Sequence[str]) -> DataFrame:
    """Sundays whose in-person total is above zero."""
    rows = hc.where(F.col("campus").isin(list(campuses)) & is_sunday(DATE))
    return daily(rows).where("total > 0").select(DATE)


def last_gathered(hc: DataFrame, as_of, campuses: Sequence[str], n: int = 5) -> DataFrame:
    on = as_date(as_of)
    return (gathered_sundays(hc, campuses).where(F.col(DATE) <= on)
            .orderBy(F.desc(DATE)).limit(n))


def last_gathered_by_campus(hc: DataFrame, as_of, campuses: Sequence[str],
                            n: int = 5) -> DataFrame:
    """The last n gathered Sundays, oldest first, a column per campus (0 if none)."""
    picked = last_gathered(hc, as_of, campuses, n)
    wide = (hc.where(F.col("campus").isin(list(campuses))).join(picked, DATE, "left_semi")
            .groupBy(DATE).agg(*_campus_columns(campuses)))
    return wide.select(DATE, *[F.coalesce(c, F.lit(0)).alias(c)
                               for c in wide.columns if c != DATE]).orderBy(DATE)


def by_literal(hc: DataFrame, as_of, campuses: Sequence[str],
               literal_order: Sequence[str]) -> DataFrame:
    """Ministry counts on the selected and the previous gathered Sunday, for all
    in-person campuses together and each one. Every ministry has a row everywhere."""
    on = as_date(as_of)
    previous = (gathered_sundays(hc, campuses).where(F.col(DATE) < on)
                .agg(F.max(DATE).alias("d")).scalar())
    rows = hc.where(F.col("campus").isin(list(campuses)))
    cells = (rows.withColumn("scope", F.explode(F.array(F.lit("All"), F.col("campus"))))
             .groupBy("scope", "literal")
             .agg(_or_zero(_sum_when(F.col(DATE) == previous, "cnt")).alias("previous"),
                  _or_zero(_sum_when(F.col(DATE) == on, "cnt")).alias("current")))
    scopes = F.array(*[F.lit(s) for s in ("All", *campuses)])
    axis = (hc.where(F.col("literal").isNotNull()).select("literal").distinct()
            .withColumn("scope", F.explode(scopes)))
    return (axis.join(cells, ["scope", "literal"], "left")
            .select("scope", "literal", rank_in("literal", list(literal_order), 99).alias("sort"),
                    _or_zero(F.col("previous")).alias("previous"),
                    _or_zero(F.col("current")).alias("current")))


def _slot_cells(hc: DataFrame, campuses: Sequence[str], together: str | None) -> DataFrame:
    """(date, slot, campus) sums, with an 'All' slot and optionally all campuses
    together. Rows are summed before they are copied to their scopes."""
    base = (hc.where(F.col("campus").isin(list(campuses)))
            .groupBy(DATE, "campus", "slot").agg(F.sum("cnt").alias("total")))
    slots = F.array_compact(F.array(F.lit("All"), F.col("slot")))
    places = F.array(F.lit(together), F.col("campus")) if together else F.array("campus")
    return (base.select(DATE, F.explode(slots).alias("slot"), places.alias("places"), "total")
            .select(DATE, "slot", F.explode("places").alias("campus"), "total")
            .groupBy(DATE, "slot", "campus").agg(F.sum("total").alias("total")))


def last_gathered_grid(hc: DataFrame, as_of, campuses: Sequence[str], slots: Sequence[str],
                       n: int = 5) -> DataFrame:
    """The last n gathered Sundays x campus x slot with the count then, on the
    gathered Sunday before, and 364 days before."""
    on = as_date(as_of)
    order = Window.orderBy(DATE)  # one row per gathered Sunday
    picked = (gathered_sundays(hc, campuses).withColumn("prior_date", F.lag(DATE).over(order))
              .where(F.col(DATE) <= on).orderBy(F.desc(DATE)).limit(n)
              .withColumn("last_year_date", F.date_sub(DATE, 364)))
    cells = _slot_cells(hc, campuses, None)
    places = F.array(*[F.lit(c) for c in campuses])
    kinds = F.array(*[F.lit(s) for s in ("All", *slots)])
    out = (picked.withColumn("campus", F.explode(places)).withColumn("slot", F.explode(kinds)))
    for role, date in (("current", DATE), ("prior", "prior_date"),
                       ("last_year", "last_year_date")):
        side = cells.select(F.col(DATE).alias(date), "slot", "campus",
                            F.col("total").alias(role))
        out = out.join(side, [date, "slot", "campus"], "left")
    return out.select(DATE, "prior_date", "last_year_date", "campus", "slot", "current",
                      "prior", "last_year")


def lagged_grid(hc: DataFrame, as_of, campuses: Sequence[str], slots: Sequence[str],
                together: str = "All") -> DataFrame:
    """Dates of the 364 days to as_of x slot x campus, with the counts 7 and 364
    days earlier, blank cells included. Lags are value-range windows over the cells
    laid on their full axis."""
    on = as_date(as_of)
    dates = hc.select(DATE).distinct().where(
        (F.col(DATE) > F.date_sub(on, 364 * 2)) & (F.col(DATE) <= on))
    axis = (dates.withColumn("slot", F.explode(F.array(*[F.lit(s) for s in ("All", *slots)])))
            .withColumn("campus", F.explode(F.array(*[F.lit(c) for c in (together, *campuses)]))))
    cells = axis.join(_slot_cells(hc, campuses, together), [DATE, "slot", "campus"], "left")
    w = Window.partitionBy("slot", "campus").orderBy(_day_number())
    return (cells.withColumns({
        "previous_week": F.sum("total").over(w.rangeBetween(-7, -7)),
        "previous_year": F.sum("total").over(w.rangeBetween(-364, -364))})
        .where(F.col(DATE) > F.date_sub(on, 364)))


def regular_grid(hc: DataFrame, as_of, literals: Sequence[str], campuses: Sequence[str],
                 services: Sequence[str], n: int = 5) -> DataFrame:
    """Ministry x campus x service with the count on the selected date, the date
    before, the latest date at least 364 days back, and the mean over the last n
    dates (cells missing on a date are left out of the mean). Empty unless the
    selected date itself has rows."""
    on = as_date(as_of)
    rows = hc.where(F.col("schedule").isin(list(services)))
    dates = rows.select(DATE).distinct()
    d = F.col(DATE)
    bounds = dates.agg(F.max(F.when(d == on, d)).alias("cur"),
                       F.max(F.when(d < on, d)).alias("prev"),
                       F.max(F.when(d <= F.date_sub(on, 364), d)).alias("yoy"))
    roles = bounds.selectExpr("stack(3, 'cur', cur, 'prev', prev, 'yoy', yoy) "
                              f"AS (role, {DATE})")
    recent = (dates.where(d <= on).orderBy(F.desc(DATE)).limit(n)
              .select(F.lit("avg").alias("role"), DATE))
    keys = ["literal", "campus", "schedule"]
    cells = (rows.join(roles.unionByName(recent), DATE)
             .groupBy(*keys, "role", DATE).agg(F.sum("cnt").alias("v"))
             .groupBy(*keys)
             .agg(*[F.max(F.when(F.col("role") == r, F.col("v"))).alias(n_)
                    for r, n_ in (("cur", "current"), ("prev", "previous"),
                                  ("yoy", "prior_year"))],
                  F.round(F.avg(F.when(F.col("role") == "avg", F.col("v"))), 6)
                  .alias("five_date_average")))
    axis = literal_axis(hc.sparkSession, literal=literals, campus=campuses, schedule=services)
    found = bounds.select(F.col("cur").isNotNull().alias("f")).scalar()
    return axis.where(found).join(cells, keys, "left").select(
        *keys, "current", "previous", "prior_year", "five_date_average")


# --- monthly gatherings ------------------------------------------------------------

def rolling_year(hc: DataFrame, as_of, campus: str) -> DataFrame:
    """Gatherings of the year to as_of at one campus with a count above zero."""
    on = as_date(as_of)
    rows = hc.where((F.col("campus") == campus) & F.col(DATE).between(year_before(on), on))
    return daily(rows).where("total > 0").withColumn("label", F.date_format(DATE, "MMM yy"))


def yearly_totals(hc: DataFrame, as_of, campus: str, years: int = 7,
                  above: int = 100) -> DataFrame:
    """Yearly totals at one campus over rows whose own count is above a floor: the
    dates with such a row are summed whole."""
    on = as_date(as_of)
    rows = hc.where((F.col("campus") == campus)
                    & F.year(DATE).between(F.year(on) - years + 1, F.year(on)))
    per_date = rows.groupBy(DATE).agg(F.sum("cnt").alias("total"), F.max("cnt").alias("_top"))
    return (per_date.where(F.col("_top") > above)
            .groupBy(F.year(DATE).alias("year")).agg(F.sum("total").alias("total")))


def gathering_month_table(hc: DataFrame, as_of, campus: str) -> DataFrame:
    """One campus's ministries on the selected gathering, the gathering before, and
    the last one of the prior year: both ratios (0 without a base), and each bar as
    a share of the largest of the current and previous cells."""
    on = as_date(as_of)
    d = F.col(DATE)
    before = daily(hc).where("total > 0")
    prev = before.where(d < on).agg(F.max(DATE).alias("d")).scalar()
    prior = (hc.where(F.year(DATE) == F.year(on) - 1).agg(F.max(DATE).alias("d")).scalar())
    rows = hc.where(F.col("campus") == campus)
    cells = rows.groupBy("literal").agg(
        _or_zero(_sum_when(d == on, "cnt")).alias("current"),
        _or_zero(_sum_when(d == prev, "cnt")).alias("previous"),
        _or_zero(_sum_when(d == prior, "cnt")).alias("prior_year"))
    top = F.max(F.greatest("current", "previous")).over(Window.partitionBy(F.lit(1)))
    return cells.withColumns({
        "month_over_month": change_ratio("current", "previous", 0),
        "year_over_year": change_ratio("current", "prior_year", 0),
        "current_share": F.round(safe_divide("current", top, 0), 6),
        "previous_share": F.round(safe_divide("previous", top, 0), 6)})

