"""Date arithmetic as column expressions; `as_of` is always explicit."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import ColumnOrName, as_col, pad2

SUNDAY = 1  # dayofweek numbering


def as_date(value) -> Column:
    """A date argument given as a column, a date or ISO text."""
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, dt.date):
        return F.lit(value).cast("date")
    return F.lit(str(value)).cast("date")


def as_timestamp(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def dayofweek(date: ColumnOrName) -> Column:
    return F.dayofweek(as_col(date))


def is_sunday(date: ColumnOrName) -> Column:
    return dayofweek(date) == SUNDAY


def week_ending_sunday(date: ColumnOrName) -> Column:
    """The Sunday that ends the Monday-to-Sunday week of a date."""
    return F.date_add(F.trunc(as_col(date), "week"), 6)


def last_sunday(date: ColumnOrName) -> Column:
    """The most recent Sunday on or before a date; also the start of a Sunday-first week."""
    c = as_col(date)
    return F.date_sub(c, dayofweek(c) - 1)


def month_start(date: ColumnOrName) -> Column:
    return F.trunc(as_col(date), "month")


def us_week_number(date: ColumnOrName) -> Column:
    """Week 1 holds January 1 and weeks start on Sunday (not the ISO week)."""
    c = as_col(date)
    jan1 = F.trunc(c, "year")
    return F.floor((F.dayofyear(c) + dayofweek(jan1) - 2) / 7).cast("int") + 1


def yymm_number(date: ColumnOrName) -> Column:
    c = as_col(date)
    return F.pmod(F.year(c), F.lit(100)) * 100 + F.month(c)


def yyyyww_text(date: ColumnOrName) -> Column:
    c = as_col(date)
    return F.concat(F.year(c).cast("string"), pad2(us_week_number(c)))


def month_day_number(date: ColumnOrName) -> Column:
    c = as_col(date)
    return F.month(c) * 100 + F.dayofmonth(c)


def in_year_2000(date: ColumnOrName) -> Column:
    """The same month and day in 2000, a leap year, so every date exists."""
    c = as_col(date)
    return F.make_date(F.lit(2000), F.month(c), F.dayofmonth(c))


def rolled_date(year: Column, month: Column, day: Column) -> Column:
    """A date whose day may overflow its month (Feb 29 of a common year is Mar 1)."""
    return F.date_add(F.make_date(year, month, F.lit(1)), day - 1)


def year_before(date: ColumnOrName) -> Column:
    c = as_col(date)
    return rolled_date(F.year(c) - 1, F.month(c), F.dayofmonth(c))


# Days added to last year's date, by weekday (1 = Monday).
PRIOR_YEAR_SNAP = {1: 0, 2: -1, 3: -2, 4: -3, 5: 2, 6: 1, 7: 0}


def snapped_year_before(date: ColumnOrName) -> Column:
    """Last year's date moved to the start or end of its week by the snap table."""
    prior = year_before(date)
    shift = F.element_at(
        F.array(*[F.lit(PRIOR_YEAR_SNAP[d]) for d in range(1, 8)]), F.weekday(prior) + 1)
    return F.date_add(prior, shift)


def age_years(birth: ColumnOrName, as_of) -> Column:
    """Whole years: calendar-year difference less one before the birthday."""
    b, on = as_col(birth), as_date(as_of)
    before_birthday = F.date_format(on, "MMdd") < F.date_format(b, "MMdd")
    return F.year(on) - F.year(b) - F.when(before_birthday, 1).otherwise(0)


def whole_days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Full 24-hour days from start to end."""
    return F.timestamp_diff("DAY", as_col(start), as_col(end))


def trailing(date: ColumnOrName, as_of, days: int) -> Column:
    """Inside the `days`-day period that ends on (and includes) as_of."""
    on = as_date(as_of)
    return as_col(date).between(F.date_sub(on, days - 1), on)


def easter(year: ColumnOrName) -> Column:
    """Western Easter by integer arithmetic on the year (Oudin's 1940 rule)."""
    y = as_col(year).cast("int")

    def div(a, b):
        return F.floor(a / b).cast("int")

    century = div(y, 100)
    golden = F.pmod(y, F.lit(19))
    moon = F.pmod(century - div(century, 4) - div(century - div(century - 17, 25), 3)
                  + 19 * golden + 15, F.lit(30))
    late = div(moon, 28)
    moon = moon - late * (1 - late * div(F.lit(29), moon + 1) * div(21 - golden, 11))
    weekday = F.pmod(y + div(y, 4) + moon + 2 - century + div(century, 4), F.lit(7))
    return F.date_add(F.make_date(y, F.lit(3), F.lit(1)), moon - weekday + 27)


def christmas_eve(year: ColumnOrName) -> Column:
    return F.make_date(as_col(year), F.lit(12), F.lit(24))


def local_date(timestamp: ColumnOrName, zone: str) -> Column:
    """Calendar date of an instant in a zone or fixed offset, whatever the session's zone."""
    return F.to_date(F.convert_timezone(None, F.lit(zone), as_col(timestamp)))


# Days to publish a holiday's counts, and the status labels.
HOLIDAY_GRACE_DAYS = 14


def holiday_status(has_data: Column, today, holiday: ColumnOrName) -> Column:
    now, day = as_date(today), as_col(holiday)
    return (F.when(has_data, "Show")
            .when(now < day, "Upcoming")
            .when(now <= F.date_add(day, HOLIDAY_GRACE_DAYS), "Processing")
            .otherwise("Show"))


def meetings_in_period(start: ColumnOrName, rhythm: ColumnOrName, as_of, days: int = 35) -> Column:
    """Meetings held in [as_of - days, as_of] of a series that began on `start`.

    Computed, not expanded: weekly and two-weekly series are counted by division
    and a monthly series can only meet in the period's last few months. Monthly
    dates step from the start date, so a series begun on the 31st meets on the
    last day of shorter months. A missing start date has no meetings.
    """
    s, on = as_col(start), as_date(as_of)
    low = F.date_sub(on, days)

    def every(step: int) -> Column:
        last = F.floor(F.datediff(on, s) / step)
        first = F.greatest(F.ceil(F.datediff(low, s) / step), F.lit(0))
        return F.greatest(last - first + 1, F.lit(0))

    months = (F.year(on) - F.year(s)) * 12 + F.month(on) - F.month(s)
    monthly = F.lit(0)
    for back in range(days // 28 + 2):
        k = months - back
        hit = (k >= 0) & F.add_months(s, k).between(low, on)
        monthly = monthly + F.when(hit, 1).otherwise(0)
    count = (F.when(as_col(rhythm) == "once", F.when(s.between(low, on), 1).otherwise(0))
             .when(as_col(rhythm) == "weekly", every(7))
             .when(as_col(rhythm) == "every other week", every(14))
             .when(as_col(rhythm) == "monthly", monthly)
             .otherwise(0))
    return F.coalesce(F.when(s.isNull(), F.lit(0)).otherwise(count), F.lit(0)).cast("bigint")
