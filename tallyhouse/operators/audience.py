"""Online audience: media rows, live-or-total views, weekly attendance equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import (as_col, safe_divide, single_spaced, split_after, split_before,
                                 strip)
from ..functions.dates import as_date, last_sunday, local_date

# Attendance per view, title marks, provenance labels.
PEOPLE_PER_VIEW = 1.94
TITLE_START, TITLE_MARK = "Sunday Gathering //", "FULL GATHERING"
LIVE, PROVISIONAL, TOTAL = "analytics_live", "data_api_total_provisional", "data_api_total"
THUMBNAIL = ("https://img.youtube.com/vi/", "/maxresdefault.jpg")
LOCAL_ZONE = "America/New_York"


def is_gathering_title(title):
    c = as_col(title)
    return c.startswith(TITLE_START) | c.contains(TITLE_MARK)


def gathering_of(title):
    """The text after the first '//', for titles that start with the literal."""
    c = as_col(title)
    return F.when(c.startswith(TITLE_START), strip(split_after(c, "//")))


def released(videos: DataFrame) -> DataFrame:
    """Leave out videos still scheduled for a later release."""
    return videos.where(F.col("publish_at").isNull())


def live_on(videos: DataFrame, sunday) -> DataFrame:
    """Gathering livestreams that started on the target Sunday."""
    return videos.where(F.col("was_live") & (F.col("stream_date") == as_date(sunday))
                        & is_gathering_title("title"))


def uploads_near(videos: DataFrame, sunday) -> DataFrame:
    """Other uploads of the Sunday or the Monday after it."""
    on = as_date(sunday)
    return videos.where(~F.col("was_live")
                        & F.col("published_on").isin(on, F.date_add(on, 1)))


def with_live_views(videos: DataFrame) -> DataFrame:
    """Live views when there are any, else the total as a provisional figure that a
    later run overwrites; other videos keep their total. Records where each came from."""
    live = F.when(F.col("was_live") & (F.col("live_views") > 0), F.col("live_views"))
    return videos.withColumns({
        "views": F.coalesce(live, F.col("total_views")),
        "views_source": F.when(~F.col("was_live"), TOTAL).when(live.isNotNull(), LIVE)
        .otherwise(PROVISIONAL)})


def platform_sundays(videos: DataFrame, as_of, weeks: int = 2) -> DataFrame:
    """Broadcasts whose local start date is one of the last Sundays up to as_of."""
    newest = last_sunday(as_date(as_of))
    targets = [F.date_sub(newest, 7 * i) for i in range(weeks)]
    return (videos.withColumn("sunday_date", local_date("broadcast_start_time", LOCAL_ZONE))
            .where(F.col("sunday_date").isin(*targets))
            .withColumn("gathering", gathering_of("title"))
            .where(F.col("gathering").isNotNull()))


def backfill_ids(snapshot: DataFrame) -> DataFrame:
    return snapshot.where("was_live").select("video_id").distinct()


def title_parts(df: DataFrame, title: str, separator: str = " - ") -> DataFrame:
    """Sermon title and speaker around the first separator; without one the whole
    text is the title, as it is."""
    return df.withColumns({
        "sermon_title": F.coalesce(single_spaced(split_before(title, separator)), F.col(title)),
        "speaker": single_spaced(split_after(title, separator))})


def thumbnail(video_id):
    c = as_col(video_id)
    return F.when(c.isNotNull(), F.concat(F.lit(THUMBNAIL[0]), c, F.lit(THUMBNAIL[1])))


def single_value(column: str, blank: bool = True):
    """Aggregate: the value if the group has exactly one distinct value, else null. A
    blank beside another value is a second value, unless `blank` is false. Min and max
    replace a distinct set, so nothing is collected."""
    low, high = F.min(column), F.max(column)
    whole = F.count(F.col(column)) == F.count(F.lit(1)) if blank else F.lit(True)
    return F.when(low.eqNullSafe(high) & whole, low)


def weekly_sermon(clips: DataFrame, as_of) -> DataFrame:
    """Title, speaker, views, id and thumbnail of the Sunday-or-Monday clips; blank
    when there is more than one title."""
    on = as_date(as_of)
    one = (clips.where(F.col("published_on").between(on, F.date_add(on, 1)))
           .agg(single_value("title").alias("raw_title"), F.sum("total_views").alias("views"),
                single_value("video_id").alias("video_id")))
    return title_parts(one, "raw_title").withColumn("thumbnail_url", thumbnail("video_id"))


def weekly_online(platform_a: DataFrame, platform_b: DataFrame, legacy: DataFrame) -> DataFrame:
    """Online attendance of every Sunday, one row per date.

    Views become people per video (rounded, then summed). Platform A, with platform
    B added, replaces the legacy count once it has any; `online_one_platform` is the
    variant without platform B that the previous-week card shows. Each source is
    summed before the union, so the sources are never joined row to row.
    """
    def people(df: DataFrame, views: str, source: str) -> DataFrame:
        return (df.groupBy("sunday_date")
                .agg(F.sum(F.round(F.col(views) * PEOPLE_PER_VIEW).cast("bigint")).alias("n"))
                .select("sunday_date", F.lit(source).alias("source"), "n"))

    old = (legacy.groupBy("sunday_date").agg(F.sum("cnt").alias("n"))
           .select("sunday_date", F.lit("old").alias("source"), "n"))
    rows = (people(platform_a, "total_views", "a")
            .unionByName(people(platform_b, "one_minute_views", "b")).unionByName(old))
    parts = rows.groupBy("sunday_date").agg(*[
        F.sum(F.when(F.col("source") == s, F.col("n"))).alias(s) for s in ("a", "b", "old")])
    has_a = F.col("a") > 0
    return parts.select(
        "sunday_date",
        F.when(has_a, F.col("a") + F.coalesce("b", F.lit(0))).otherwise(F.col("old"))
        .alias("online"),
        F.when(has_a, F.col("a")).otherwise(F.col("old")).alias("online_one_platform"))


def online_card(weekly: DataFrame, as_of, lookback: int = 10, n: int = 5) -> DataFrame:
    """The online card of one date: previous week, prior year (-364), the mean of
    the last n weeks with data out of `lookback`, and the changes. Week and year
    changes are null unless both sides are above zero; against the average, a date
    without data counts as zero."""
    on, d = as_date(as_of), F.col("sunday_date")
    weeks = [F.date_sub(on, 7 * i) for i in range(lookback)]
    average = (weekly.where(d.isin(*weeks) & (F.col("online") > 0))
               .orderBy(F.desc("sunday_date")).limit(n)
               .agg(F.round(F.avg("online")).alias("m")).scalar())

    def at(date, column: str):
        return F.max(F.when(d == date, F.col(column)))

    def change(base: str):
        return F.when((F.col("current") > 0) & (F.col(base) > 0), F.round(
            safe_divide(F.col("current") - F.col(base), base), 6))

    card = weekly.agg(at(on, "online").alias("current"),
                      at(F.date_sub(on, 7), "online_one_platform").alias("previous_week"),
                      at(F.date_sub(on, 364), "online").alias("prior_year"))
    against = F.when(F.col("five_week_average") > 0, F.round(safe_divide(
        F.coalesce("current", F.lit(0)) - F.col("five_week_average"), "five_week_average"), 6))
    return card.withColumn("five_week_average", average).withColumns({
        "wow": change("previous_week"), "yoy": change("prior_year"),
        "against_average": against})


def online_history(weekly: DataFrame) -> DataFrame:
    """Every Sunday with the online attendance 364 days before."""
    day = F.datediff("sunday_date", F.lit("1970-01-01").cast("date"))
    w = Window.orderBy(day).rangeBetween(-364, -364)  # one row per Sunday
    return weekly.withColumn("prior_year", F.sum("online").over(w))


def first_time_by_week(first_dates: DataFrame, as_of, weeks: int = 5,
                       person: str = "person_id", date: str = "first_date") -> DataFrame:
    """People whose first date falls in each of the last weeks (Monday to the Sunday
    the week ends on), 0 where none. `first_dates` has one row per person."""
    on = as_date(as_of)
    back = F.floor(F.datediff(on, date) / 7).cast("int")
    counts = (first_dates.where(F.col(date).between(F.date_sub(on, 7 * weeks - 1), on))
              .groupBy(back.alias("weeks_back"))
              .agg(F.count_distinct(person).alias("people")))
    axis = first_dates.sparkSession.range(weeks).select(
        F.col("id").cast("int").alias("weeks_back"))
    return (axis.join(counts, "weeks_back", "left")
            .select(F.date_sub(on, F.col("weeks_back") * 7).alias("week_end"),
                    F.coalesce("people", F.lit(0)).alias("people")))
