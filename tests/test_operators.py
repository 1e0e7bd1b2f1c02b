"""Null, tie, gap, leap-day, duplicate and empty-input cases on hand-written frames."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyhouse.operators import (audience, calendar, camp, engagement, gold, headcount, holidays,
                                  journey, lookup, metrics, quality, signups)
from tallyhouse.operators import staging as S
from tallyhouse.plans.inputs import as_bronze

D = dt.date


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


# --- staging -------------------------------------------------------------------------------

def people(spark, data):
    schema = ("Id int, FirstName string, NickName string, LastName string, BirthYear int, "
              "BirthMonth int, BirthDay int, Gender int, RecordStatusValueId int, "
              "IsDeceased string")
    return S.people(as_bronze(spark.createDataFrame(data, schema), S.PEOPLE))


def test_people_nulls(spark):
    out = people(spark, [
        (1, "Ann", "Annie", "Lee", 2000, 2, 29, 2, 3, "false"),
        (2, "Bo", None, None, 2000, None, 1, None, 3, None),
        (3, "Cy", None, "Ray", None, 1, 1, 9, 4, "true")])
    got = rows(out, "person_id", "display_name", "full_name", "birth_date", "gender", "is_active",
               "email_preference")
    assert got == [
        (1, "Annie", "Annie Lee", D(2000, 2, 29), "Female", True, "Unknown"),
        (2, "Bo", None, None, "Unknown", False, "Unknown"),
        (3, "Cy", "Cy Ray", None, "Unknown", False, "Unknown")]


def test_group_active_flag_propagates_null_but_member_flag_does_not(spark):
    groups = S.groups(as_bronze(spark.createDataFrame(
        [(1, True, None), (2, False, None), (3, True, False), (4, None, True)],
        "Id int, IsActive boolean, IsArchived boolean"), S.GROUPS))
    assert rows(groups, "group_id", "is_currently_active") == [
        (1, None), (2, False), (3, True), (4, False)]
    members = S.group_members(as_bronze(spark.createDataFrame(
        [(1, 1, None), (2, None, False), (3, 1, True), (4, 2, False)],
        "Id int, GroupMemberStatus int, IsArchived boolean"), S.GROUP_MEMBERS))
    assert rows(members, "group_member_id", "is_currently_active_member",
                "group_member_status") == [
        (1, True, "Active"), (2, False, "Unknown"), (3, False, "Active"), (4, False, "Pending")]


def test_open_ends_differ_between_campus_and_account(spark):
    on, start = "2024-06-02", D(2020, 1, 1)
    data = [(1, True, start, D(2024, 6, 2)), (2, True, None, None), (3, None, None, None),
            (4, True, D(2024, 6, 2), None), (5, True, D(2024, 6, 3), None)]
    campus = S.campuses(as_bronze(spark.createDataFrame(
        data, "Id int, IsActive boolean, OpenedDate date, ClosedDate date"), S.CAMPUSES), on)
    account = S.financial_accounts(as_bronze(spark.createDataFrame(
        data, "Id int, IsActive boolean, StartDate date, EndDate date"),
        S.FINANCIAL_ACCOUNTS), on)
    assert rows(campus, "campus_id", "is_currently_open") == [
        (1, False), (2, True), (3, False), (4, True), (5, False)]
    assert rows(account, "financial_account_id", "is_currently_active") == [
        (1, True), (2, True), (3, False), (4, True), (5, False)]


def test_days_to_connect_are_whole_days(spark):
    at = dt.datetime
    df = as_bronze(spark.createDataFrame(
        [(1, 3, at(2024, 1, 1, 12), at(2024, 1, 3, 11)), (2, 0, at(2024, 1, 1), None)],
        "Id int, ConnectionState int, CreatedDateTime timestamp, ConnectedDateTime timestamp"),
        S.CONNECTION_REQUESTS)
    assert rows(S.connection_requests(df), "connection_request_id", "days_to_connect",
                "is_connected") == [(1, 1, True), (2, None, False)]


def test_sensitive_columns_do_not_leave_bronze():
    exposed = {c for name in dir(S) if isinstance(getattr(S, name), S.Model)
               for c in getattr(S, name).columns}
    assert not exposed & {"SearchValue", "Comments", "CheckMicrEncrypted", "CheckMicrHash",
                          "InternalMessage", "Summary_", "SystemNote"}


def test_names_follow_the_rule():
    assert S.snake("RSVPDateTime") == "rsvp_at" and S.snake("PersonAliasId") == "person_alias_id"
    assert S.ATTENDANCE.name_of("RequestedToAttend") == "is_requested_to_attend"
    assert S.ATTENDANCE.name_of("ScheduledToAttend") == "is_scheduled_to_attend"
    assert S.FINANCIAL_TRANSACTIONS.name_of("TransactionDateTime") == "transaction_at"
    assert S.FINANCIAL_ACCOUNTS.name_of("UsesCampusChildAccounts") == "uses_campus_child_accounts"
    assert S.PERSON_ALIASES.name_of("AliasedDateTime") == "aliased_at"
    assert S.GROUP_TYPES.name_of("ShowInGroupList") == "show_in_group_list"


# --- headcount metrics -----------------------------------------------------------------------

HC = "sunday_date date, campus string, literal string, schedule string, cnt bigint"


def sundays(n, last=D(2024, 6, 2)):
    return [last - dt.timedelta(days=7 * i) for i in range(n)]


def hc(spark, data):
    return spark.createDataFrame(data, HC)


def test_wow_skips_empty_weeks_and_zero_totals(spark):
    s = sundays(4)
    df = hc(spark, [(s[0], "A", "x", "9", 120), (s[2], "A", "x", "9", 0), (s[3], "A", "x", "9", 100),
                    (s[0] - dt.timedelta(days=1), "A", "x", "9", 5), (s[0], "B", "x", "9", 7)])
    got = {r.campus: r for r in metrics.week_over_week(df, s[0], ["campus"]).collect()}
    assert (got["A"].previous_date, got["A"].previous, got["A"].wow) == (s[3], 100, 0.2)
    assert got["A"].arrow == "▲"
    # The first week of data has nothing before it: the ratio is 0, not null.
    assert (got["B"].previous, got["B"].wow) == (None, 0.0)
    # Any weekday counts when asked for.
    any_day = metrics.week_over_week(df, s[0], ["campus"], sundays_only=False).collect()
    assert [r.previous for r in any_day if r.campus == "A"] == [5]


def test_selected_date_without_rows_counts_zero(spark):
    s = sundays(3)
    df = hc(spark, [(s[1], "A", "x", "9", 50)])
    r = metrics.week_over_week(df, s[0], ["campus"]).first()
    assert (r.current, r.previous, r.wow, r.arrow) == (0, 50, -1.0, "▼")


def test_a_group_that_missed_the_last_gathering_counts_zero_there(spark):
    s = sundays(9)
    df = hc(spark, [(s[0], "A", "x", "5", 30), (s[4], "A", "x", "5", 20), (s[0], "B", "x", "5", 9),
                    (s[8], "B", "x", "5", 8)])
    got = {r.campus: r for r in metrics.gathering_over_gathering(df, s[0], ["campus"]).collect()}
    assert {r.previous_date for r in got.values()} == {s[4]}
    assert (got["A"].change, got["B"].previous, got["B"].change) == (0.5, 0, 0.0)


def test_yoy_364_needs_the_exact_date(spark):
    s = sundays(53)
    df = hc(spark, [(s[0], "A", "x", "9", 90), (s[52], "A", "x", "9", 100), (s[1], "A", "x", "9", 9)])
    got = {r.sunday_date: (r.prior_year, r.yoy) for r in
           metrics.year_over_year_364(df, ["campus"]).collect()}
    assert got[s[0]] == (100, -0.1) and got[s[1]] == (None, None)


@pytest.mark.parametrize("weeks,total", [(5, 5 * 10), (4, 6 * 10)])
def test_five_week_average_falls_back_to_49_days(spark, weeks, total):
    s = sundays(8)
    kept = s if weeks == 5 else [d for d in s if d != s[2]]
    df = hc(spark, [(d, "A", "x", "9", 10) for d in kept])
    r = metrics.five_week_average_dates(df, s[0], ["campus"]).first()
    assert (r.dates, r.five_week_average) == (weeks, total / 5)


def test_past_year_average_ignores_zeroes_and_holidays(spark):
    s = sundays(4)
    df = hc(spark, [(s[0], "A", "x", "9", 10), (s[1], "A", "x", "9", 0), (s[2], "A", "x", "9", 99),
                    (s[3], "A", "x", "9", 20)])
    holiday = spark.createDataFrame([(s[2],)], "sunday_date date")
    r = metrics.past_year_average(df, s[0], holiday, ["campus"]).first()
    assert (r.dates, r.past_year_average) == (2, 15.0)


def test_sum_over_campuses_is_the_total(spark):
    rnd = random.Random(2)
    df = hc(spark, [(d, c, lit, "9", rnd.randrange(100)) for d in sundays(20) for c in "ABC"
                    for lit in "xy"])
    s = sundays(1)[0]
    parts = metrics.current_and_previous(df, s, ["campus"]).collect()
    whole = metrics.current_and_previous(df, s).first()
    assert sum(r.current for r in parts) == whole.current
    wide = metrics.monthly_series(df, s, ["A", "B", "C"]).collect()
    assert all(r.all_campuses == r.campus_A + r.campus_B + r.campus_C for r in wide)


def test_regular_grid_is_empty_without_the_exact_date(spark):
    s = sundays(3)
    df = hc(spark, [(s[1], "A", "x", "9", 10), (s[2], "A", "x", "9", 30)])
    assert metrics.regular_grid(df, s[0], ["x"], ["A"], ["9"]).count() == 0
    r = metrics.regular_grid(df, s[1], ["x", "z"], ["A"], ["9"]).orderBy("literal").collect()
    assert (r[0].current, r[0].previous, r[0].five_date_average) == (10, 30, 20.0)
    assert (r[1].current, r[1].five_date_average) == (None, None)


def test_metrics_of_an_empty_table(spark):
    df = hc(spark, [])
    assert metrics.week_over_week(df, "2024-06-02", ["campus"]).count() == 0
    assert metrics.trailing_sums(df, ["campus"]).count() == 0
    assert metrics.last_gathered(df, "2024-06-02", ["A"]).count() == 0


def test_feeds_with_a_missing_column(spark):
    a = spark.createDataFrame([("A", D(2024, 6, 2), "9:30am", 5), ("A", D(2024, 6, 2), "9:30am", 2)],
                              "campus string, sunday_date date, schedule string, value int")
    b = a.drop("schedule")
    out = headcount.regroup(headcount.union_feeds([headcount.feed(a, "Adults"),
                                                   headcount.feed(b, "MS")]))
    assert rows(out, "literal", "schedule", "cnt") == [("Adults", "9:30am", 7), ("MS", None, 7)]


def test_positional_previous_divides_zero_to_null(spark):
    df = hc(spark, [(d, "A", "x", "9", i) for i, d in enumerate(reversed(sundays(8)))])
    out = headcount.positional_previous(df, ["literal", "sunday_date"], 7).orderBy("row_index")
    last = out.collect()[-1]
    assert (last.row_index, last.prev_week, last.wow) == (7, 0, None)


# --- holidays --------------------------------------------------------------------------------

def test_holiday_comparison_aligns_by_rank(spark):
    cols = ("year int, event string, campus string, literal string, schedule string, "
            "schedule_sort int, cnt bigint")
    data = [(2024, "Easter", "A", "Adults", "9:00am", 3, 110),
            (2024, "Easter", "A", "Adults", "11:00am", 8, 60),
            (2023, "Easter", "A", "Adults", "8:30am", 2, 100),
            (2023, "Easter", "A", "Adults", "10:00am", 6, 40),
            (2023, "Easter", "A", "Adults", "10:00am B", 6, 20),
            (2024, "Easter", "A", "MS", "9:00am", 3, 7)]
    out = holidays.holiday_comparison(spark.createDataFrame(data, cols), "Easter", 2024, ["A"])
    got = {(r.literal, r["rank"]): r for r in out.where("scope = 'A'").collect()}
    one = got["Adults", 1]
    assert (one.service, one.previous_service, one.state, one.ratio, one.bar) == (
        "9:00am", "8:30am", "ok", 0.1, 20)
    # Two services of 2023 share a sort number, so both have rank 3 and rank 2 is new.
    assert (got["Adults", 2].state, got["Adults", 2].current) == ("new", 60)
    three = got["Adults", 3]
    assert (three.previous_service, three.state, three.previous) == (
        "10:00am / 10:00am B", "gone", 60)
    total = got["Adults", 0]
    assert (total.current, total.previous, total.service, total.bar) == (170, 160, "", 13)
    assert got["MS", 3].state == "empty" and got["MS", 0].state == "new"


def test_special_sundays(spark):
    days = calendar.holiday_sundays(calendar.year_range(spark, 2024, 2025))
    assert rows(days, "year", "event", "sunday_date") == [
        (2024, "Christmas", D(2024, 12, 29)), (2024, "Easter", D(2024, 3, 31)),
        (2025, "Christmas", D(2025, 12, 28)), (2025, "Easter", D(2025, 4, 20))]


def test_series_of_integers(spark):
    assert [r.day for r in calendar.day_numbers(spark).collect()] == list(range(1, 367))


# --- journeys --------------------------------------------------------------------------------

def brute_as_of(versions, person, day):
    found = [v for v in versions if v[0] == person and v[2] <= day < v[3]]
    return found[-1][4] if found else None


def test_as_of_join_matches_brute_force_under_a_hot_key(spark):
    rnd = random.Random(11)
    changes = [(1 if rnd.random() < 0.6 else rnd.randrange(2, 8), i,
                D(2020, 1, 1) + dt.timedelta(days=rnd.randrange(500)), rnd.choice("FOP"))
               for i in range(400)]
    df = spark.createDataFrame(changes, "person_id int, version_id int, effective_date date, "
                                        "stage string").repartition(5)
    history = journey.validity(df, "person_id", "effective_date", "version_id")
    versions = [(r.person_id, r.version_id, r.effective_date, r.expire_date, r.stage)
                for r in history.collect()]
    assert len(versions) == 400
    ordered = sorted(versions, key=lambda v: (v[0], v[2], v[1]))
    for a, b in zip(ordered, ordered[1:] + [(None,) * 5]):
        assert a[3] == (b[2] if b[0] == a[0] else D(9999, 1, 1))
    asked = [(rnd.randrange(1, 10), i, D(2019, 11, 1) + dt.timedelta(days=rnd.randrange(700)))
             for i in range(500)]
    facts = spark.createDataFrame(asked, "person_id int, fact int, on date").repartition(3)
    out = journey.as_of_join(facts, history, "person_id", "on", "version_id")
    got = {r.fact: r.stage for r in out.collect()}
    assert got == {f: brute_as_of(versions, p, d) for p, f, d in asked}


def test_validity_keeps_versions_without_a_start(spark):
    df = spark.createDataFrame([(1, 1, D(2024, 1, 1)), (1, 2, None), (None, 3, D(2024, 1, 1))],
                               "k int, id int, d date")
    assert rows(journey.validity(df, "k", "d", "id"), "id", "expire_date") == [
        (1, D(9999, 1, 1)), (2, None), (3, None)]


def test_validity_ends_are_half_open(spark):
    history = spark.createDataFrame(
        [(1, D(2024, 6, 2), D(2024, 6, 9), "a"), (2, D(2024, 5, 1), D(2024, 6, 2), "b")],
        "person_id int, effective_date date, expire_date date, stage string")
    assert rows(journey.as_of_versions(history, "2024-06-02"), "person_id") == [(1,)]


def test_family_takes_its_best_stage(spark):
    people_ = spark.createDataFrame([(1, 10), (2, 10), (3, 20), (4, None)],
                                    "person_id int, family_id int")
    history = spark.createDataFrame(
        [(1, "Lapsed Giver"), (2, "New Giver"), (3, "odd")], "person_id int, stage string"
    ).withColumns({"effective_date": F.lit(D(2024, 1, 1)), "expire_date": F.lit(D(9999, 1, 1))})
    assert rows(journey.family_stage(people_, history, "2024-06-02"), "family_id",
                "giving_code") == [(10, 1), (20, 0)]
    assert rows(journey.family_stage(people_, history, "2023-06-02"), "family_id",
                "giving_code") == [(10, 0), (20, 0)]


# --- lookups ---------------------------------------------------------------------------------

def test_lookup_fails_only_on_conflicting_values(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    table = spark.createDataFrame([(1, "a"), (1, "a"), (3, "b"), (3, "c")], "k int, v string")
    assert rows(lookup.lookup_value(df, table, {"k": "k"}, "v", "v")) == [(1, "a"), (2, None)]
    clash = spark.createDataFrame([(3,)], "k int")
    with pytest.raises(PySparkException, match="several values"):
        lookup.lookup_value(clash, table, {"k": "k"}, "v", "v").collect()


def test_two_titles_in_one_week_are_blank(spark):
    cols = "published_on date, title string, video_id string, total_views int"
    on = D(2024, 6, 2)
    clips = spark.createDataFrame([(on, "Hope - Sam", "v1", 5), (on, "Hope - Sam", "v1", 6),
                                   (on + dt.timedelta(days=2), "Late - Al", "v9", 1)], cols)
    r = audience.weekly_sermon(clips, on).first()
    assert (r.sermon_title, r.speaker, r.views) == ("Hope", "Sam", 11)
    assert r.thumbnail_url.endswith("/v1/maxresdefault.jpg")
    more = clips.union(spark.createDataFrame([(on, "Other - Bo", "v2", 1)], cols))
    r = audience.weekly_sermon(more, on).first()
    assert (r.raw_title, r.sermon_title, r.thumbnail_url, r.views) == (None, None, None, 12)


def test_title_parts(spark):
    df = spark.createDataFrame([(" Hope   now  -  Sam  Lee - x ",), ("No speaker ",), (None,)],
                               "t string")
    assert rows(audience.title_parts(df, "t").select("sermon_title", "speaker")) == [
        ("Hope now", "Sam Lee - x"), ("No speaker ", None), (None, None)]


def test_gathering_titles(spark):
    df = spark.createDataFrame([("Sunday Gathering // 9:30 // x ",), ("FULL GATHERING",),
                                ("x Sunday Gathering // y",)], "t string")
    got = df.select(audience.is_gathering_title("t").alias("is"),
                    audience.gathering_of("t").alias("g")).collect()
    assert [tuple(r) for r in got] == [(True, "9:30 // x"), (True, None), (False, None)]


def test_live_views_and_their_source(spark):
    df = spark.createDataFrame([(1, True, 5, 50), (2, True, 0, 50), (3, True, None, 50),
                                (4, False, 9, 50)],
                               "id int, was_live boolean, live_views int, total_views int")
    assert rows(audience.with_live_views(df), "id", "views", "views_source") == [
        (1, 5, audience.LIVE), (2, 50, audience.PROVISIONAL), (3, 50, audience.PROVISIONAL),
        (4, 50, audience.TOTAL)]


def test_online_card_uses_weeks_with_data(spark):
    on = D(2024, 6, 2)
    weekly = spark.createDataFrame(
        [(on - dt.timedelta(days=7 * i), None if i == 2 else 0 if i == 3 else 100 + i, 50 + i)
         for i in range(1, 10)], "sunday_date date, online bigint, online_one_platform bigint")
    r = audience.online_card(weekly, on).first()
    # Weeks 1, 4, 5, 6 and 7 back have data; the date itself does not.
    assert (r.current, r.previous_week, r.five_week_average) == (None, 51, 105.0)
    assert (r.wow, r.yoy, r.against_average) == (None, None, -1.0)


# --- engagement ------------------------------------------------------------------------------

def test_distinct_people_equals_distinct_counts_under_a_hot_group(spark):
    rnd = random.Random(4)
    data = [("hot" if rnd.random() < 0.5 else rnd.choice("ab"), rnd.randrange(40),
             rnd.random() < 0.5, rnd.random() < 0.2) for _ in range(900)]
    df = spark.createDataFrame(data, "g string, p int, x boolean, y boolean")
    got = {r.g: (r.x, r.y) for r in engagement.distinct_people(
        df, ["g"], "p", {"x": F.col("x"), "y": F.col("y")}).collect()}
    assert got == {g: tuple(len({d[1] for d in data if d[0] == g and d[i]}) for i in (2, 3))
                   for g in ("hot", "a", "b")}


def test_serving_average_rounds_up_and_never_goes_below_zero(spark):
    on = D(2024, 6, 5)  # a Wednesday: weekday number 4, so the window starts 39 days back
    summary = spark.createDataFrame(
        [(1, D(2024, 6, 2), 5, 1), (1, D(2024, 5, 26), 4, 0), (1, D(2024, 4, 21), 90, 3)],
        "campus_id int, occurrence_date date, check_ins bigint, first_time bigint")
    r = engagement.serving_averages(summary, F.lit(3), on).first()
    assert (r.serving, r.not_serving, r.new_recent, r.new_this_year) == (5, 0, 1, 4)
    none = engagement.serving_averages(summary.where("false"), F.lit(3), on).first()
    assert (none.serving, none.not_serving) == (None, None)


def test_answers_ignore_case(spark):
    at = dt.datetime
    df = spark.createDataFrame([("YES", at(2024, 6, 1)), ("yes", at(2024, 1, 1)),
                                ("no", at(2024, 6, 1)), ("Yes", at(2023, 7, 1))],
                               "value string, created_at timestamp")
    assert tuple(engagement.answers(df, "2024-06-02 00:00:00").first()) == (1, 2, 3)


def test_cumulative_signups_are_dense_and_cut(spark):
    df = spark.createDataFrame(
        [("a", D(2024, 4, 21)), ("a", D(2023, 4, 21)), ("b", D(2024, 4, 22)), ("a", D(2024, 5, 1))],
        "event string, on date")
    out = signups.cumulative(df, "event", "on", until=422)
    assert rows(out) == [("a", 421, 2), ("a", 422, 2), ("a", 501, None),
                         ("b", 421, 0), ("b", 422, 1), ("b", 501, None)]


def test_first_time_weeks_run_monday_to_sunday(spark):
    df = spark.createDataFrame([(1, D(2024, 5, 27)), (2, D(2024, 6, 2)), (3, D(2024, 5, 26)),
                                (4, D(2024, 6, 3))], "person_id int, first_date date")
    got = rows(audience.first_time_by_week(df, "2024-06-02", weeks=2))
    assert got == [(D(2024, 5, 26), 1), (D(2024, 6, 2), 2)]


# --- camp and gold -----------------------------------------------------------------------------

def test_test_groups_are_found_by_case(spark):
    df = spark.createDataFrame([("Test A",), ("a TEST",), ("contest",), ("tEst",), (None,)],
                               "name string")
    assert rows(camp.real_groups(df)) == [("tEst",), (None,)]


def test_camp_model_filters(spark):
    df = spark.createDataFrame(
        [(False, None, 160), (True, None, 160), (False, "x", 70), (False, None, 10)],
        "is_test boolean, deleted_at string, status int")
    assert camp.counted_orders(df).count() == 1
    df = spark.createDataFrame([("App\\Models\\EventHotel",)], "t string")
    assert df.select(camp.item_type("t")).first()[0] == "Hotel"


def test_unresolved_alias_has_no_person(spark):
    fact = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id int, alias int")
    aliases = spark.createDataFrame([(10, 7)], "person_alias_id int, person_id int")
    assert rows(gold.resolve_alias(fact, aliases, "alias", "person"), "id", "person") == [
        (1, 7), (2, None), (3, None)]


def test_dim_date(spark):
    dim = gold.dim_date(spark)
    assert dim.count() == 14976
    r = dim.where("date_key = 20240602").first()
    assert (r.day_of_week_number, r.day_of_week_name, r.is_weekend, r.sunday_date) == (
        1, "Sunday", True, D(2024, 6, 2))
    assert dim.where("date_key = 20240603").first().sunday_date == D(2024, 6, 9)


# --- quality -----------------------------------------------------------------------------------

def test_checks(spark):
    child = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (5, None)], "k int, v string")
    parent = spark.createDataFrame([(1,)], "k int")
    found = {r.check_name: (r.failures, r.severity) for r in quality.together([
        quality.unique(child, ["k"], "u"), quality.not_null(child, ["k", "v"], "n"),
        quality.relationship(child, "k", parent, "k", "r"),
        quality.accepted_values(child, "v", ["a", "b"], "a"),
        quality.same_row_count(child, child.dropna(), "c")]).collect()}
    assert found == {"u": (1, "error"), "n.k": (1, "error"), "n.v": (1, "error"),
                     "r": (1, "warn"), "a": (1, "error"), "c": (2, "error")}


@pytest.mark.parametrize("hours,state", [(29, "pass"), (31, "warn"), (49, "error")])
def test_freshness(spark, hours, state):
    now = dt.datetime(2024, 6, 2, 12)
    df = spark.createDataFrame([(now - dt.timedelta(hours=hours),)], "t timestamp")
    assert quality.freshness(df, "t", now, "f").first().state == state
    assert quality.freshness(df.where("false"), "t", now, "f").first().state == "error"


# --- the model graph -----------------------------------------------------------------------------

def test_warehouse_builds_views_and_tables_and_passes_its_checks(spark, sf_dir):
    from tallyhouse.operators import warehouse
    from tallyhouse.plans import inputs

    models = warehouse.build(spark, inputs.bronze(spark, sf_dir), inputs.EVENTS_AS_OF)
    assert {"stg_people", "stg_occurrences"} <= {
        t.name for t in spark.catalog.listTables() if t.isTemporary}
    assert spark.table("door_holder_engagement").count() > 0
    one_week = spark.table("fct_attendance").where("sunday_date = DATE '2024-01-14'")
    plan = one_week._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sunday_date" in plan and one_week.count() > 0
    gold_tables = {n: models[n] for n in ("dim_date", "dim_group", "dim_person",
                                          "fct_group_membership", "fct_connection_request",
                                          "fct_attendance", "door_holder_engagement",
                                          "door_holder_giving")}
    failed = warehouse.checks(gold_tables).where("failures > 0").collect()
    # One person may have several current versions in this made-up history.
    assert {r.check_name for r in failed} <= {"unique.door_holder_giving.person_key"}


def test_extracts_list_each_needed_column_once():
    from tallyhouse.operators import warehouse

    configs = warehouse.extract_configs()
    assert len(configs) == 15
    for c in configs.values():
        assert c.columns[0] == "Id" and len(set(c.columns)) == len(c.columns)
        assert c.modified_column is None or c.modified_column in c.columns
    assert "CreatedDateTime" in configs["attendance"].columns


def test_blank_is_a_value(spark):
    from tallyhouse.functions.columns import distinct_count
    from tallyhouse.operators import audience, engagement, lookup

    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", "y"), ("b", "y"), ("c", None)],
                               "k string, v string")
    got = {r.k: r.one for r in df.groupBy("k").agg(audience.single_value("v").alias("one"))
           .collect()}
    assert got == {"a": None, "b": "y", "c": None}
    assert df.agg(distinct_count("v").alias("n")).first().n == 3
    members = spark.createDataFrame([(1, 7, 34), (None, 7, 34)],
                                    "person_id int, group_id int, type_id int")
    assert tuple(engagement.active_members(members, 34).first()) == (2, 1)
    keys = spark.createDataFrame([("b",), ("c",), ("z",)], "k string")
    out = lookup.lookup_value(keys, df, {"k": "k"}, "v", "found")
    assert {r.k: r.found for r in out.collect()} == {"b": "y", "c": None, "z": None}
    with pytest.raises(Exception, match="several values"):
        lookup.lookup_value(df, df, {"k": "k"}, "v", "found").collect()


def test_latest_row_of_equal_times_does_not_depend_on_order(spark):
    from tallyhouse.functions.ordering import first_per_key, latest_per_key

    rows = [(1, 5, "a"), (1, 5, "b")]
    for data in (rows, rows[::-1]):
        df = spark.createDataFrame(data, "id int, t int, v string")
        assert latest_per_key(df, ["id"], ["t"]).first().v == "b"
        assert first_per_key(df, ["id"], ["t"]).first().v == "a"
